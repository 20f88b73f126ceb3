"""Co-registration: the shift between two images of the same ground."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from tesserae.functions.storage import cut
from tesserae.operators.geometry import translate

TILE = "tile_id"


def spiral(spark: SparkSession, steps: int, inside: Callable[[int, int], bool] = lambda dx, dy: True) -> DataFrame:
    """``step, dx, dy`` of a square spiral from the centre; it ends before the first place that is not ``inside``."""
    x = y = 0
    dx, dy = 0, -1
    rows = []
    for step in range(steps):
        if not inside(x, y):
            break
        rows.append((step, x, y))
        if x == y or (x < 0 and x == -y) or (x > 0 and x == 1 - y):
            dx, dy = -dy, dx
        x, y = x + dx, y + dy
    return spark.createDataFrame(rows, "step int, dx int, dy int")


def valid_window(cells: DataFrame, width: int, height: int, size: int, usable: Column, max_masked: float = 0.01, missing: Column | None = None, steps: int = 1000) -> DataFrame:
    """First window along the spiral that has no missing value and few masked cells: ``tile_id, step, y0, x0, rows, cols``.

    The spiral ends where it would leave the tile; a tile without such a window gives the whole image, with no step.
    Windows are scored by their row and column frames; the spiral is a table of at most ``steps`` rows.
    """
    rows = Window.partitionBy(TILE, "y").orderBy("x").rangeBetween(0, size - 1)
    cols = Window.partitionBy(TILE, "x").orderBy("y").rangeBetween(0, size - 1)
    gone = missing if missing is not None else F.lit(False)
    scored = cells.withColumns({"_m": F.sum((~usable).cast("int")).over(rows), "_g": F.sum(gone.cast("int")).over(rows), "_c": F.count("*").over(rows)})
    scored = scored.withColumns({"masked": F.sum("_m").over(cols), "gone": F.sum("_g").over(cols), "there": F.sum("_c").over(cols)})
    y0, x0 = height // 2 - size // 2, width // 2 - size // 2
    inside = lambda dx, dy: 0 <= x0 + dx <= width - size and 0 <= y0 + dy <= height - size
    table = spiral(cells.sparkSession, steps, inside).select("step", (F.col("dy") + y0).alias("y"), (F.col("dx") + x0).alias("x"))
    good = (F.col("there") == size * size) & (F.col("gone") == 0) & (F.col("masked") <= max_masked * size * size)
    placed = scored.join(F.broadcast(table), ["y", "x"], "left")  # every cell stays, and with it every tile
    every = placed.groupBy(TILE).agg(F.min_by(F.struct("step", F.col("y").alias("y0"), F.col("x").alias("x0")), F.when(good, F.col("step"))).alias("b"))
    found = F.col("b").isNotNull()
    side = lambda whole: F.when(found, size).otherwise(whole)
    return every.select(TILE, "b.step", F.coalesce("b.y0", F.lit(0)).alias("y0"), F.coalesce("b.x0", F.lit(0)).alias("x0"), side(height).alias("rows"), side(width).alias("cols"))


def in_window(cells: DataFrame, windows: DataFrame, margin: int = 0) -> DataFrame:
    """Cells inside their tile's window of ``valid_window``, or at most ``margin`` cells outside."""
    near = cells.join(windows.select(TILE, "y0", "x0", "rows", "cols"), TILE)
    y, x = F.col("y") - F.col("y0"), F.col("x") - F.col("x0")
    return near.where((y >= -margin) & (y < F.col("rows") + margin) & (x >= -margin) & (x < F.col("cols") + margin)).select(cells.columns)


def _sums(block: int, most: int, keys: int):
    """Sums of one block of the reference with the target moved by every shift."""

    def run(cells: pa.Table) -> pa.Table:
        y, x, role, v = (cells.column(c).to_numpy() for c in ("y", "x", "_role", "_v"))
        v = v.astype(float)
        y0, x0 = cells.column("_by")[0].as_py() * block, cells.column("_bx")[0].as_py() * block
        own, other = np.full((block, block), np.nan), np.full((block + 2 * most,) * 2, np.nan)
        own[y[role == 0] - y0, x[role == 0] - x0] = v[role == 0]
        other[y[role == 1] - y0 + most, x[role == 1] - x0 + most] = v[role == 1]
        rows, cols = (np.flatnonzero(np.isfinite(own).any(i)) for i in (1, 0))
        found = [np.empty((0, len(SUMS)))]
        if len(rows):
            top, left = rows[0], cols[0]
            own = own[top : rows[-1] + 1, left : cols[-1] + 1]
            height, width = own.shape
            there = np.isfinite(own).ravel()
            r = np.where(there, own.ravel(), 0.0)
            ours = np.stack([there, r, r * r], axis=1)
            for sy in range(-most, most + 1):  # the shifts of one row at once
                strip = other[top + most + sy :][:height, left : left + width + 2 * most]
                parts = np.lib.stride_tricks.sliding_window_view(strip, width, axis=1).transpose(1, 0, 2).reshape(2 * most + 1, -1)
                seen = np.isfinite(parts)
                t = np.where(seen, parts, 0.0)
                (n, sr, srr), (st, srt, _), stt = (seen @ ours).T, (t @ ours).T, t * t @ ours[:, 0]
                sums = np.stack([np.arange(-most, most + 1), np.full(2 * most + 1, sy), n, sr, st, srr, stt, srt], axis=1)
                found.append(sums[n > 0])
        found = np.concatenate(found)
        names = cells.column_names[:keys]
        columns = [cells.column(c).combine_chunks().take(pa.array(np.zeros(len(found), int))) for c in names]
        numbers = [pa.array(found[:, i]).cast(t) for i, t in enumerate([pa.int32(), pa.int32(), pa.int64(), *[pa.float64()] * 5])]
        return pa.table([*columns, *numbers], names=[*names, *SUMS])

    return run


SUMS = ("sx", "sy", "n", "r", "t", "rr", "tt", "rt")


def score_surface(reference: DataFrame, target: DataFrame, value: str, most: int, by: Sequence[str] = (TILE,), block: int = 128) -> DataFrame:
    """``by, sx, sy, score``: correlation of the reference with the target moved by every shift up to ``most`` cells.

    Take the reference ``in_window``. Both go to square blocks of the reference, the target with a border of ``most``
    cells; a block gives the sums of all its shifts in one pass, so the shuffle has each cell once (the target's
    near a seam up to four times) and a row for each block and shift.
    """
    keys = list(by)
    at = lambda c, d=0: F.floor((F.col(c) + d) / block)
    cells = lambda df, role: df.select(*keys, F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), F.lit(role).alias("_role"), F.col(value).cast("double").alias("_v"))
    own = cells(reference, 0).withColumns({"_by": at("y"), "_bx": at("x")})
    near = cells(target, 1).withColumn("_by", F.explode(F.sequence(at("y", -most), at("y", most)))).withColumn("_bx", F.explode(F.sequence(at("x", -most), at("x", most))))
    place = [*keys, "_by", "_bx"]
    both = own.unionByName(near.join(own.select(*place).distinct(), place, "left_semi"))
    numbers = [StructField(c, IntegerType() if c in ("sx", "sy") else LongType() if c == "n" else DoubleType()) for c in SUMS]
    sums = both.groupBy(*place).applyInArrow(_sums(block, most, len(keys)), StructType([*(StructField(c, both.schema[c].dataType) for c in keys), *numbers]))
    total = sums.groupBy(*keys, "sx", "sy").agg(*(F.sum(c).alias(c) for c in SUMS[2:]))
    n, r, t = F.col("n"), F.col("r"), F.col("t")
    spread = (F.col("rr") - r * r / n) * (F.col("tt") - t * t / n)
    return total.select(*keys, "sx", "sy", F.when(spread > 0, (F.col("rt") - r * t / n) / F.sqrt(spread)).alias("score"))


def peak(surface: DataFrame, by: Sequence[str] = (TILE,)) -> DataFrame:
    """``x_offset, y_offset`` with parts of a cell (three places) and ``shift_reliability`` (0 to 100)."""
    best = surface.where("score IS NOT NULL").groupBy(*by).agg(F.max_by(F.struct("sx", "sy", "score"), F.struct("score", -F.abs("sx") - F.abs("sy"), "sx", "sy")).alias("b"))
    near = surface.join(best.select(*by, F.col("b.sx").alias("bx"), F.col("b.sy").alias("by"), F.col("b.score").alias("bs")), list(by))
    at = lambda dx, dy: F.max(F.when((F.col("sx") == F.col("bx") + dx) & (F.col("sy") == F.col("by") + dy), F.col("score")))
    inside = (F.abs(F.col("sx") - F.col("bx")) <= 1) & (F.abs(F.col("sy") - F.col("by")) <= 1)
    facts = near.groupBy(*by, "bx", "by", "bs").agg(
        at(-1, 0).alias("l"), at(1, 0).alias("r"), at(0, -1).alias("u"), at(0, 1).alias("d"),
        F.avg(F.when(~inside, F.col("score"))).alias("m"), F.stddev_pop(F.when(~inside, F.col("score"))).alias("s"), F.avg(F.when(inside, F.col("score"))).alias("p"),
    )
    part = lambda lo, hi: F.coalesce(F.signum(F.col(hi) - F.col(lo)) * F.try_divide(F.greatest(lo, hi), F.col("bs") + F.greatest(lo, hi)), F.lit(0.0))
    trust = F.lit(100.0) - F.try_divide((F.col("m") + F.col("s") * 2) * 100, F.col("p"))
    return facts.select(*by, F.round(F.col("bx") + part("l", "r"), 3).alias("x_offset"), F.round(F.col("by") + part("u", "d"), 3).alias("y_offset"), F.greatest(F.least(F.coalesce(trust, F.lit(0.0)), F.lit(100.0)), F.lit(0.0)).alias("shift_reliability"))


def similarity(pairs: DataFrame, a: str, b: str, half: int = 3, by: Sequence[str] = (TILE,)) -> DataFrame:
    """Structural similarity of two bands of each tile, scaled to [0, 1] first, over windows of 2 half + 1 cells."""
    ends = pairs.groupBy(*by).agg(*(f(c).alias(f"{name}_{side}") for side, c in (("a", a), ("b", b)) for name, f in (("low", F.min), ("high", F.max))))
    unit = lambda c, side: F.try_divide(F.col(c) - F.col(f"low_{side}"), F.col(f"high_{side}") - F.col(f"low_{side}"))
    scaled = pairs.join(ends, list(by)).select(*by, "y", "x", unit(a, "a").alias("a"), unit(b, "b").alias("b"))
    scaled = scaled.withColumns({"aa": F.col("a") * F.col("a"), "bb": F.col("b") * F.col("b"), "ab": F.col("a") * F.col("b")})
    rows = Window.partitionBy(*by, "y").orderBy("x").rangeBetween(-half, half)
    cols = Window.partitionBy(*by, "x").orderBy("y").rangeBetween(-half, half)
    names = ("a", "b", "aa", "bb", "ab")
    means = scaled.withColumns({f"_{c}": F.sum(c).over(rows) for c in names} | {"_n": F.count("a").over(rows)})
    k = (2 * half + 1) ** 2
    means = means.withColumns({f"m{c}": F.sum(f"_{c}").over(cols) / k for c in names} | {"n": F.sum("_n").over(cols)}).where(F.col("n") == k)
    ma, mb = F.col("ma"), F.col("mb")
    norm = k / (k - 1)
    va, vb, vab = (F.col("maa") - ma * ma) * norm, (F.col("mbb") - mb * mb) * norm, (F.col("mab") - ma * mb) * norm
    c1, c2 = 0.01**2, 0.03**2
    value = ((ma * mb * 2 + c1) * (vab * 2 + c2)) / ((ma * ma + mb * mb + c1) * (va + vb + c2))
    return means.groupBy(*by).agg(F.avg(value).alias("ssim"))


def valid_offsets(offsets: DataFrame, most: float = 10.0, min_reliability: float = 30.0) -> DataFrame:
    """Shifts that are short and reliable enough and do not make the images less alike."""
    return offsets.where((F.abs("x_offset") <= most) & (F.abs("y_offset") <= most) & (F.col("shift_reliability") >= min_reliability) & (F.col("ssim_after") >= F.col("ssim_before")))


def reduce_bands(offsets: DataFrame, pair: str = "pair_id") -> DataFrame:
    """One shift for each pair: the mean if all bands agree within a cell, else weighted by reliability if their spread is under 1, else the most reliable band's."""

    def pick(c: str) -> Column:
        w = F.try_divide(F.sum(F.col(c) * F.col("shift_reliability")), F.sum("shift_reliability"))
        far = F.greatest(F.max(c) - F.avg(c), F.avg(c) - F.min(c))
        return F.when(far < 1, F.avg(c)).when(F.stddev_pop(c) < 1, w).otherwise(F.max_by(c, F.struct("shift_reliability", F.col("band"))))

    return offsets.groupBy(pair).agg(pick("x_offset").alias("x_offset"), pick("y_offset").alias("y_offset"), F.max("shift_reliability").alias("shift_reliability"), F.count("*").alias("bands"))


def align_tiles(tiles: DataFrame, offsets: DataFrame) -> DataFrame:
    """Tile origins moved by their shift (three places); tiles without one stay."""
    moved = lambda c, o, r: F.round(F.col(c) + F.coalesce(o, F.lit(0.0)) * F.col(r), 3).alias(c)
    rest = [c for c in tiles.columns if c not in ("x0", "y0")]
    return tiles.join(offsets.select(TILE, "x_offset", "y_offset"), TILE, "left").select(*rest, moved("x0", F.col("x_offset"), "res_x"), moved("y0", F.col("y_offset"), "res_y"))


def band_offsets(reference: DataFrame, target: DataFrame, bands: Sequence[str], width: int, height: int, size: int = 256, most: int = 10, max_masked: float = 0.01, usable: str = "usable") -> DataFrame:
    """Offsets of all pairs of images at once, one row for each pair and band.

    A pair is one ``tile_id`` of both tables, with cells ``y, x``, the bands and whether a cell is usable. Each pair has
    a window of its own in which nothing is missing and little is masked in either image. Gives ``tile_id, band,
    x_offset, y_offset, shift_reliability, ssim_before, ssim_after``.
    """
    at = [TILE, "y", "x"]
    sided = lambda df, side: df.select(*at, F.col(usable).alias(f"{side}_ok"), F.greatest(*(F.col(c).isNull().cast("int") for c in bands), F.lit(0)).alias(f"{side}_gone"))
    common = sided(reference, "r").join(sided(target, "t").hint("merge"), at)  # as large as the images, however small their files
    windows = cut(valid_window(common, width, height, size, F.col("r_ok") & F.col("t_ok"), max_masked, (F.col("r_gone") + F.col("t_gone")) > 0))
    by = [TILE, "band"]
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("band"), F.col(c).cast("double").alias("value")) for c in bands)))
    long = lambda df: df.select(*at, each.alias("b")).select(*at, "b.band", "b.value").where("value IS NOT NULL")
    own = cut(long(in_window(reference, windows)))
    surface = score_surface(own, long(in_window(target, windows, most)), "value", most, by)
    found = cut(peak(cut(surface), by))
    # each cell of the target goes to its own place and to the one it is moved to, if that is in the window
    of = lambda c, axis: F.max(F.when(F.col("band") == c, F.round(f"{axis}_offset").cast("int"))).alias(f"_s{axis}_{c}")
    shifts = found.groupBy(TILE).agg(*(of(c, axis) for c in bands for axis in "yx"))
    place = lambda c, moved: F.struct(F.lit(c).alias("band"), F.lit(moved).alias("moved"), *((F.col(k) - (F.col(f"_s{k}_{c}") if moved else 0)).alias(k) for k in "yx"), F.col(c).cast("double").alias("b"))
    placed = target.join(shifts, TILE).select(TILE, F.explode(F.array(*(place(c, moved) for c in bands for moved in (False, True)))).alias("p")).select(TILE, "p.*").where("b IS NOT NULL")
    pairs = own.withColumnRenamed("value", "a").join(in_window(placed, windows).hint("merge"), [*by, "y", "x"])
    alike = similarity(pairs, "a", "b", by=[*by, "moved"])
    ssim = lambda moved: F.max(F.when(F.col("moved") == moved, F.col("ssim")))
    return found.join(alike.groupBy(*by).agg(ssim(False).alias("ssim_before"), ssim(True).alias("ssim_after")), by, "left")


def pair_offsets(offsets: DataFrame, most: float = 10.0, min_reliability: float = 30.0) -> DataFrame:
    """One offset for each pair from those of its bands that are valid, with their mean reliability and gain; pairs
    without a valid band are left out."""
    fine = valid_offsets(offsets, most, min_reliability)
    means = fine.groupBy(TILE).agg(F.avg("shift_reliability").alias("reliability"), F.avg(F.col("ssim_after") - F.col("ssim_before")).alias("ssim_improvement"))
    return reduce_bands(fine, TILE).join(means, TILE)


def align_labels(labels: DataFrame, tiles: DataFrame, offsets: DataFrame) -> DataFrame:
    """Label rings moved by minus the offset of their tile, in its units, with the offset, its reliability and gain; labels
    of tiles without an offset stay, with an offset of 0."""
    near = labels.join(tiles.select(TILE, "res_x", "res_y"), TILE).join(offsets.select(TILE, "x_offset", "y_offset", "reliability", "ssim_improvement"), TILE, "left")
    dx, dy = (F.coalesce(o, F.lit(0.0)) * F.col(r) for o, r in (("x_offset", "res_x"), ("y_offset", "res_y")))
    moved = near.withColumns({"x_offset": dx, "y_offset": dy})
    return moved.withColumn("ring", translate(F.col("ring"), -F.col("x_offset"), -F.col("y_offset"))).drop("res_x", "res_y")

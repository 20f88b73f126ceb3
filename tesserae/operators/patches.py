"""Patches of tiles: cutting, scoring, blending, and training sets."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tesserae.functions.rank import numbered

TILE = "tile_id"


def origins(tiles: DataFrame, size: int, overlap: int, height: str = "height", width: str = "width") -> DataFrame:
    """``tile_id, patch_id, patch_idx_y, patch_idx_x, y0, x0``; the last patch of a side is moved inside."""
    step = size - overlap

    def along(n: str, name: str, df: DataFrame) -> DataFrame:
        k = F.sequence(F.lit(0), F.floor((F.col(n) - overlap - 1) / step).cast("int"))
        return df.withColumn(f"patch_idx_{name}", F.explode(k)).withColumn(f"{name}0", F.least(F.col(f"patch_idx_{name}") * step, F.col(n) - size))

    cut = along(width, "x", along(height, "y", tiles.where((F.col(height) > size) & (F.col(width) > size))))
    columns = F.floor((F.col(width) - overlap - 1) / step) + 1
    return cut.select(TILE, (F.col("patch_idx_y") * columns + F.col("patch_idx_x")).cast("int").alias("patch_id"), "patch_idx_y", "patch_idx_x", "y0", "x0")


def cut(pixels: DataFrame, patches: DataFrame, size: int) -> DataFrame:
    """Cells of each patch, with their place in it (``dy, dx``).

    Cells and patches meet in blocks as wide as a patch, of which a patch touches four at most. Both sides are dealt over
    tasks by the hint: Spark takes exploded rows for as small as what they are made of, and would broadcast them.
    """
    block = lambda c: F.floor(F.col(c) / size)
    along = lambda c: F.explode(F.sequence(block(f"{c}0"), F.floor((F.col(f"{c}0") + (size - 1)) / size)))
    near = patches.withColumn("_by", along("y")).withColumn("_bx", along("x"))
    inner = pixels.withColumns({"_by": block("y"), "_bx": block("x")})
    both = near.join(inner.hint("merge"), [TILE, "_by", "_bx"])
    both = both.where(F.col("y").between(F.col("y0"), F.col("y0") + (size - 1)) & F.col("x").between(F.col("x0"), F.col("x0") + (size - 1)))
    own, rest = [[c for c in df.columns if c not in (TILE, "y", "x")] for df in (patches, pixels)]
    return both.select(TILE, "y", "x", *own, (F.col("y") - F.col("y0")).alias("dy"), (F.col("x") - F.col("x0")).alias("dx"), *rest)


def soft_margin(size: int, overlap: int) -> Column:
    """Weight of a cell of a patch: ramps over the overlap, one inside."""

    def ramp(d: Column) -> Column:
        if overlap < 1:
            return F.lit(1.0)
        rise = d / max(overlap - 1, 1) if overlap > 1 else F.lit(0.0)
        fall = (size - 1 - d) / max(overlap - 1, 1) if overlap > 1 else F.lit(0.0)
        return F.when(d < overlap, rise).when(d >= size - overlap, fall).otherwise(1.0)

    return ramp(F.col("dy")) * ramp(F.col("dx"))


def blend(scored: DataFrame, size: int, overlap: int, value: str = "p") -> DataFrame:
    """Weighted mean of the patches that cover a cell; cells whose weights sum to 0 count once, unweighted as 0."""
    total = F.sum("_w")
    return scored.withColumn("_w", soft_margin(size, overlap)).groupBy(TILE, "y", "x").agg((F.sum(F.col(value) * F.col("_w")) / F.when(total == 0, 1.0).otherwise(total)).alias(value))


def mirrored(i: Column, n: int, pad: int) -> Column:
    """Indices from -pad to n + pad - 1 that mirror index ``i`` of 0..n-1 about the first and last cell, itself included."""
    period = 2 * (n - 1)
    turns = range(-(pad // period) - 1, pad // period + 2)
    every = F.array_distinct(F.array(*(i * sign + k * period for k in turns for sign in (1, -1))))
    return F.filter(every, lambda v: v.between(-pad, n + pad - 1))


def pad_reflect(pixels: DataFrame, pad: int, width: int, height: int) -> DataFrame:
    """Tiles with ``pad`` mirrored cells on each side; coordinates run from -pad. Each cell makes its own copies."""
    inner = pixels.where(F.col("y").between(0, height - 1) & F.col("x").between(0, width - 1))
    wide = inner.withColumn("y", F.explode(mirrored(F.col("y"), height, pad))).withColumn("x", F.explode(mirrored(F.col("x"), width, pad)))
    return wide.select(TILE, "y", "x", *(c for c in pixels.columns if c not in (TILE, "y", "x")))


def logistic(weights: Mapping[str, float], bias: float) -> Column:
    """A scorer as an expression; a missing value counts as 0."""
    z = reduce(lambda a, b: a + b, [F.coalesce(F.col(k), F.lit(0.0)) * w for k, w in weights.items()], F.lit(bias))
    return F.lit(1.0) / (F.exp(-z) + 1.0)


def score_patches(cells: DataFrame, bands: Sequence[str], scorer: Callable[[np.ndarray], np.ndarray], size: int) -> DataFrame:
    """Score whole patches with a function of an array (bands, size, size); patches without any value score 0.

    Neighbouring patches of a tile share a group, up to 65,536 cells, as a group costs far more than a small patch.
    """

    def run(rows: pa.Table) -> pa.Table:
        dy, dx = (rows.column(c).to_numpy() for c in ("dy", "dx"))
        ids, of = np.unique(rows.column("patch_id").to_numpy(), return_inverse=True)
        stacks, out = np.full((len(ids), len(bands), size, size), np.nan), np.zeros((len(ids), size, size))
        for i in range(len(bands)):
            stacks[of, i, dy, dx] = rows.column(f"_v{i}").to_numpy()
        for k, stack in enumerate(stacks):
            if not np.isnan(stack).all():
                out[k] = scorer(np.nan_to_num(stack))
        return rows.select([TILE, "patch_id", "dy", "dx", "y", "x"]).append_column("p", pa.array(out[of, dy, dx], pa.float64(), from_pandas=True))

    kind = cells.schema[TILE].dataType.simpleString()
    whole = cells.select(TILE, *(F.col(c).cast("int").alias(c) for c in ("patch_id", "dy", "dx", "y", "x")), *(F.col(b).cast("double").alias(f"_v{i}") for i, b in enumerate(bands)))
    groups = whole.groupBy(TILE, F.floor(F.col("patch_id") / max(1, 65536 // size**2)).alias("_group"))
    return groups.applyInArrow(run, f"{TILE} {kind}, patch_id int, dy int, dx int, y int, x int, p double")


def ensemble(pixels: DataFrame, models: Sequence[str], keep: bool = False) -> DataFrame:
    """Mean over the models' columns, missing ones skipped."""
    there = reduce(lambda a, b: a + b, [F.col(m).isNotNull().cast("int") for m in models])
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(m), F.lit(0.0)) for m in models])
    out = pixels.withColumn("probabilities", F.try_divide(total, there))
    return out if keep else out.drop(*models)


def training_patches(cells: DataFrame, bands: Sequence[str], label: str, size: int, min_labelled: float = 0.1, need_positive: bool = False, need_whole: bool = False) -> DataFrame:
    """Patches worth training on: enough labelled cells (not 2), no band wholly missing, options for the rest."""
    n = size * size
    facts = cells.groupBy(TILE, "patch_id").agg(
        (F.sum(F.when(F.col(label) != 2, 1).otherwise(0)) / n).alias("labelled"),
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("positives"),
        F.least(*(F.count(b) for b in bands), F.lit(n)).alias("least"),
    )
    kept = facts.where((F.col("labelled") >= min_labelled) & (F.col("least") > 0))
    if need_positive:
        kept = kept.where("positives > 0")
    if need_whole:
        kept = kept.where(F.col("least") == n)
    return kept


def patch_metadata(kept: DataFrame, patches: DataFrame, first: int = 0, samples: DataFrame | None = None, size: int | None = None) -> DataFrame:
    """Training rows numbered on from ``first``, with place and emptiness.

    ``samples`` adds ``region`` and ``sample_id`` of each tile, ``size`` the extent of the patch in cells.
    """
    joined = kept.join(patches.hint("merge"), [TILE, "patch_id"])
    more: list[Column | str] = []
    if samples is not None:
        joined = joined.join(samples.select(TILE, "region", "sample_id").hint("merge"), TILE, "left")
        more += ["region", "sample_id"]
    if size is not None:
        x, y = F.col("x0"), F.col("y0")
        more += [x.alias("xmin"), y.alias("ymin"), (x + size).alias("xmax"), (y + size).alias("ymax")]
    out = numbered(joined, [TILE, "patch_id"], "z_idx", first)
    return out.select("z_idx", TILE, "patch_id", "patch_idx_y", "patch_idx_x", (F.col("positives") == 0).alias("is_empty"), F.col("x0").alias("x"), F.col("y0").alias("y"), *more)


def augment(cells: DataFrame, size: int) -> DataFrame:
    """The eight symmetries of a patch, by index arithmetic: ``variant`` 0..7 (bit 2 flips, low bits turn)."""
    y, x, last = F.col("dy"), F.col("dx"), size - 1
    turns = [(y, x), (x, last - y), (last - y, last - x), (last - x, y)]
    every = [F.struct(F.lit(k + 4 * f).alias("variant"), a.alias("dy"), (last - b if f else b).alias("dx")) for f in (0, 1) for k, (a, b) in enumerate(turns)]
    rest = [c for c in cells.columns if c not in ("dy", "dx")]
    return cells.withColumn("_v", F.explode(F.array(*every))).select(*rest, "_v.variant", "_v.dy", "_v.dx")


def posterize(value: Column, bits: int = 6) -> Column:
    """A band of 0..255 with its lowest bits cleared."""
    return value.bitwiseAND(F.lit((0xFF << (8 - bits)) & 0xFF))

"""Connected objects of a mask: labels, sizes, clean-up, zonal statistics and outlines."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StructField, StructType

from tesserae.functions.graph import components
from tesserae.functions.storage import cut, discard
from tesserae.operators.geometry import contains

# Joins of cells, regions and rings have a hint: tables from ``cut`` are far smaller as files than as rows, so Spark would
# broadcast millions of them.

TILE = "tile_id"


def merged(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node that each of ``n`` nodes is joined with by the edges ``a``-``b``."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def block_roots(y: np.ndarray, x: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """First cell in raster order (``y, x``) of each cell's component among these cells."""
    order = np.lexsort((x, y))
    y, x = y[order], x[order]
    start = np.flatnonzero(np.r_[True, (y[1:] != y[:-1]) | (x[1:] != x[:-1] + 1)])
    end = np.r_[start[1:], len(y)] - 1
    wide = int(x.max()) - int(x.min()) + 4  # rows lie apart by more than a run reaches
    row, x0, x1 = y[start], x[start] - x.min() + 1, x[end] - x.min() + 1
    left, right = row * wide + x0, row * wide + x1
    first = np.searchsorted(right, left + wide - reach)
    many = np.maximum(0, np.searchsorted(left, right + wide + reach, "right") - first)
    upper = np.repeat(np.arange(len(start)), many)
    lower = np.arange(many.sum()) + np.repeat(first - (np.cumsum(many) - many), many)
    root = start[merged(len(start), upper, lower)]
    of = np.empty(len(y), np.int64)
    of[order] = np.repeat(root, end - start + 1)
    return y[of], x[of]


def _in_block(reach: int):
    def run(cells: pa.Table) -> pa.Table:
        y, x = (cells.column(c).to_numpy() for c in ("y", "x"))
        ry, rx = block_roots(y.astype(np.int64), x.astype(np.int64), reach)
        kinds = cells.schema.field("y").type, cells.schema.field("x").type
        return cells.select([TILE, "y", "x"]).append_column("ry", pa.array(ry).cast(kinds[0])).append_column("rx", pa.array(rx).cast(kinds[1]))

    return run


def _seams(cells: DataFrame, block: int, reach: int) -> DataFrame:
    """Components of blocks that touch across a seam: ``tile_id, u, v`` as first cells ``y, x``."""
    edge = lambda c: F.pmod(F.col(c), F.lit(block)) == block - 1
    side = range(-reach, reach + 1)
    step = lambda dy, dx: F.struct((F.col("y") + dy).alias("y"), (F.col("x") + dx).alias("x"))
    over = F.concat(
        F.when(edge("x"), F.array(*(step(d, 1) for d in side))).otherwise(F.array().cast("array<struct<y:int,x:int>>")),
        F.when(edge("y"), F.array(*(step(1, d) for d in side))).otherwise(F.array().cast("array<struct<y:int,x:int>>")),
    )
    root = F.struct(F.col("ry").alias("y"), F.col("rx").alias("x"))
    near = cells.where(edge("x") | edge("y")).select(TILE, root.alias("u"), F.explode(over).alias("to")).select(TILE, "u", "to.y", "to.x")
    first = lambda c: F.pmod(F.col(c), F.lit(block)) == 0
    far = cells.where(first("x") | first("y")).select(TILE, "y", "x", root.alias("v"))
    return near.join(far.hint("merge"), [TILE, "y", "x"]).where("u <> v").select(TILE, "u", "v").distinct()


def _joined(cells: DataFrame, seams: DataFrame) -> DataFrame:
    """``cells`` with the first cell of their component over all blocks."""
    of = lambda c: seams.select(TILE, F.col(c).alias("r"))
    nodes = cut(of("u").union(of("v")).distinct().withColumn("id", F.monotonically_increasing_id()))  # fixed once it is written
    edges = seams.join(nodes.select(TILE, F.col("r").alias("u"), F.col("id").alias("a")), [TILE, "u"]).join(nodes.select(TILE, F.col("r").alias("v"), F.col("id").alias("b")), [TILE, "v"])
    found = nodes.join(components(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), F.col("id") == F.col("node"))
    least = found.groupBy("component").agg(F.min("r").alias("to"))
    moved = found.join(least, "component").where("r <> to").select(TILE, F.col("r.y").alias("ry"), F.col("r.x").alias("rx"), "to")
    both = cells.join(moved.hint("merge"), [TILE, "ry", "rx"], "left")
    return both.select(TILE, "y", "x", F.coalesce("to.y", "ry").alias("ry"), F.coalesce("to.x", "rx").alias("rx"))


def label(pixels: DataFrame, mask: str, neighbours: int = 8, block: int = 256) -> DataFrame:
    """``tile_id, y, x, region_id`` of the set cells; regions of a tile are numbered in raster order from 1.

    Components of square blocks of ``block`` cells come first, each block in one task; only those that touch across a
    seam are nodes of the rounds that join them over all tiles at once. Tile ids may be of any type. The labels are
    written once, however often they are used.
    """
    reach = 1 if neighbours == 8 else 0
    cells = pixels.where(F.col(mask)).select(TILE, F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"))
    schema = StructType([StructField(TILE, cells.schema[TILE].dataType), *(StructField(c, IntegerType()) for c in ("y", "x", "ry", "rx"))])
    blocks = cells.groupBy(TILE, F.floor(F.col("y") / block).alias("_by"), F.floor(F.col("x") / block).alias("_bx"))
    found = cut(blocks.applyInArrow(_in_block(reach), schema))
    seams = cut(_seams(found, block, reach))
    if not seams.isEmpty():
        found = _joined(found, seams)
    roots = found.where("y = ry AND x = rx").select(TILE, "ry", "rx")
    numbered = roots.withColumn("region_id", F.row_number().over(Window.partitionBy(TILE).orderBy("ry", "rx")))
    return cut(found.join(numbered.hint("merge"), [TILE, "ry", "rx"]).select(TILE, "y", "x", "region_id"))


def sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy(TILE, "region_id").agg(F.count("*").alias("npixel"))


def remove_small(pixels: DataFrame, mask: str, least: int, neighbours: int = 4) -> DataFrame:
    """The mask without objects of fewer than ``least`` cells."""
    found = label(pixels, mask, neighbours)
    kept = found.join(sizes(found).where(F.col("npixel") >= least), [TILE, "region_id"], "left_semi").select(TILE, "y", "x", F.lit(True).alias("_kept"))
    return pixels.join(kept, [TILE, "y", "x"], "left").withColumn(mask, F.coalesce("_kept", F.lit(False))).drop("_kept")


def remove_touching(pixels: DataFrame, mask: str, extent: str) -> DataFrame:
    """The mask without objects that have a cell, or an 8-neighbour of one, outside the valid extent.

    Objects alone are labelled; what lies outside only meets the neighbours of their cells.
    """
    found = label(pixels.withColumn("_m", F.col(mask) & F.col(extent)), "_m", 8)
    near = F.explode(F.array(*(F.struct((F.col("y") + dy).alias("y"), (F.col("x") + dx).alias("x")) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if dy or dx)))
    outside = pixels.where(~F.col(extent)).select(TILE, "y", "x")
    bad = found.select(TILE, "region_id", near.alias("n")).select(TILE, "region_id", "n.y", "n.x").join(outside, [TILE, "y", "x"], "left_semi").select(TILE, "region_id").distinct()
    kept = found.join(bad, [TILE, "region_id"], "left_anti").select(TILE, "y", "x", F.lit(True).alias("_kept"))
    return pixels.join(kept, [TILE, "y", "x"], "left").withColumn(mask, F.coalesce("_kept", F.lit(False))).drop("_kept")


def zonal(labels: DataFrame, values: DataFrame, value: str, more: Mapping[str, Callable[[pd.Series], float]] | None = None) -> DataFrame:
    """Least and most (truncated), mean, median, population deviation and count of each region.

    ``more`` adds statistics by functions of the user, name -> function of a region's values (missing ones left out);
    such a function needs all values of a region in one task, which the others do not.
    """
    found = _statistics(labels, values, value)
    if more:
        given = labels.join(values.select(TILE, "y", "x", value).hint("merge"), [TILE, "y", "x"]).where(F.col(value).isNotNull())
        own = given.groupBy(TILE, "region_id").agg(*(F.pandas_udf(_number(f), "double")(F.col(value).cast("double")).alias(name) for name, f in more.items()))
        found = found.join(own.hint("merge"), [TILE, "region_id"], "left")
    return found


def _number(f: Callable[[pd.Series], float]) -> Callable:
    def call(values: pd.Series) -> float:
        return float(f(values))

    return call


def _statistics(labels: DataFrame, values: DataFrame, value: str) -> DataFrame:
    return (
        labels.join(values.select(TILE, "y", "x", value).hint("merge"), [TILE, "y", "x"])
        .groupBy(TILE, "region_id")
        .agg(F.min(value).cast("int").alias("min"), F.max(value).cast("int").alias("max"), F.avg(value).alias("mean"), F.median(value).alias("median"), F.stddev_pop(value).alias("std"), F.count("*").alias("npixel"))
    )


def outline_edges(labels: DataFrame) -> DataFrame:
    """Directed unit edges of each region's outline, inside on the right; edges between its own cells cancel."""
    x, y = F.col("x"), F.col("y")
    corner = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    corners = [corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1)]
    edges = F.array(*(F.struct(a.alias("a"), b.alias("b")) for a, b in zip(corners, corners[1:] + corners[:1])))
    e = labels.select(TILE, "region_id", F.explode(edges).alias("e"))
    flat = e.select(TILE, "region_id", F.least("e.a", "e.b").alias("lo"), F.greatest("e.a", "e.b").alias("hi"), "e.a", "e.b")
    alone = flat.groupBy(TILE, "region_id", "lo", "hi").agg(F.count("*").alias("n"), F.first("a").alias("a"), F.first("b").alias("b")).where("n = 1")
    return alone.select(TILE, "region_id", F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("b.x").alias("bx"), F.col("b.y").alias("by"))


def _walk(after: np.ndarray) -> Iterator[tuple[list[int], bool]]:
    """Chains of edges by their successors (-1: none), and whether each is closed."""
    follows = np.zeros(len(after), bool)
    follows[after[after >= 0]] = True
    left = np.ones(len(after), bool)
    for start in [*np.flatnonzero(~follows).tolist(), *np.flatnonzero(follows).tolist()]:
        if not left[start]:
            continue
        chain, e = [], start
        while e >= 0 and left[e]:
            left[e] = False
            chain.append(e)
            e = int(after[e])
        yield chain, e == start


def _turn(ax, ay, bx, by, cx, cy):  # noqa: ANN001
    return (bx - ax) * (cy - by) - (by - ay) * (cx - bx)


def _block_paths(block: int):
    """Outlines within one block: whole rings, paths that end at a seam, and edges on a seam, each by its corners."""

    def run(cells: pa.Table) -> pa.Table:
        y, x, region = (cells.column(c).to_numpy().astype(np.int64) for c in ("y", "x", "region_id"))
        y0, x0 = cells.column("_by")[0].as_py() * block - 1, cells.column("_bx")[0].as_py() * block - 1
        grid = np.zeros((block + 2, block + 2), np.int64)
        gy, gx = y - y0 + 1, x - x0 + 1
        grid[gy, gx] = region
        parts = []
        for dy, dx, a, b in ((-1, 0, (0, 0), (1, 0)), (0, 1, (1, 0), (1, 1)), (1, 0, (1, 1), (0, 1)), (0, -1, (0, 1), (0, 0))):
            on = np.flatnonzero(grid[gy + dy, gx + dx] != region)
            outside = (gy[on] + dy < 1) | (gy[on] + dy > block) | (gx[on] + dx < 1) | (gx[on] + dx > block)
            parts.append(np.c_[region[on], x[on] + a[0], y[on] + a[1], x[on] + b[0], y[on] + b[1], outside])
        e = np.concatenate(parts)
        r, ax, ay, bx, by, seam = e.T
        starts: dict[tuple[int, int, int], list[int]] = {}
        for k, at in enumerate(zip(r.tolist(), ax.tolist(), ay.tolist())):
            starts.setdefault(at, []).append(k)
        known = np.flatnonzero((seam == 0) & (bx > x0) & (bx < x0 + block) & (by > y0) & (by < y0 + block))
        after = np.full(len(e), -1)
        for k in known.tolist():
            ends = starts[int(r[k]), int(bx[k]), int(by[k])]
            after[k] = ends[0] if len(ends) == 1 else max(ends, key=lambda n: _turn(ax[k], ay[k], bx[k], by[k], bx[n], by[n]))
        rows: list[tuple] = []
        for chain, closed in _walk(after):
            c = np.array(chain)
            px, py = np.r_[ax[c], bx[c[-1]]], np.r_[ay[c], by[c[-1]]]
            bend = np.r_[True, (np.diff(px)[1:] != np.diff(px)[:-1]) | (np.diff(py)[1:] != np.diff(py)[:-1]), True]
            rows.append((int(r[c[0]]), closed, bool(seam[c[0]]), px[bend].tolist(), py[bend].tolist()))
        tile = cells.column(TILE).combine_chunks()
        columns = [pa.concat_arrays([tile.slice(0, 1)] * len(rows)) if rows else tile.slice(0, 0)]
        kinds = (cells.schema.field("region_id").type, pa.bool_(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        return pa.table([*columns, *(pa.array([x[i] for x in rows], t) for i, t in enumerate(kinds))], names=[TILE, "region_id", "closed", "seam", "px", "py"])

    return run


def _paths(labels: DataFrame, block: int) -> DataFrame:
    """``tile_id, region_id, closed, px, py`` of outlines cut at the seams of blocks; edges between a region's own cells
    on both sides of a seam are left out."""
    kinds = [labels.schema[c] for c in (TILE, "region_id")]
    corners = ArrayType(IntegerType())
    schema = StructType([*(StructField(f.name, f.dataType) for f in kinds), StructField("closed", BooleanType()), StructField("seam", BooleanType()), StructField("px", corners), StructField("py", corners)])
    at = {f"_b{c}": F.floor((F.col(c) + 1) / block) for c in ("y", "x")}  # a tile's border, at 0, is no seam
    blocks = labels.select(TILE, "y", "x", "region_id").withColumns(at).groupBy(TILE, *at)
    every = cut(blocks.applyInArrow(_block_paths(block), schema))
    end = lambda at: F.struct(F.element_at("py", at).alias("y"), F.element_at("px", at).alias("x"))
    low, high = F.least(end(1), end(2)), F.greatest(end(1), end(2))
    alone = every.where("seam").groupBy(TILE, "region_id", low.alias("lo"), high.alias("hi")).agg(F.count("*").alias("n"), F.first("px").alias("px"), F.first("py").alias("py")).where("n = 1")
    return every.where("NOT seam").drop("seam").unionByName(alone.select(TILE, "region_id", F.lit(False).alias("closed"), "px", "py"))


def _ranked(after: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``id, lead, rank`` of the members of cycles ``id -> next``: the least id leads, ranks go on from it.

    Every member points at the one before it; pointers double until all reach the lead, so the rounds are the logarithm
    of the longest cycle.
    """
    groups = components(after.select(F.col("id").alias("u"), F.col("next").alias("v")))
    led = cut(after.join(groups, F.col("id") == F.col("node"), "left").select("id", "next", F.coalesce("component", "id").alias("lead")))
    before = led.select(F.col("next").alias("id"), F.col("id").alias("to"), "lead")
    start = F.col("id") == F.col("lead")
    now = cut(before.select("id", "lead", F.when(start, F.col("id")).otherwise(F.col("to")).alias("to"), F.when(start, 0).otherwise(1).cast("long").alias("rank")))
    for _ in range(max_rounds):
        if now.where("to <> lead").isEmpty():
            return now.select("id", "lead", "rank")
        ahead = now.select(F.col("id").alias("to"), F.col("to").alias("_to"), F.col("rank").alias("_rank"))
        old, now = now, cut(now.join(ahead, "to").select("id", "lead", F.col("_to").alias("to"), (F.col("rank") + F.col("_rank")).alias("rank")))
        discard([old])
    raise RuntimeError(f"ranks did not settle in {max_rounds} rounds")


def _linked(paths: DataFrame) -> DataFrame:
    """``tile_id, region_id, px, py``: rings from paths that end where others begin."""
    open_ = cut(paths.withColumn("id", F.monotonically_increasing_id()))  # fixed once it is written
    if open_.isEmpty():
        return open_.select(TILE, "region_id", "px", "py")
    at = lambda k: [F.element_at(c, k) for c in ("px", "py")]
    ends = open_.select(TILE, "region_id", "id", *(c.alias(n) for c, n in zip([*at(-2), *at(-1)], ("ax", "ay", "bx", "by"))))
    begins = open_.select(TILE, "region_id", F.col("id").alias("next"), *(c.alias(n) for c, n in zip([*at(1), *at(2)], ("bx", "by", "cx", "cy"))))
    sign = lambda c: F.signum(c).cast("int")
    met = ends.join(begins, [TILE, "region_id", "bx", "by"])
    turn = sign(F.col("bx") - F.col("ax")) * sign(F.col("cy") - F.col("by")) - sign(F.col("by") - F.col("ay")) * sign(F.col("cx") - F.col("bx"))
    after = cut(met.groupBy("id").agg(F.max_by("next", turn).alias("next")))
    placed = open_.join(_ranked(after), "id")
    part = F.struct("rank", *(F.slice(c, F.lit(1), F.size(c) - 1).alias(c) for c in ("px", "py")))
    rings = placed.groupBy(TILE, "region_id", "lead").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    whole = lambda c: F.flatten(F.transform("parts", lambda s: s[c]))
    joined = rings.select(TILE, "region_id", whole("px").alias("px"), whole("py").alias("py"))
    close = lambda c: F.concat(c, F.slice(c, 1, 1))
    return joined.select(TILE, "region_id", close("px").alias("px"), close("py").alias("py"))


def _rounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rings that begin at their first corner in raster order and have no corner on a straight line, with their area."""
    for batch in batches:
        xs, ys, areas = [], [], []
        for px, py in zip(batch.column("px").to_pylist(), batch.column("py").to_pylist()):
            x, y = np.array(px[:-1]), np.array(py[:-1])
            bend = (x - np.roll(x, 1)) * (np.roll(y, -1) - y) != (y - np.roll(y, 1)) * (np.roll(x, -1) - x)
            x, y = x[bend], y[bend]
            k = -int(np.lexsort((x, y))[0])
            x, y = np.roll(x, k), np.roll(y, k)
            x, y = np.r_[x, x[:1]], np.r_[y, y[:1]]
            areas.append(float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum()) / 2)
            xs.append(x.tolist())
            ys.append(y.tolist())
        lists = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(xs, lists), pa.array(ys, lists), pa.array(areas, pa.float64())], names=["k", "px", "py", "signed"])


def polygons(labels: DataFrame, block: int = 256) -> DataFrame:
    """``tile_id, region_id, ring_id, ring, hole, outer``: closed rings of pixel corners without corners on straight lines,
    the inside on their right.

    Rings begin at their first corner in raster order and are numbered by it; ``hole`` rings lie in the ring that
    ``outer`` numbers. Where two outlines touch at a corner they stay apart. Outlines are walked within square blocks;
    what crosses seams is put together from paths by pointer doubling, so no task holds a region, only a ring as a row.
    """
    paths = cut(_paths(labels, block))
    whole = paths.where("closed").select(TILE, "region_id", "px", "py").unionByName(_linked(paths.where("NOT closed").drop("closed")))
    key = F.struct(TILE, "region_id").alias("k")
    keyed = whole.select(key, "px", "py")
    corners = ArrayType(IntegerType())
    schema = StructType([StructField("k", keyed.schema["k"].dataType), StructField("px", corners), StructField("py", corners), StructField("signed", DoubleType())])
    found = keyed.mapInArrow(_rounded, schema).select("k.*", "px", "py", "signed")
    ring = F.zip_with("px", "py", lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    order = Window.partitionBy(TILE, "region_id").orderBy(F.element_at("py", 1), F.element_at("px", 1), F.col("signed").desc())
    rings = cut(found.select(TILE, "region_id", ring.alias("ring"), (F.col("signed") < 0).alias("hole"), F.abs("signed").alias("area"), F.row_number().over(order).alias("ring_id")))
    outer = rings.where("NOT hole").select(TILE, "region_id", F.col("ring_id").alias("outer"), F.col("ring").alias("around"), F.col("area").alias("outer_area"))
    only = outer.groupBy(TILE, "region_id").agg(F.min("outer").alias("first"), F.count("*").alias("outers"))
    holes = rings.where("hole").join(only.hint("merge"), [TILE, "region_id"])
    # a hole of a region with several outer rings is in the smallest that has the middle of its first cell
    cell = [F.element_at("ring", 1)[c] + 0.5 for c in ("x", "y")]
    near = holes.where("outers > 1").join(outer.hint("merge"), [TILE, "region_id"]).where(contains(F.col("around"), *cell))
    inside = near.groupBy(TILE, "region_id", "ring_id").agg(F.min_by("outer", "outer_area").alias("outer"))
    single = holes.where("outers = 1").select(TILE, "region_id", "ring_id", F.col("first").alias("outer"))
    named = rings.join(single.unionByName(inside).hint("merge"), [TILE, "region_id", "ring_id"], "left")
    return named.select(TILE, "region_id", "ring_id", "ring", "hole", F.coalesce("outer", "ring_id").alias("outer"))


def vectorise(pixels: DataFrame, mask: str, value: str, neighbours: int = 8) -> DataFrame:
    """Regions with rings and zonal statistics, one row for each ring."""
    found = label(pixels, mask, neighbours)
    return polygons(found).join(zonal(found, pixels, value).hint("merge"), [TILE, "region_id"])


def polygon_products(pixels: DataFrame, subsets: Mapping[str, tuple[str, str]], extent: str | None = None) -> DataFrame:
    """Polygons with statistics of each ensemble subset (name -> mask and value column), as ``product`` segments, and of
    the valid extent; written with ``partitionBy("product", "subset")`` they are one file set for each."""
    parts = [vectorise(pixels, mask, value).select(F.lit("segments").alias("product"), F.lit(name).alias("subset"), "*") for name, (mask, value) in subsets.items()]
    if extent is not None:
        inside = pixels.withColumn("_one", F.col(extent).cast("int"))
        parts.append(vectorise(inside, extent, "_one").select(F.lit("extent").alias("product"), F.lit("").alias("subset"), "*"))
    return reduce(lambda a, b: a.unionByName(b), parts)

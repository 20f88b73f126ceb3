"""Scene catalogues: filters, names and dates, spatial joins and matching."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tesserae.functions.storage import cut
from tesserae.operators import geometry, polygons

BOX = ("xmin", "ymin", "xmax", "ymax")
YEARS = tuple(range(2017, 2026))
LANDSAT_YEARS = tuple(range(1997, 2024))


def limits(scenes: DataFrame, max_cloud: int | None = 10, max_snow: int | None = 10) -> DataFrame:
    """At most so much cloud and snow; None and 100 set no limit."""
    for column, most in (("cloud", max_cloud), ("snow", max_snow)):
        if most is not None and most < 100:
            scenes = scenes.where(F.col(column) <= most)
    return scenes


def strict_limits(scenes: DataFrame, max_cloud: int | None = 10, max_snow: int | None = 10) -> DataFrame:
    """Less than so much cloud and snow; None, 0 and 100 set no limit."""
    for column, most in (("cloud", max_cloud), ("snow", max_snow)):
        if most and most < 100:
            scenes = scenes.where(F.col(column) < most)
    return scenes


def in_tiles(scenes: DataFrame, tiles: Sequence[str], prefix: str = "MGRS-") -> DataFrame:
    """Scenes of named grid tiles; a leading T of a tile is no part of the code (Landsat codes keep theirs)."""
    names = [t.lstrip("T") if prefix == "MGRS-" else t for t in tiles]
    return scenes.where(F.col("grid_code").isin([prefix + t for t in names]))


def in_period(scenes: DataFrame, start: str | None = None, end: str | None = None, months: Sequence[int] | None = None, years: Sequence[int] | None = None) -> DataFrame:
    """A date range goes before months and years; months alone mean all years and the other way round."""
    if start and end:
        return scenes.where(F.col("ts").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    if months or years:
        return scenes.where(F.month("ts").isin(list(months or range(1, 13))) & F.year("ts").isin(list(years or YEARS)))
    return scenes


def quarter_months(quarters: Sequence[int]) -> list[int]:
    return [m for q in quarters for m in range(3 * q - 2, 3 * q + 1)]


def quarterly_mosaics(scenes: DataFrame, quarters: Sequence[int] = (1, 2, 3, 4), years: Sequence[int] = YEARS) -> DataFrame:
    """Mosaics are dated to the first month of their quarter."""
    return scenes.where(F.month("ts").isin([3 * (q - 1) + 1 for q in quarters]) & F.year("ts").isin(list(years)))


def bimonthly_mosaics(scenes: DataFrame, periods: Sequence[str], years: Sequence[int] = LANDSAT_YEARS) -> DataFrame:
    return scenes.where(F.month("ts").isin([int(p.split("-")[0]) for p in periods]) & F.year("ts").isin(list(years)))


def scene_kind(name: Column) -> Column:
    """scene, orthotile or invalid, from a product name of three or four parts with real dates."""
    parts = F.split(name, "_")
    date = lambda i: F.try_to_timestamp(parts[i], F.lit("yyyyMMdd")).isNotNull() & parts[i].rlike("^[0-9]{8}$")
    scene = (F.size(parts) >= 3) & (F.size(parts) <= 4) & date(0) & parts[1].rlike("^[0-9]{6}$") & (F.length(F.element_at(parts, -1)) == 4)
    tile = (F.size(parts) == 4) & parts[0].rlike("^[0-9]+$") & parts[1].rlike("^[0-9]+$") & F.try_to_timestamp(F.get(parts, F.lit(2)), F.lit("yyyy-MM-dd")).isNotNull() & (F.length(F.element_at(parts, -1)) == 4)
    return F.when(scene, "scene").when(tile, "orthotile").otherwise("invalid")


def id_year(name: Column, scheme: str) -> Column:
    """Year from an id: where the date stands depends on the naming scheme."""
    part = {"planet_scene": 0, "planet_orthotile": 2, "s2_scene": 2, "s2_mosaic": 2, "landsat_mosaic": 2}[scheme]
    skip = 5 if scheme == "s2_mosaic" else 1
    return F.substring(F.get(F.split(name, "_"), F.lit(part)), skip if scheme == "s2_mosaic" else 1, 4).try_cast("int")


def id_date(name: Column, pattern: str = "yyyyMMdd") -> Column:
    return F.try_to_timestamp(F.try_element_at(F.split(name, "_"), F.lit(-2)), F.lit(pattern))


def trend_vintage(year: Column) -> Column:
    """The trend product to use for a year (it lags by one)."""
    return F.when(year <= 2018, 2019).when(year == 2019, 2020).when(year <= 2021, 2022).otherwise(2024)


def flatten_properties(items: DataFrame, column: str, schema: str) -> DataFrame:
    """JSON properties as dotted columns; booleans become 0/1, arrays JSON text."""
    parsed = items.withColumn("_p", F.from_json(column, schema))

    def leaves(struct, path: str, name: str):
        for f in struct.fields:
            c, n = f"{path}.`{f.name}`", f"{name}{f.name}"
            kind = f.dataType.typeName()
            if kind == "struct":
                yield from leaves(f.dataType, c, n + ".")
            elif kind == "boolean":
                yield F.col(c).cast("int").alias(n)
            elif kind in ("array", "map"):
                yield F.to_json(c).alias(n)
            else:
                yield F.col(c).alias(n)

    return parsed.select(*(F.col(f"`{c}`") for c in items.columns if c != column), *leaves(parsed.schema["_p"].dataType, "_p", ""))


def common_crs(assets: DataFrame, item: str = "scene_id", code: str = "code") -> DataFrame:
    """Items whose assets share one UTM code."""
    codes = assets.groupBy(item).agg(F.count_distinct(code).alias("n"), F.min(code).alias("code"))
    return codes.where((F.col("n") == 1) & F.col("code").rlike("^EPSG:32[67][0-9]{2}$")).select(item, "code")


def missing_bands(scenes: DataFrame, stored: DataFrame, required: Sequence[str], item: str = "scene_id") -> DataFrame:
    """``item, band`` of the required bands that are not stored."""
    need = scenes.select(item).distinct().withColumn("band", F.explode(F.array(*map(F.lit, required))))
    return need.join(stored.select(item, "band").distinct(), [item, "band"], "left_anti")


def completeness(scenes: DataFrame, stored: DataFrame, required: Sequence[str], item: str = "scene_id") -> DataFrame:
    """Whether an item is stored at all and with every required band."""
    got = stored.where(F.col("band").isin(list(required))).groupBy(item).agg(F.count_distinct("band").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return scenes.select(item).distinct().join(got, item, "left").select(item, (n > 0).alias("is_there"), (n == len(required)).alias("complete"))


def upsert_bands(stored: DataFrame, new: DataFrame, keys: Sequence[str], bands: Sequence[str], coordinates: Sequence[str] = ()) -> DataFrame:
    """Stored values with new ones in their place; rows of either side stay.

    Where both sides have a row, their ``coordinates`` must agree; else the job fails.
    """
    old = stored.select(*keys, *(F.col(b).alias(f"_{b}") for b in (*bands, *coordinates) if b in stored.columns))
    joined = old.join(new, list(keys), "full_outer")
    value = lambda b: F.coalesce(*([F.col(b)] if b in new.columns else []), *([F.col(f"_{b}")] if b in stored.columns else []))
    apart = lambda c: F.col(c) != F.col(f"_{c}")
    agreed = lambda c: F.when(apart(c), F.raise_error(F.lit(f"{c} of the new bands is not that of the stored ones"))).otherwise(F.coalesce(c, f"_{c}"))
    return joined.select(*keys, *(agreed(c).alias(c) for c in coordinates), *(value(b).alias(b) for b in bands))


def discover(files: DataFrame, pattern: str, ids: Sequence[str] | None = None) -> DataFrame:
    """Tile ids from paths, sorted; ``ids`` keeps only those."""
    found = files.select(F.regexp_extract("path", pattern, 1).alias("id"), "path").where("id <> ''")
    return (found.where(F.col("id").isin(list(ids))) if ids is not None else found).orderBy("id", "path")


#: Levels of cells, each twice as wide as the one before.
LEVELS = 40


def _level(xmin: Column, ymin: Column, xmax: Column, ymax: Column, cell: float) -> Column:
    """Level whose cells are at least as wide as a box, so that it touches four of them at most."""
    side = F.greatest(xmax - xmin, ymax - ymin, F.lit(cell)) / cell
    return F.least(F.ceil(F.log2(side) - 1e-9), F.lit(LEVELS)).cast("int")


def _cells(boxes: DataFrame, cell: float, levels: Sequence[int] | None = None, above: bool = False) -> DataFrame:
    """``at_level, at_x, at_y`` of the cells that a box touches, four at most on a level: on its own level, or on those
    of ``levels`` that are not below it (``above``: that are above it)."""
    own = F.col("level")
    levelled = boxes.withColumn("level", _level(*(F.col(c) for c in BOX), cell))
    at = F.array(own) if levels is None else F.filter(F.array(*map(F.lit, levels)).cast("array<int>"), lambda x: x > own if above else x >= own)
    wide = F.pow(F.lit(2.0), F.col("at_level")) * cell
    steps = lambda lo, hi: F.sequence(F.floor(F.col(lo) / wide), F.floor(F.col(hi) / wide))
    return levelled.withColumn("at_level", F.explode(at)).withColumn("at_x", F.explode(steps("xmin", "xmax"))).withColumn("at_y", F.explode(steps("ymin", "ymax"))).drop("level")


def intersecting(left: DataFrame, right: DataFrame, cell: float = 100) -> DataFrame:
    """Pairs of boxes that share area or an edge; columns of ``right`` come with the prefix ``r_``.

    A box stands in the cells of the level whose cells are as wide as it is, and meets larger boxes in the cells of
    their level; a pair counts in the one cell that has the lower corner of what both share. What is made of a box does
    not grow with its size: at most four cells for each level that the other table has (read first, a number each).
    """
    levels = lambda df: sorted(r[0] for r in df.select(_level(*(F.col(c) for c in BOX), cell).alias("v")).where("v IS NOT NULL").distinct().collect())
    at = ["at_level", "at_x", "at_y"]
    other = lambda df: df.select(*(F.col(c).alias(c if c in at else f"r_{c}") for c in df.columns))
    up = _cells(left, cell, levels(right)).join(other(_cells(right, cell)), at)
    down = _cells(left, cell).join(other(_cells(right, cell, levels(left), above=True)), at)
    exact = (F.col("xmin") <= F.col("r_xmax")) & (F.col("r_xmin") <= F.col("xmax")) & (F.col("ymin") <= F.col("r_ymax")) & (F.col("r_ymin") <= F.col("ymax"))
    wide = F.pow(F.lit(2.0), F.col("at_level")) * cell
    once = (F.col("at_x") == F.floor(F.greatest("xmin", "r_xmin") / wide)) & (F.col("at_y") == F.floor(F.greatest("ymin", "r_ymin") / wide))
    return up.unionByName(down).where(exact & once).drop(*at)


def overlap_area() -> Column:
    w = F.least("xmax", "r_xmax") - F.greatest("xmin", "r_xmin")
    h = F.least("ymax", "r_ymax") - F.greatest("ymin", "r_ymin")
    return F.greatest(w, F.lit(0)) * F.greatest(h, F.lit(0))


#: Rows of one box that stand in a block at most.
BLOCK = 4096
#: Rows of either side in a tile at most: what one step of generated code makes of a tile waits in memory until it is taken.
TILE = (4, 256)
#: Rows that a task makes, about.
TASK_ROWS = 1 << 25


def _blocks(rows: DataFrame, name: str) -> DataFrame:
    """Box, ``_block``, ``_n`` and ``name``: its rows' other columns as an array, in blocks of at most ``BLOCK`` rows of one box."""
    rest = [c for c in rows.columns if c not in BOX]
    order = [*BOX, *rest]
    # the numbers of a range follow its order, so the rows of a box share as few blocks as can be
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_block", F.floor(F.monotonically_increasing_id() / BLOCK))
    return cut(placed.groupBy(*BOX, "_block").agg(F.count("*").alias("_n"), F.collect_list(F.struct(*rest)).alias(name)))


def _slices(name: str, n: int) -> Column:
    """A row for each ``n`` values of an array. The lambda keeps it out of generated code, so rows are passed on one by one."""
    return F.explode(F.transform(F.sequence(F.lit(1), F.size(name), F.lit(n)), lambda i: F.slice(name, i, F.lit(n)))).alias(name)


def overlaps(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every pair of rows whose boxes share area or an edge, with the shared ``area``; no boxes, and columns of ``right``
    come with the prefix ``r_``.

    Different boxes are compared once, then meet the rows that have them, in blocks. The pairs of blocks, each of
    ``BLOCK`` squared rows at most, are dealt over tasks, as many as the rows to be made ask for (counted first, one
    number), and rows are made only there, by tiles: what is made is the result.
    """
    spark = left.sparkSession
    own, other = _blocks(left, "_own"), _blocks(right, "_other")
    other = other.select(*(F.col(c).alias(c if c == "_other" else f"r_{c}") for c in other.columns))
    mine, theirs = list(BOX), [f"r_{c}" for c in BOX]
    boxes = other.select(*(F.col(f"r_{c}").alias(c) for c in BOX)).distinct()
    met = cut(intersecting(own.select(*BOX).distinct(), boxes).withColumn("area", overlap_area()))
    sizes = met.join(own.groupBy(*mine).agg(F.sum("_n").alias("_n")), mine).join(other.groupBy(*theirs).agg(F.sum("r__n").alias("r__n")), theirs)
    rows = sizes.agg(F.sum(F.col("_n") * F.col("r__n"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))
    pairs = met.join(own.hint("merge"), mine).join(other.hint("merge"), theirs)
    dealt = pairs.repartition(tasks, *mine, *theirs, "_block", "r__block")  # a number: pairs are few and small, their rows are not
    tiles = dealt.select("_own", _slices("_other", TILE[1]), "area").select(_slices("_own", TILE[0]), "_other", "area")
    names = [[c for c in df.columns if c not in BOX] for df in (left, right)]
    made = tiles.select(F.inline("_own").alias(*(f"_own_{c}" for c in names[0])), "_other", "area")
    made = made.select(*(f"_own_{c}" for c in names[0]), F.inline("_other").alias(*(f"_other_{c}" for c in names[1])), "area")
    return made.select(*(F.col(f"_own_{c}").alias(c) for c in names[0]), *(F.col(f"_other_{c}").alias(f"r_{c}") for c in names[1]), "area")


def scenes_for_areas(scenes: DataFrame, areas: DataFrame, item: str = "scene_id") -> DataFrame:
    """Scenes that meet any area, each once. Boxes are matched once, however many rows share them."""
    met = intersecting(scenes.select(*BOX).distinct(), areas.select(*BOX).distinct()).select(*BOX).distinct()
    return scenes.join(met, list(BOX), "left_semi").dropDuplicates([item])


def _shape(footprints: DataFrame, scenes: DataFrame) -> list[str]:
    """What two rows must share to cover the same area: their rings if both sides have them, else their boxes."""
    return ["ring"] if "ring" in footprints.columns and "ring" in scenes.columns else list(BOX)


def _covered(footprints: DataFrame, scenes: DataFrame, shape: Sequence[str]) -> DataFrame:
    """``ratio`` of each pair of different shapes that meet; columns of scenes come with the prefix ``r_``.

    Scenes whose ring is not valid are left out, convex ones clip the footprint, others go through trapezoids.
    """
    own, other = (cut(df.select(*shape).distinct()) for df in (footprints, scenes))
    if list(shape) == list(BOX):
        area = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
        return intersecting(own, other).withColumn("ratio", overlap_area() / area)
    # rings are judged once, however often the join below reads them
    fit = cut(polygons.with_bounds(other.where(polygons.valid(F.col("ring")))).withColumn("convex", polygons.convex(F.col("ring"))))
    pairs = cut(intersecting(polygons.with_bounds(own), fit))
    plain = pairs.where("r_convex").withColumn("_area", polygons.clipped_area(F.col("ring"), F.col("r_ring")))
    other_pairs = pairs.where("NOT r_convex").withColumns({"_a": F.array("ring"), "_b": F.array("r_ring")})
    both = plain.unionByName(polygons.with_shared_area(other_pairs, "_a", "_b", "_area").drop("_a", "_b"))
    return both.select("ring", "r_ring", (F.col("_area") / geometry.area(F.col("ring"))).alias("ratio"))


def candidates(footprints: DataFrame, scenes: DataFrame, min_overlap: float = 0.7, period: Sequence[str] = ()) -> DataFrame:
    """Footprint x scene pairs with the covered share of the footprint, of equal ``period`` (columns of both).

    Where both sides have a ``ring``, areas are those of the rings, else those of the boxes. Shapes are compared once,
    however many rows share them, and only pairs of rows whose shapes share enough are made.
    """
    shape = _shape(footprints, scenes)
    fit = cut(_covered(footprints, scenes, shape).where(F.col("ratio") >= min_overlap).select(*shape, *(f"r_{c}" for c in shape), "ratio"))
    named = scenes.select(*(F.col(c).alias(f"r_{c}") for c in scenes.columns))
    near = footprints.join(fit, list(shape))
    same = [F.col(p) == F.col(f"r_{p}") for p in period]
    return near.join(named, [near[f"r_{c}"].eqNullSafe(named[f"r_{c}"]) for c in shape] + same).drop(*(near[f"r_{c}"] for c in shape))


def count_candidates(footprints: DataFrame, scenes: DataFrame, item: str = "image_id", min_overlap: float = 0.7) -> DataFrame:
    """``item, n``: how many scenes cover enough of each footprint, NULL if none; scenes are counted by shape."""
    shape = _shape(footprints, scenes)
    pairs = candidates(cut(footprints.select(*shape).distinct()), cut(scenes.groupBy(*shape).agg(F.count("*").alias("n"))), min_overlap)
    counts = cut(pairs.groupBy(*shape).agg(F.sum("r_n").alias("n")))
    return footprints.select(item, *shape).join(counts, list(shape), "left").select(item, "n")


def _best(footprints: DataFrame, scenes: DataFrame, item: str, by: Sequence[str], of: Sequence[str], pairs: Callable[[DataFrame, DataFrame], DataFrame], score: Column) -> DataFrame:
    """The scene of the lowest score, then id, of each footprint, from its ``pairs``; none: NULL.

    Rows alike in their shape and in ``by`` (footprints) or ``of`` (scenes) have the same scores, so one row stands for
    all such footprints, and of such scenes only the lowest id can be best.
    """
    shape = _shape(footprints, scenes)
    alike, kind = list(dict.fromkeys([*shape, *by])), list(dict.fromkeys([*shape, *of]))
    own = cut(footprints.select(*alike).distinct())
    scored = pairs(own, cut(scenes.groupBy(*kind).agg(F.min("scene_id").alias("scene_id")))).withColumn("score", score)
    key = F.struct("score", "r_scene_id")
    best = cut(scored.groupBy(*alike).agg(F.min_by(F.struct(F.col("r_scene_id").alias("scene_id"), "ratio", "score"), key).alias("_b")))
    rows, same = footprints.select(item, *alike), [footprints[c].eqNullSafe(best[c]) for c in alike]
    return rows.join(best, same, "left").select(rows[item], "_b.scene_id", "_b.ratio", "_b.score")


def match_scenes(footprints: DataFrame, scenes: DataFrame, item: str = "image_id", day_range: int = 7, max_cloud: int = 20, min_overlap: float = 0.7) -> DataFrame:
    """The best scene of each footprint by cloud, overlap and time (lowest score, then id); none: NULL."""
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    seconds = F.abs(micros("r_ts") - micros("ts")) / 1e6
    reach = max(day_range, 1) * 86400 * 10**6  # a footprint meets scenes of the stretches of time that its range touches
    bin_ = lambda c, by=0: F.floor((micros(c) + by) / reach)
    near = lambda f: f.withColumn("_bin", F.explode(F.sequence(bin_("ts", -reach), bin_("ts", reach))))
    pairs = lambda f, s: candidates(near(f), s.withColumn("_bin", bin_("ts")), min_overlap, ["_bin"]).where(seconds <= day_range * 86400)
    score = F.pow((100 - F.col("r_cloud")) / 5, 2) + F.pow((100 - F.col("ratio") * 100) / 5, 2) + F.pow(seconds / (2 * 86400), 2)
    return _best(footprints, scenes.where(F.col("cloud") <= max_cloud), item, ["ts"], ["ts", "cloud"], pairs, score)


def match_mosaics(footprints: DataFrame, mosaics: DataFrame, period: Sequence[str], item: str = "image_id", min_overlap: float = 0.7) -> DataFrame:
    """The best mosaic of each footprint's own period (columns of both), by overlap alone."""
    pairs = lambda f, m: candidates(f, m, min_overlap, period)
    return _best(footprints, mosaics, item, period, period, pairs, F.pow((100 - F.col("ratio") * 100) / 5, 2))


def first_region(footprints: DataFrame, regions: DataFrame, item: str = "image_id", default: str = "No Region") -> DataFrame:
    """Name of the first region (by ``order``) that meets each footprint."""
    hit = intersecting(footprints, regions).groupBy(item).agg(F.min_by("r_name", "r_order").alias("name"))
    return footprints.select(item).join(hit, item, "left").select(item, F.coalesce("name", F.lit(default)).alias("name"))


def chosen_footprints(scenes: DataFrame, ids: DataFrame, item: str = "scene_id") -> DataFrame:
    """Scenes of the ids; the job fails if none of them is there."""
    found = scenes.join(ids.select(item).distinct(), item, "left_semi")
    if found.isEmpty():
        raise ValueError(f"no scene has any of the given values of {item}")
    return found


def areas_by_vintage(areas: DataFrame, year: str = "year") -> DataFrame:
    """Areas grouped by the trend product they need; without a year by every product."""
    vintages = F.when(F.col(year).isNull(), F.array(*map(F.lit, (2019, 2020, 2022, 2024)))).otherwise(F.array(trend_vintage(F.col(year))))
    return areas.withColumn("vintage", F.explode(vintages)).groupBy("vintage").agg(F.count("*").alias("n"), *(f(c).alias(c) for f, c in ((F.min, "xmin"), (F.min, "ymin"), (F.max, "xmax"), (F.max, "ymax"))))


def unprocessed(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return items.join(done.select(key).distinct(), key, "left_anti")

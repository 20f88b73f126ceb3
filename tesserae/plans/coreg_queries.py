"""Queries for co-registration, ledgers, training builds and the scene stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesserae.functions.storage import cut, shared_dir
from tesserae.operators import catalog, coreg, geometry, patches
from tesserae.plans.base import CELL, DECODED, decoded, pixels, query, r6
from tesserae.plans.patch_queries import _C as _PC, _KEPT, SIZE, _origins as patch_origins
from tesserae.sources import products, training
from tesserae.sources.adapters import HEIGHT, WIDTH, cte, load, table
from tesserae.streaming import ingest

_P = cte("pixels")
_MOVED = "b AS (SELECT tile_id, y + 2 AS y, x - 1 AS x, dem + prob_a * 3 AS dem FROM pixels)"


def _pair(spark, sf_dir):
    p = pixels(spark, sf_dir)
    return p.select(*CELL, "dem"), p.select("tile_id", (F.col("y") + 2).alias("y"), (F.col("x") - 1).alias("x"), (F.col("dem") + F.col("prob_a") * 3).alias("dem"))


def _surface(spark, sf_dir):
    """Shifts up to 10 cells over the middle window of each tile."""
    a, b = _pair(spark, sf_dir)
    window = coreg.valid_window(a, WIDTH, HEIGHT, 15, F.lit(True))
    return coreg.score_surface(coreg.in_window(a, window), b, "dem", 10)


_SURFACE = f"{_P}, {_MOVED}, s AS (SELECT a.tile_id, CAST(h.sx AS INT) AS sx, CAST(v.sy AS INT) AS sy, corr(a.dem, b.dem) AS score FROM pixels a CROSS JOIN range(-10, 11) h(sx) CROSS JOIN range(-10, 11) v(sy) JOIN b ON b.tile_id = a.tile_id AND b.y = a.y + v.sy AND b.x = a.x + h.sx WHERE a.y BETWEEN {HEIGHT // 2 - 7} AND {HEIGHT // 2 + 7} AND a.x BETWEEN {WIDTH // 2 - 7} AND {WIDTH // 2 + 7} GROUP BY a.tile_id, h.sx, v.sy)"


@query(f"{_SURFACE} SELECT tile_id, sx, sy, round(score, 5) + 0.0 AS score FROM s")
def l2_score_surface(spark, sf_dir):
    return _surface(spark, sf_dir).withColumn("score", r6("score", 5))


@query(
    f"{_SURFACE}, b0 AS (SELECT tile_id, sx AS bx, sy AS \"by\", score AS bs FROM (SELECT *, row_number() OVER (PARTITION BY tile_id ORDER BY score DESC) AS n FROM s) r WHERE n = 1), "
    "f AS (SELECT s.tile_id, bx, \"by\", bs, max(CASE WHEN sx = bx - 1 AND sy = \"by\" THEN score END) AS l, max(CASE WHEN sx = bx + 1 AND sy = \"by\" THEN score END) AS r, max(CASE WHEN sx = bx AND sy = \"by\" - 1 THEN score END) AS u, max(CASE WHEN sx = bx AND sy = \"by\" + 1 THEN score END) AS d, "
    "avg(CASE WHEN NOT (abs(sx - bx) <= 1 AND abs(sy - \"by\") <= 1) THEN score END) AS m, stddev_pop(CASE WHEN NOT (abs(sx - bx) <= 1 AND abs(sy - \"by\") <= 1) THEN score END) AS s, avg(CASE WHEN abs(sx - bx) <= 1 AND abs(sy - \"by\") <= 1 THEN score END) AS p FROM s JOIN b0 ON b0.tile_id = s.tile_id GROUP BY s.tile_id, bx, \"by\", bs) "
    "SELECT tile_id, round(bx + coalesce(sign(r - l) * greatest(l, r) / nullif(bs + greatest(l, r), 0), 0.0), 3) + 0.0 AS x_offset, round(\"by\" + coalesce(sign(d - u) * greatest(u, d) / nullif(bs + greatest(u, d), 0), 0.0), 3) + 0.0 AS y_offset, round(greatest(least(100 - 100 * (m + 2 * s) / p, 100.0), 0.0), 3) AS shift_reliability FROM f"
)
def l3_l4_shift_and_reliability(spark, sf_dir):
    p = coreg.peak(_surface(spark, sf_dir))
    return p.select("tile_id", r6("x_offset", 3).alias("x_offset"), r6("y_offset", 3).alias("y_offset"), r6("shift_reliability", 3).alias("shift_reliability"))




def _steps(size: int) -> str:
    """The spiral as rows of SQL: runs of 1, 1, 2, 2, 3, 3, ... steps right, down, left and up, up to the border."""
    y, x, rows, way, run = HEIGHT // 2 - size // 2, WIDTH // 2 - size // 2, [], 0, 0
    while True:
        for _ in range(run // 2 + 1):
            if not (0 <= y <= HEIGHT - size and 0 <= x <= WIDTH - size):
                return ", ".join(map(str, rows))
            rows.append((len(rows), y, x))
            dy, dx = ((0, 1), (1, 0), (0, -1), (-1, 0))[way % 4]
            y, x = y + dy, x + dx
        way, run = way + 1, run + 1


@query(
    f"{_P}, t AS (SELECT * FROM (VALUES {_steps(5)}) v(step, y, x)), w AS (SELECT t.step, a.tile_id, t.y AS y0, t.x AS x0, count(*) AS n, sum(CASE WHEN a.s2_scl = 0 THEN 1 ELSE 0 END) AS masked FROM t JOIN pixels a ON a.y BETWEEN t.y AND t.y + 4 AND a.x BETWEEN t.x AND t.x + 4 GROUP BY t.step, a.tile_id, t.y, t.x), "
    "g AS (SELECT *, row_number() OVER (PARTITION BY tile_id ORDER BY step) AS k FROM w WHERE n = 25 AND masked = 0) "
    f"SELECT d.tile_id, CAST(g.step AS INT) AS step, CAST(coalesce(y0, 0) AS INT) AS y0, CAST(coalesce(x0, 0) AS INT) AS x0, CASE WHEN g.step IS NULL THEN {HEIGHT} ELSE 5 END AS \"rows\", CASE WHEN g.step IS NULL THEN {WIDTH} ELSE 5 END AS cols FROM (SELECT DISTINCT tile_id FROM pixels) d LEFT JOIN g ON g.tile_id = d.tile_id AND g.k = 1"
)
def l1_valid_window(spark, sf_dir):
    return coreg.valid_window(pixels(spark, sf_dir), WIDTH, HEIGHT, 5, F.col("s2_scl") != 0)


_SSIM = (
    "u AS (SELECT tile_id, y, x, (a - min(a) OVER (PARTITION BY tile_id)) / (max(a) OVER (PARTITION BY tile_id) - min(a) OVER (PARTITION BY tile_id)) AS a, (b - min(b) OVER (PARTITION BY tile_id)) / (max(b) OVER (PARTITION BY tile_id) - min(b) OVER (PARTITION BY tile_id)) AS b FROM ab), "
    "m AS (SELECT p.tile_id, p.y, p.x, sum(q.a) / 49 AS ma, sum(q.b) / 49 AS mb, sum(q.a * q.a) / 49 AS maa, sum(q.b * q.b) / 49 AS mbb, sum(q.a * q.b) / 49 AS mab FROM u p JOIN u q ON q.tile_id = p.tile_id AND q.y BETWEEN p.y - 3 AND p.y + 3 AND q.x BETWEEN p.x - 3 AND p.x + 3 GROUP BY p.tile_id, p.y, p.x HAVING count(*) = 49), "
    "v AS (SELECT *, (maa - ma * ma) * 49 / 48 AS va, (mbb - mb * mb) * 49 / 48 AS vb, (mab - ma * mb) * 49 / 48 AS vab FROM m) "
    "SELECT tile_id, round(avg(((2 * ma * mb + 1e-4) * (2 * vab + 9e-4)) / ((ma * ma + mb * mb + 1e-4) * (va + vb + 9e-4))), 6) AS ssim FROM v GROUP BY tile_id"
)


@query(f"{_P}, ab AS (SELECT tile_id, y, x, dem AS a, dem + prob_a * 20 AS b FROM pixels), {_SSIM}")
def l5_structural_similarity(spark, sf_dir):
    p = pixels(spark, sf_dir).withColumns({"a": F.col("dem"), "b": F.col("dem") + F.col("prob_a") * 20})
    return coreg.similarity(p, "a", "b").withColumn("ssim", r6("ssim"))


_OFF = (
    "SELECT l_suppkey AS pair_id, CAST(l_orderkey AS STRING) || '-' || l_linenumber || '-' || l_partkey AS band, CASE WHEN l_suppkey % 3 = 0 THEN l_linenumber / 10 WHEN l_suppkey % 3 = 1 THEN l_linenumber / 4 ELSE l_linenumber * 3 END AS x_offset, "
    "l_linenumber / 8 AS y_offset, l_partkey / 50 + l_linenumber / 1000 AS shift_reliability, l_tax AS ssim_before, l_discount AS ssim_after FROM {lineitem}"
)


def offsets(spark, sf_dir):
    return spark.sql(_OFF, lineitem=table(spark, sf_dir, "lineitem"))


_O = f"WITH o AS ({_OFF.replace('{lineitem}', 'lineitem')})"


@query(f"{_O} SELECT pair_id, band, round(x_offset, 6) AS x_offset FROM o WHERE abs(x_offset) <= 10 AND abs(y_offset) <= 10 AND shift_reliability >= 30 AND ssim_after >= ssim_before")
def l6_valid_offsets(spark, sf_dir):
    return coreg.valid_offsets(offsets(spark, sf_dir)).select("pair_id", "band", r6("x_offset").alias("x_offset"))


def _pick(c: str) -> str:
    return f"round(CASE WHEN greatest(max({c}) - avg({c}), avg({c}) - min({c})) < 1 THEN avg({c}) WHEN stddev_pop({c}) < 1 THEN sum({c} * shift_reliability) / sum(shift_reliability) ELSE arg_max({c}, (shift_reliability, band)) END, 6) AS {c}"


@query(f"{_O} SELECT pair_id, {_pick('x_offset')}, {_pick('y_offset')}, round(max(shift_reliability), 6) AS shift_reliability, count(*) AS bands FROM o GROUP BY pair_id")
def g30_l7_reduce_offsets(spark, sf_dir):
    r = coreg.reduce_bands(offsets(spark, sf_dir))
    return r.withColumns({c: r6(c) for c in ("x_offset", "y_offset", "shift_reliability")})


@query(f"{_O}, r AS (SELECT pair_id, {_pick('x_offset')}, {_pick('y_offset')} FROM o GROUP BY pair_id) SELECT c_custkey AS tile_id, round(500000.0 + coalesce(r.x_offset, 0.0) * 10, 3) AS x0, round(4500000.0 + coalesce(r.y_offset, 0.0) * -10, 3) AS y0 FROM customer LEFT JOIN r ON r.pair_id = c_custkey")
def l8_l9_align_tiles(spark, sf_dir):
    r = coreg.reduce_bands(offsets(spark, sf_dir)).withColumnRenamed("pair_id", "tile_id").withColumns({c: F.round(c, 6) for c in ("x_offset", "y_offset")})
    tiles = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("tile_id"), F.lit(500000.0).alias("x0"), F.lit(4500000.0).alias("y0"), F.lit(10.0).alias("res_x"), F.lit(-10.0).alias("res_y"))
    return coreg.align_tiles(tiles, r).select("tile_id", "x0", "y0")


@query(f"{_P} SELECT DISTINCT tile_id, CAST(3 AS BIGINT) AS bands, CAST(tile_id * 3 % 7 - 3 AS INT) AS x_shift, CAST(tile_id % 5 - 2 AS INT) AS y_shift, true AS better, CAST(tile_id * 3 % 7 - 3 AS INT) AS label_cells FROM pixels")
def l8_l9_offsets_of_pairs(spark, sf_dir):
    """Every tile against itself moved by a shift of its own: what is estimated from the cells, and how far labels move."""
    p, tile = pixels(spark, sf_dir), F.col("tile_id")
    bump = F.exp(-(F.pow(F.col("x") - 25 - tile % 3, 2) + F.pow(F.col("y") - 15, 2)) / 4) * 1000
    seen = p.select(*CELL, *((bump * k + F.col(f"{b}_dn") / 200).alias(b) for k, b in enumerate(("red", "green", "nir"), 1)), (~((F.col("s2_scl") == 0) & (F.col("x") < 10))).alias("usable"))
    moved = seen.select("tile_id", (F.col("y") + tile % 5 - 2).alias("y"), (F.col("x") + tile * 3 % 7 - 3).alias("x"), *((F.col(b) * 1.1 + 5).alias(b) for b in ("red", "green", "nir")), "usable")
    found = coreg.pair_offsets(coreg.band_offsets(seen, moved, ("red", "green", "nir"), WIDTH, HEIGHT, size=15, most=6))
    tiles = p.select("tile_id").distinct().withColumns({"res_x": F.lit(10.0), "res_y": F.lit(-10.0)})
    labels = tiles.select("tile_id", geometry.box_ring(F.lit(0), F.lit(0), F.lit(50), F.lit(40)).alias("ring"))
    cells = F.round(-F.element_at("ring", 1)["x"] / 10).cast("int")
    shifted = coreg.align_labels(labels, tiles, found).select("tile_id", cells.alias("label_cells"))
    whole = lambda c: F.round(c).cast("int")
    return found.join(shifted, "tile_id").select("tile_id", "bands", whole("x_offset").alias("x_shift"), whole("y_offset").alias("y_shift"), (F.col("ssim_improvement") >= 0).alias("better"), "label_cells")


@query("SELECT c_custkey AS tile_id, 0.5::DOUBLE AS run_threshold, 'v2' AS run_model, true AS exported FROM customer")
def a16_export_metadata(spark, sf_dir):
    m = products.with_metadata(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("tile_id")), {"threshold": 0.5, "model": "v2"})
    return m.select("tile_id", F.col("RUN_THRESHOLD").alias("run_threshold"), F.col("RUN_MODEL").alias("run_model"), F.col("exported_at").isNotNull().alias("exported"))


@query(f"{_P} SELECT tile_id, CASE WHEN max(dem) > 249.8 AND tile_id % 3 = 1 THEN NULL ELSE '/out/' || tile_id END AS output_path, CASE WHEN max(dem) > 249.8 AND tile_id % 3 = 1 THEN 'failed' ELSE 'success' END AS status, CASE WHEN max(dem) > 249.8 AND tile_id % 3 = 1 THEN 'ValueError: too high' END AS error FROM pixels GROUP BY tile_id")
def a18_ledger(spark, sf_dir):
    def work(rows):
        if rows["dem"].max() > 249.8 and rows["tile_id"].iloc[0] % 3 == 1:
            raise ValueError("too high")
        return f"/out/{rows['tile_id'].iloc[0]}"

    return products.with_ledger(pixels(spark, sf_dir).select("tile_id", "y", "x", "dem"), work)


@query("SELECT o_orderkey, 11 + row_number() OVER (ORDER BY o_orderkey) - 1 AS z_idx FROM orders")
def a19_number_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return products.number_rows(o, spark.range(11).select(F.col("id").alias("z_idx")), "o_orderkey")


@query(
    f"{DECODED}, {cte('scenes', 'footprints').removeprefix('WITH ')}, c AS (SELECT f.image_id, count(*) AS n FROM footprints f JOIN scenes s ON s.cloud <= 20 AND s.xmin <= f.xmax AND f.xmin <= s.xmax AND s.ymin <= f.ymax AND f.ymin <= s.ymax WHERE (least(f.xmax, s.xmax) - greatest(f.xmin, s.xmin)) * (least(f.ymax, s.ymax) - greatest(f.ymin, s.ymin)) / 600 >= 0.7 GROUP BY f.image_id), m AS (SELECT f.image_id, coalesce(c.n, 0) AS n FROM footprints f LEFT JOIN c ON c.image_id = f.image_id), "
    "t AS (SELECT tile_id, count(*) AS cells, sum(CASE WHEN quality = 2 AND target = 1 THEN 1 ELSE 0 END) AS positives FROM decoded GROUP BY tile_id) SELECT m.image_id, CASE WHEN m.n = 0 THEN 'no match' WHEN t.cells IS NULL THEN 'no pixels' WHEN t.positives = 0 THEN 'empty' ELSE 'ready' END AS status, coalesce(t.positives, 0) AS positives FROM m LEFT JOIN t ON t.tile_id = m.image_id"
)
def g32_training_build(spark, sf_dir):
    """Footprints through matching, pixels and labels, with the state of each."""
    f = load(spark, sf_dir, "footprints")
    pairs = catalog.count_candidates(f, load(spark, sf_dir, "scenes").where("cloud <= 20"))
    d = decoded(spark, sf_dir)
    tiles = d.groupBy(F.col("tile_id").cast("long").alias("image_id")).agg(F.count("*").alias("cells"), F.sum(((F.col("quality") == 2) & (F.col("target") == 1)).cast("long")).alias("positives"))
    joined = pairs.join(tiles, "image_id", "left")
    status = F.when(F.col("n").isNull(), "no match").when(F.col("cells").isNull(), "no pixels").when(F.col("positives") == 0, "empty").otherwise("ready")
    return joined.select("image_id", status.alias("status"), F.coalesce("positives", F.lit(0)).alias("positives"))


@query(f"{_P}, d AS (SELECT tile_id, count(*) AS n, round(avg(CASE WHEN s2_scl <> 0 AND red_dn <> 0 THEN red_dn / 10000 - 0.1 END), 6) AS mean_red FROM pixels GROUP BY tile_id) SELECT tile_id, n, mean_red, 'success' AS status FROM d")
def n1s_resumable_stream(spark, sf_dir):
    """Tiles arrive as files of a stream; the second run finds nothing new."""
    import uuid

    base = f"{shared_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    source = decoded(spark, sf_dir).select(F.col("tile_id").alias("scene_id"), "red")
    source.groupBy("scene_id").agg(F.count("*").alias("n"), r6(F.avg("red")).alias("mean_red")).write.parquet(f"{base}/in")
    schema = spark.read.parquet(f"{base}/in").schema
    for _ in range(2):
        ingest.ingest(ingest.scene_stream(spark, f"{base}/in", schema), lambda rows: rows, f"{base}/out", f"{base}/ledger", f"{base}/state")
    out, ledger = spark.read.parquet(f"{base}/out"), spark.read.parquet(f"{base}/ledger")
    return out.join(ledger.select("scene_id", "status"), "scene_id").select(F.col("scene_id").alias("tile_id"), "n", "mean_red", "status")


@query("SELECT date_trunc('day', ts) AS day, CAST(event_id % 60 AS STRING) AS grid, count(*) AS n FROM events GROUP BY 1, 2")
def n1s_windowed_counts(spark, sf_dir):
    """Daily counts of a stream with a watermark, written out as they are at its end."""
    import uuid

    name = f"w{uuid.uuid4().hex}"
    base = f"{shared_dir(spark).rstrip('/')}/{name}"
    table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % 60).cast("string").alias("grid_code")).write.parquet(f"{base}/in")
    stream = ingest.scene_stream(spark, f"{base}/in", spark.read.parquet(f"{base}/in").schema)
    counts = ingest.windowed_counts(stream).select(F.col("window.start").alias("day"), F.col("grid_code").alias("grid"), "n")

    def store(rows, number):
        rows.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    q = counts.writeStream.outputMode("complete").foreachBatch(store).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    last = spark.read.parquet(f"{base}/out")
    return last.where(F.col("batch") == last.agg(F.max("batch")).first()[0]).select("day", "grid", "n")


@query(f"{_P}, t AS (SELECT DISTINCT tile_id FROM pixels) SELECT CAST(tile_id AS BIGINT) AS scene_id, CASE WHEN tile_id % 3 = 0 THEN 'missing' ELSE 'complete' END AS status, CASE WHEN tile_id % 3 = 0 THEN 'nir' ELSE '' END AS missing FROM t")
def n1s_tiles_from_bands(spark, sf_dir):
    """Bands of tiles in four batches, with repeats; every third tile never gets its last band."""
    import uuid

    base = f"{shared_dir(spark).rstrip('/')}/bands-{uuid.uuid4().hex}"
    tiles = pixels(spark, sf_dir).select(F.col("tile_id").cast("long").alias("scene_id")).distinct()
    at = lambda day: F.lit(f"2024-03-{day:02d} 00:00:00").cast("timestamp")
    part = lambda df, names, day: df.withColumn("band", F.explode(F.array(*map(F.lit, names)))).withColumn("ts", at(day))
    last = tiles.where("scene_id % 3 <> 0")
    batches = [part(tiles, ("blue", "green"), 1), part(tiles, ("red", "blue"), 2), part(last, ("nir", "nir"), 3), part(tiles.limit(1).select(F.lit(-1).cast("long").alias("scene_id")), ("red",), 30)]
    for rows in batches:
        rows.coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = ingest.scene_stream(spark, f"{base}/in", spark.read.parquet(f"{base}/in").schema, files_per_batch=1)
    found = ingest.tiles_from_bands(stream, ("blue", "green", "red", "nir"), late="1 day", patience_ms=10 * 86_400_000)

    def store(rows, number):
        rows.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    found.writeStream.foreachBatch(store).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out").drop("batch")


@query("SELECT CAST(event_id % 60 AS STRING) AS grid, count(*) AS n FROM events GROUP BY 1")
def n1s_unique_scenes(spark, sf_dir):
    """Scenes of a stream that brings each of them twice."""
    import uuid

    base = f"{shared_dir(spark).rstrip('/')}/unique-{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("scene_id"), F.col("ts").cast("timestamp").alias("ts"))
    for _ in range(2):
        rows.coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = ingest.scene_stream(spark, f"{base}/in", spark.read.parquet(f"{base}/in").schema, files_per_batch=1)

    def store(found, number):
        found.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    ingest.unique_scenes(stream, late="4000 days").writeStream.foreachBatch(store).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy((F.col("scene_id") % 60).cast("string").alias("grid")).agg(F.count("*").alias("n"))


@query(
    f"{_PC}, {_KEPT}, z AS (SELECT row_number() OVER (ORDER BY tile_id % 2, tile_id, patch_id) - 1 AS z_idx, tile_id, patch_id FROM k) SELECT z.z_idx, z.tile_id, z.patch_id, CAST(z.tile_id % 2 AS BIGINT) AS commit, "
    "CAST(sum(coalesce(CASE WHEN c.red IS NOT NULL THEN c.red_dn END, 0) * (c.dy * 16 + c.dx)) AS BIGINT) AS red, CAST(sum(c.target * (c.dy * 16 + c.dx)) AS BIGINT) AS target FROM z JOIN c ON c.tile_id = z.tile_id AND c.patch_id = z.patch_id GROUP BY z.z_idx, z.tile_id, z.patch_id"
)
def g32_training_set(spark, sf_dir):
    """The training set of all tiles in two commits, the second of which meets the first one's tiles again."""
    import uuid

    path = f"{shared_dir(spark).rstrip('/')}/training-{uuid.uuid4().hex}"
    d = decoded(spark, sf_dir).select(*CELL, "nir", "target", F.round((F.col("red") + 0.1) * 10000).alias("red"))
    tiles = d.select("tile_id").distinct()

    def build(new, first):
        cells = d.join(new, "tile_id", "left_semi")
        origins = patch_origins(cells)
        parts = patches.cut(cells, origins, SIZE)
        kept = patches.training_patches(parts, ["red", "nir"], "target", SIZE, min_labelled=0.9)
        meta = cut(patches.patch_metadata(kept, origins, first=first))
        x, y = products.split_values(cut(products.patch_values(parts, meta, ["red", "nir"], "target", SIZE)), ["red", "nir"])
        state = F.when(F.col("n").isNull(), "empty").otherwise("ready").alias("status")
        return {"x": x, "y": y, "metadata": meta, "items": new.join(meta.groupBy("tile_id").agg(F.count("*").alias("n")), "tile_id", "left").select("tile_id", state)}

    training.append(tiles.where("tile_id % 2 = 0"), "tile_id", path, build)
    training.append(tiles, "tile_id", path, build)
    dot = lambda v: F.aggregate(F.transform(v, lambda a, i: a.cast("double") * i), F.lit(0.0), lambda s, a: s + a).cast("long")
    x = training.read(spark, path, "x").where("band = 'red'").select("z_idx", dot("values").alias("red"))
    y = training.read(spark, path, "y").select("z_idx", dot("values").alias("target"))
    return training.read(spark, path, "metadata").select("z_idx", "tile_id", "patch_id", F.col("commit").cast("long").alias("commit")).join(x, "z_idx").join(y, "z_idx")

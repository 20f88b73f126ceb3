"""Queries over scene catalogues and footprints."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesserae.operators import catalog, geometry, volume
from tesserae.plans.base import query, r6
from tesserae.sources import products
from tesserae.sources.adapters import cte, load, table

_S = cte("scenes")
_SF = cte("scenes", "footprints")
_BANDS = ("blue", "green", "red", "nir")


def scenes(spark, sf_dir):
    return load(spark, sf_dir, "scenes")


def footprints(spark, sf_dir):
    return load(spark, sf_dir, "footprints")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, event_type || '-' || user_id AS meta_name, CAST(user_id % 2 = 0 AS INT) AS meta_even, '[' || user_id || ']' AS meta_ids FROM events")
def a3_flatten_properties(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.to_json(F.struct(F.get_json_object("props", "$.k").cast("int").alias("k"), F.struct(F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("name"), (F.col("user_id") % 2 == 0).alias("even"), F.array("user_id").alias("ids")).alias("meta"))).alias("p"))
    flat = catalog.flatten_properties(e, "p", "k int, meta struct<name:string,even:boolean,ids:array<bigint>>")
    return flat.toDF(*(c.replace(".", "_") for c in flat.columns))


@query("SELECT l_orderkey AS scene_id, 'EPSG:326' || lpad(CAST(min(c) AS STRING), 2, '0') AS code FROM (SELECT l_orderkey, 1 + l_suppkey % 2 * 59 AS c FROM lineitem) t GROUP BY l_orderkey HAVING count(DISTINCT c) = 1")
def a6_common_crs(spark, sf_dir):
    code = F.concat(F.lit("EPSG:326"), F.lpad((F.col("l_suppkey") % 2 * 59 + 1).cast("string"), 2, "0"))
    return catalog.common_crs(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("scene_id"), code.alias("code")))


def _stored(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    band = F.element_at(F.array(*map(F.lit, ("blue", "green", "red", "nir", "mask"))), (F.col("l_linenumber") % 5 + 1).cast("int"))
    return li.select(F.col("l_orderkey").alias("scene_id"), band.alias("band"), F.col("l_quantity").alias("value"))


_STORED = "stored AS (SELECT l_orderkey AS scene_id, ['blue', 'green', 'red', 'nir', 'mask'][l_linenumber % 5 + 1] AS band, l_quantity AS value FROM lineitem)"


@query(f"WITH {_STORED} SELECT o.o_orderkey AS scene_id, b.band FROM orders o CROSS JOIN (SELECT unnest(['blue', 'green', 'red', 'nir']) AS band) b WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.scene_id = o.o_orderkey AND s.band = b.band)")
def a7_missing_bands(spark, sf_dir):
    return catalog.missing_bands(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("scene_id")), _stored(spark, sf_dir), _BANDS)


@query(
    f"WITH {_STORED} SELECT o.o_orderkey AS scene_id, count(DISTINCT s.band) > 0 AS is_there, count(DISTINCT s.band) = 4 AS complete FROM orders o LEFT JOIN stored s ON s.scene_id = o.o_orderkey AND s.band <> 'mask' GROUP BY o.o_orderkey"
)
def a7_scene_completeness(spark, sf_dir):
    return catalog.completeness(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("scene_id")), _stored(spark, sf_dir), _BANDS)


@query(
    f"{cte('pixels')}, o AS (SELECT tile_id, y, x, red_dn AS red, nir_dn AS nir FROM pixels WHERE x % 3 <> 0), n AS (SELECT tile_id, y, x, green_dn AS green, nir_dn + 1 AS nir FROM pixels WHERE x % 2 = 0) "
    "SELECT coalesce(o.tile_id, n.tile_id) AS tile_id, coalesce(o.y, n.y) AS y, coalesce(o.x, n.x) AS x, coalesce(o.x, n.x) * 10 + 5 AS px, o.red, n.green, coalesce(n.nir, o.nir) AS nir FROM o FULL JOIN n ON o.tile_id = n.tile_id AND o.y = n.y AND o.x = n.x"
)
def a8_upsert_bands(spark, sf_dir):
    p = load(spark, sf_dir, "pixels").withColumn("px", F.col("x") * 10 + 5)
    keys = ["tile_id", "y", "x"]
    old = p.where(F.col("x") % 3 != 0).select(*keys, "px", F.col("red_dn").alias("red"), F.col("nir_dn").alias("nir"))
    new = p.where(F.col("x") % 2 == 0).select(*keys, "px", F.col("green_dn").alias("green"), (F.col("nir_dn") + 1).alias("nir"))
    return catalog.upsert_bands(old, new, keys, ["red", "green", "nir"], ["px"])


@query("SELECT c_custkey, c_acctbal, NULL AS s_suppkey FROM customer UNION ALL SELECT NULL, s_acctbal, s_suppkey FROM supplier")
def a10_concatenate_sources(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_acctbal").alias("c_acctbal"))
    return c.unionByName(s, allowMissingColumns=True)


@query("SELECT CAST(c_custkey AS STRING) AS id, '/data/tiles/' || c_custkey || '/scene.parquet' AS path FROM customer WHERE c_custkey IN (3, 14, 15, 92, 101)")
def a11_discover_tiles(spark, sf_dir):
    files = table(spark, sf_dir, "customer").select(F.concat(F.lit("/data/tiles/"), F.col("c_custkey").cast("string"), F.lit("/scene.parquet")).alias("path"))
    return catalog.discover(files, r"/tiles/([^/]+)/", ["3", "14", "15", "92", "101"])


@query(
    "WITH need AS (SELECT o_orderkey AS tile_id, p FROM orders CROSS JOIN (SELECT unnest(['p1', 'p2', 'p3']) AS p) u), got AS (SELECT DISTINCT l_orderkey, 'p' || l_linenumber AS p FROM lineitem) "
    "SELECT tile_id, CASE WHEN count(g.p) = 3 THEN 'all' WHEN count(g.p) > 0 THEN 'some' ELSE 'none' END AS state, 3 - count(g.p) AS missing FROM need n LEFT JOIN got g ON g.l_orderkey = n.tile_id AND g.p = n.p GROUP BY tile_id"
)
def a17_output_completeness(spark, sf_dir):
    tiles = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("tile_id"))
    listing = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("tile_id"), F.concat(F.lit("p"), F.col("l_linenumber").cast("string")).alias("product"))
    return products.output_state(tiles, listing, ["p1", "p2", "p3"])


@query(f"{_S} SELECT scene_id, cloud, snow FROM scenes WHERE cloud <= 20 AND snow <= 10")
def b1_cloud_and_snow_limits(spark, sf_dir):
    return catalog.limits(scenes(spark, sf_dir), 20, 10).select("scene_id", "cloud", "snow")


@query(f"{_S} SELECT scene_id, cloud, snow FROM scenes WHERE cloud < 20")
def b2_strict_limits(spark, sf_dir):
    return catalog.strict_limits(scenes(spark, sf_dir), 20, 0).select("scene_id", "cloud", "snow")


@query(f"{_S} SELECT scene_id, grid_code FROM scenes WHERE grid_code IN ('MGRS-4VXK', 'MGRS-33WDT')")
def b3_grid_tiles(spark, sf_dir):
    return catalog.in_tiles(scenes(spark, sf_dir), ["T4VXK", "33WDT"]).select("scene_id", "grid_code")


@query(f"{_S} SELECT scene_id FROM scenes WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12'")
def b4_date_range(spark, sf_dir):
    return catalog.in_period(scenes(spark, sf_dir), "2024-01-05", "2024-01-12", months=[7]).select("scene_id")


_DATED = "SELECT o_orderkey AS scene_id, o_orderdate AS ts, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, CAST(o_orderkey % 101 AS INT) AS cloud FROM orders"


def dated(spark, sf_dir):
    return spark.sql(_DATED.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))


@query(f"SELECT scene_id FROM ({_DATED}) d WHERE month IN (6, 7, 8) AND year IN (1996, 1997)")
def b5_months_and_years(spark, sf_dir):
    return catalog.in_period(dated(spark, sf_dir), months=[6, 7, 8], years=[1996, 1997]).select("scene_id")


@query(f"SELECT scene_id FROM ({_DATED}) d WHERE month IN (4, 5, 6, 10, 11, 12) AND year = 1996")
def b6_quarters(spark, sf_dir):
    return catalog.in_period(dated(spark, sf_dir), months=catalog.quarter_months([2, 4]), years=[1996]).select("scene_id")


@query(f"SELECT scene_id FROM ({_DATED}) d WHERE month IN (1, 7) AND year IN (1995, 1996)")
def b7_quarterly_mosaics(spark, sf_dir):
    return catalog.quarterly_mosaics(dated(spark, sf_dir), [1, 3], [1995, 1996]).select("scene_id")


@query(f"SELECT scene_id FROM ({_DATED}) d WHERE month IN (1, 5) AND year BETWEEN 1997 AND 2023")
def b8_bimonthly_mosaics(spark, sf_dir):
    return catalog.bimonthly_mosaics(dated(spark, sf_dir), ["01-02", "05-06"]).select("scene_id")


def _names(spark, sf_dir):
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    name = F.when(k % 4 == 0, F.concat(day, F.lit("_"), F.lpad((k % 86400).cast("string"), 6, "0"), F.lit("_1a2b"))).when(k % 4 == 1, F.concat((k % 9999).cast("string"), F.lit("_"), (k % 777).cast("string"), F.lit("_"), iso, F.lit("_0e19"))).when(k % 4 == 2, F.lit("20231345_101010_1a2b")).otherwise(F.concat(day, F.lit("_x")))
    return table(spark, sf_dir, "orders").select("o_orderkey", name.alias("name"), "o_orderdate")


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'scene' WHEN 1 THEN 'orthotile' ELSE 'invalid' END AS kind FROM orders")
def b10_scene_kinds(spark, sf_dir):
    return _names(spark, sf_dir).select("o_orderkey", catalog.scene_kind(F.col("name")).alias("kind"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (0, 3) THEN CAST(year(o_orderdate) AS INT) WHEN o_orderkey % 4 = 2 THEN 2023 END AS year_of_scene, CASE WHEN o_orderkey % 4 = 1 THEN CAST(year(o_orderdate) AS INT) END AS year_of_tile FROM orders")
def b11_year_from_id(spark, sf_dir):
    k = F.col("o_orderkey") % 4
    n = _names(spark, sf_dir)
    return n.select("o_orderkey", F.when(k != 1, catalog.id_year(F.col("name"), "planet_scene")).alias("year_of_scene"), F.when(k == 1, catalog.id_year(F.col("name"), "planet_orthotile")).alias("year_of_tile"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN date_trunc('day', o_orderdate) END AS acquired FROM orders")
def b12_date_from_id(spark, sf_dir):
    k = F.col("o_orderkey")
    name = F.when(k % 2 == 0, F.concat(F.lit("S2_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_TXX"))).otherwise(F.lit("odd_name"))
    return table(spark, sf_dir, "orders").select("o_orderkey", catalog.id_date(name).alias("acquired"))


@query("SELECT p_partkey, CASE WHEN p_size + 1990 <= 2018 THEN 2019 WHEN p_size + 1990 = 2019 THEN 2020 WHEN p_size + 1990 <= 2021 THEN 2022 ELSE 2024 END AS vintage FROM part")
def b13_trend_vintage(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", catalog.trend_vintage(F.col("p_size") + 1990).alias("vintage"))


@query("SELECT c_custkey AS image_id FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F') AND c_acctbal >= 100")
def b23_f15_unprocessed(spark, sf_dir):
    items = table(spark, sf_dir, "customer").where("c_acctbal >= 100").select(F.col("c_custkey").alias("image_id"))
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("image_id"))
    return catalog.unprocessed(items, done, "image_id")


@query("SELECT c_custkey AS cell, c_custkey % 181 - 90 AS lat FROM customer WHERE abs(c_custkey % 181 - 90) <= 60 AND c_mktsegment = 'MACHINERY'")
def b24_grid_selection(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    cells = c.select(F.col("c_custkey").alias("cell"), (F.col("c_custkey") % 181 - 90).alias("lat"))
    return volume.grid_selection(cells, c.select(F.col("c_custkey").alias("cell"), F.col("c_mktsegment").alias("kind")), 60, "MACHINERY")


@query(f"{_SF} SELECT s.scene_id FROM scenes s WHERE EXISTS (SELECT 1 FROM footprints f WHERE s.xmin <= f.xmax AND f.xmin <= s.xmax AND s.ymin <= f.ymax AND f.ymin <= s.ymax)")
def f6_scenes_for_areas(spark, sf_dir):
    return catalog.scenes_for_areas(scenes(spark, sf_dir), footprints(spark, sf_dir)).select("scene_id")


_RATIO = "(least(f.xmax, s.xmax) - greatest(f.xmin, s.xmin)) * (least(f.ymax, s.ymax) - greatest(f.ymin, s.ymin)) / ((f.xmax - f.xmin) * (f.ymax - f.ymin))"
_MEET = "s.xmin <= f.xmax AND f.xmin <= s.xmax AND s.ymin <= f.ymax AND f.ymin <= s.ymax"
_SECONDS = "abs(epoch_us(s.ts) - epoch_us(TIMESTAMP '2024-01-01' + to_days(f.day))) / 1e6"


@query(
    f"{_SF}, c AS (SELECT f.image_id, s.scene_id, s.cloud, {_RATIO} AS ratio, {_SECONDS} AS seconds FROM footprints f JOIN scenes s ON {_MEET} WHERE s.cloud <= 20), "
    "k AS (SELECT *, power((100 - cloud) / 5, 2) + power((100 - ratio * 100) / 5, 2) + power(seconds / (2 * 86400), 2) AS score FROM c WHERE ratio >= 0.7 AND seconds <= 7 * 86400), "
    "b AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score, scene_id) AS n FROM k) "
    "SELECT f.image_id, b.scene_id, round(b.ratio, 6) AS ratio, round(b.score, 6) AS score FROM footprints f LEFT JOIN b ON b.image_id = f.image_id AND b.n = 1"
)
def f7_match_scenes(spark, sf_dir):
    f = footprints(spark, sf_dir).withColumn("ts", F.expr("TIMESTAMP '2024-01-01' + make_dt_interval(day)"))
    m = catalog.match_scenes(f, scenes(spark, sf_dir))
    return m.select("image_id", "scene_id", r6("ratio").alias("ratio"), r6("score").alias("score"))


#: Scenes as boxes that lean by whole units; every seventh outline crosses itself and is left out.
_LEANING = f"{cte('footprints', 'scenes')}, g AS (SELECT *, scene_id % 21 - 10 AS lean FROM scenes WHERE scene_id % 7 <> 0), "


def _leaning(df):
    x0, y0, x1, y1, lean = (F.col(c).cast("double") for c in ("xmin", "ymin", "xmax", "ymax", "lean"))
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    leaning = F.array(point(x0, y0), point(x1, y0), point(x1 + lean, y1), point(x0 + lean, y1), point(x0, y0))
    crossed = F.array(point(x0, y0), point(x1, y1), point(x1, y0), point(x0, y1), point(x0, y0))
    return df.withColumn("lean", F.col("scene_id") % 21 - 10).withColumn("ring", F.when(F.col("scene_id") % 7 == 0, crossed).otherwise(leaning)).drop("lean", "xmin", "ymin", "xmax", "ymax")


@query(
    _LEANING + "m AS (SELECT f.image_id, f.xmin AS fx0, f.xmax AS fx1, f.ymin AS fy0, f.ymax AS fy1, f.day, g.scene_id, g.cloud, g.ts, g.xmin AS sx0, g.xmax AS sx1, g.ymin AS sy0, g.ymax AS sy1, g.lean / (g.ymax - g.ymin) AS k FROM footprints f JOIN g ON g.cloud <= 20 "
    "AND least(g.xmin, g.xmin + g.lean) <= f.xmax AND f.xmin <= greatest(g.xmax, g.xmax + g.lean) AND g.ymin <= f.ymax AND f.ymin <= g.ymax), "
    "b AS (SELECT *, greatest(fy0, sy0)::DOUBLE AS lo, least(fy1, sy1)::DOUBLE AS hi FROM m), "
    "h AS (SELECT *, list_sort(list_distinct(list_transform([lo, hi, sy0 + (fx0 - sx0) / nullif(k, 0), sy0 + (fx0 - sx1) / nullif(k, 0), sy0 + (fx1 - sx0) / nullif(k, 0), sy0 + (fx1 - sx1) / nullif(k, 0)], lambda v: least(greatest(coalesce(v, lo), lo), hi)))) AS ys FROM b), "
    "p AS (SELECT *, unnest(list_zip(ys[:-2], ys[2:])) AS z FROM h WHERE len(ys) > 1), "
    "a AS (SELECT image_id, scene_id, cloud, day, ts, (fx1 - fx0) * (fy1 - fy0) AS own, sum((z[2] - z[1]) * greatest(0, least(fx1, sx1 + k * ((z[1] + z[2]) / 2 - sy0)) - greatest(fx0, sx0 + k * ((z[1] + z[2]) / 2 - sy0)))) AS area FROM p GROUP BY ALL), "
    "c AS (SELECT *, area / own AS ratio, abs(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01' + to_days(day))) / 1e6 AS seconds FROM a), "
    "s AS (SELECT *, power((100 - cloud) / 5, 2) + power((100 - ratio * 100) / 5, 2) + power(seconds / (2 * 86400), 2) AS score FROM c WHERE ratio >= 0.5 AND seconds <= 7 * 86400), "
    "n AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score, scene_id) AS n FROM s) "
    "SELECT f.image_id, n.scene_id, round(n.ratio, 9) AS ratio, round(n.score, 7) AS score FROM footprints f LEFT JOIN n ON n.image_id = f.image_id AND n.n = 1"
)
def f7_match_scenes_by_rings(spark, sf_dir):
    """Scenes whose outlines lean, matched by the share of the footprint that they cover."""
    f = footprints(spark, sf_dir).withColumn("ts", F.expr("TIMESTAMP '2024-01-01' + make_dt_interval(day)"))
    f = f.withColumn("ring", geometry.box_ring(*(F.col(c) for c in catalog.BOX)))
    m = catalog.match_scenes(f, _leaning(scenes(spark, sf_dir)), min_overlap=0.5)
    return m.select("image_id", "scene_id", r6("ratio", 9).alias("ratio"), r6("score", 7).alias("score"))


def _match_sql(on: str) -> str:
    return (
        f"{_SF}, c AS (SELECT f.image_id, s.scene_id, {_RATIO} AS ratio FROM footprints f JOIN scenes s ON {_MEET} AND {on}), "
        "b AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY power((100 - ratio * 100) / 5, 2), scene_id) AS n FROM c WHERE ratio >= 0.7) "
        "SELECT f.image_id, b.scene_id, round(b.ratio, 6) AS ratio FROM footprints f LEFT JOIN b ON b.image_id = f.image_id AND b.n = 1"
    )


@query(_match_sql("s.scene_id % 4 = f.day % 4 AND s.scene_id % 3 = f.day % 3"))
def f8_match_quarterly_mosaics(spark, sf_dir):
    f = footprints(spark, sf_dir).withColumns({"quarter": (F.col("day") % 4).cast("long"), "year": (F.col("day") % 3).cast("long")})
    s = scenes(spark, sf_dir).withColumns({"quarter": F.col("scene_id") % 4, "year": F.col("scene_id") % 3})
    return catalog.match_mosaics(f, s, ["quarter", "year"]).select("image_id", "scene_id", r6("ratio").alias("ratio"))


@query(_match_sql("s.scene_id % 6 = f.day % 6"))
def f9_match_bimonthly_mosaics(spark, sf_dir):
    f = footprints(spark, sf_dir).withColumn("period", (F.col("day") % 6).cast("long"))
    s = scenes(spark, sf_dir).withColumn("period", F.col("scene_id") % 6)
    return catalog.match_mosaics(f, s, ["period"]).select("image_id", "scene_id", r6("ratio").alias("ratio"))


@query(
    f"{cte('footprints')}, r AS (SELECT n_nationkey, n_name, n_nationkey * 37 AS xmin, n_nationkey * 37 + 30 AS xmax, 0 AS ymin, 700 AS ymax FROM nation), "
    "h AS (SELECT f.image_id, min(r.n_nationkey) AS k FROM footprints f JOIN r ON r.xmin <= f.xmax AND f.xmin <= r.xmax AND r.ymin <= f.ymax AND f.ymin <= r.ymax GROUP BY f.image_id) "
    "SELECT f.image_id, coalesce(r.n_name, 'No Region') AS name FROM footprints f LEFT JOIN h ON h.image_id = f.image_id LEFT JOIN r ON r.n_nationkey = h.k"
)
def f10_first_region(spark, sf_dir):
    n = F.col("n_nationkey")
    regions = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), n.alias("order"), (n * 37).alias("xmin"), (n * 37 + 30).alias("xmax"), F.lit(0).alias("ymin"), F.lit(700).alias("ymax"))
    return catalog.first_region(footprints(spark, sf_dir), regions)


@query("SELECT o_custkey AS image_id, o_orderkey AS label_id FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)")
def f11_f13_labels_of_images(spark, sf_dir):
    images = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("image_id"))
    labels = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("image_id"), F.col("o_orderkey").alias("label_id"))
    return labels.join(images, "image_id")


@query(f"{_SF}, u AS (SELECT region, min(xmin) AS a, min(ymin) AS b, max(xmax) AS c, max(ymax) AS d FROM footprints GROUP BY region) SELECT u.region, count(*) AS n, min(s.scene_id) AS first, max(s.scene_id) AS last FROM scenes s JOIN u ON s.xmin <= u.c AND u.a <= s.xmax AND s.ymin <= u.d AND u.b <= s.ymax GROUP BY u.region")
def f14_tiles_in_extent(spark, sf_dir):
    """Scenes that meet the union extent of each region's footprints, counted."""
    extents = footprints(spark, sf_dir).groupBy("region").agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))
    met = catalog.intersecting(extents, scenes(spark, sf_dir))
    return met.groupBy("region").agg(F.count("*").alias("n"), F.min("r_scene_id").alias("first"), F.max("r_scene_id").alias("last"))


@query(
    f"{cte('footprints')}, y AS (SELECT *, CASE WHEN day % 7 = 0 THEN NULL ELSE day + 2000 END AS year FROM footprints), v AS (SELECT *, unnest(CASE WHEN year IS NULL THEN [2019, 2020, 2022, 2024] ELSE [CASE WHEN year <= 2018 THEN 2019 WHEN year = 2019 THEN 2020 WHEN year <= 2021 THEN 2022 ELSE 2024 END] END) AS vintage FROM y) "
    "SELECT vintage, count(*) AS n, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax FROM v GROUP BY vintage"
)
def f17_areas_by_vintage(spark, sf_dir):
    f = footprints(spark, sf_dir).withColumn("year", F.when(F.col("day") % 7 != 0, F.col("day") + 2000))
    return catalog.areas_by_vintage(f)


@query(f"{_S} SELECT scene_id, xmin, ymin, xmax, ymax, year FROM scenes WHERE scene_id IN (SELECT c_custkey FROM customer WHERE c_nationkey = 5)")
def f19_chosen_footprints(spark, sf_dir):
    chosen = table(spark, sf_dir, "customer").where("c_nationkey = 5").select(F.col("c_custkey").alias("scene_id"))
    return catalog.chosen_footprints(scenes(spark, sf_dir), chosen).select("scene_id", "xmin", "ymin", "xmax", "ymax", "year")


@query(f"{_S} SELECT grid_code, count(*) AS n, count(*) * 100.0::DOUBLE AS km2, CAST(count(*) * 1000000 AS BIGINT) AS pixels, round(count(*) * 1000000.0 * 8 / 1e9, 6) AS gb FROM scenes GROUP BY grid_code")
def g25_scenes_per_cell(spark, sf_dir):
    return volume.per_cell(scenes(spark, sf_dir)).withColumn("gb", r6("gb"))


@query(f"SELECT year, month, threshold, sum(CASE WHEN cloud <= threshold THEN 1 ELSE 0 END) AS n, sum(CASE WHEN cloud <= threshold THEN 1 ELSE 0 END) * 2.5::DOUBLE AS area FROM ({_DATED}) d CROSS JOIN (SELECT unnest([10, 20, 50, 100]) AS threshold) t GROUP BY year, month, threshold")
def g26_cumulative_cloud_counts(spark, sf_dir):
    return volume.under_cloud(dated(spark, sf_dir), [10, 20, 50, 100], 2.5)


@query(f"SELECT month, round(avg(n), 6) AS mean_scenes FROM (SELECT year, month, count(*) AS n FROM ({_DATED}) d WHERE month BETWEEN 5 AND 10 AND year <> 1998 GROUP BY year, month) m GROUP BY month")
def g27_monthly_averages(spark, sf_dir):
    m = volume.monthly_average(dated(spark, sf_dir), range(5, 11), [1998])
    return m.withColumn("mean_scenes", r6("mean_scenes"))


@query(f"{_S} SELECT scene_id, (xmax - xmin) * (ymax - ymin) * 1.0::DOUBLE AS km2, NULL::DOUBLE AS snow, cloud * 1.0::DOUBLE AS cloud, NULL::DOUBLE AS water, NULL::DOUBLE AS nodata, grid_code FROM scenes")
def g31_scene_statistics(spark, sf_dir):
    s = scenes(spark, sf_dir).withColumn("properties", F.to_json(F.struct("cloud")))
    return volume.scene_rows(s)


@query(f"{_S} SELECT grid_code, scene_id, rank FROM (SELECT grid_code, scene_id, row_number() OVER (PARTITION BY grid_code ORDER BY cloud, scene_id) AS rank FROM scenes) r WHERE rank <= 3")
def r1_top_scenes_per_cell(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("grid_code").orderBy("cloud", "scene_id")
    return scenes(spark, sf_dir).select("grid_code", "scene_id", F.row_number().over(w).alias("rank")).where("rank <= 3")


@query(f"{_S} SELECT DISTINCT scene_id FROM (SELECT scene_id FROM scenes WHERE cloud <= 5 UNION SELECT scene_id FROM scenes WHERE snow = 0) u WHERE scene_id NOT IN (SELECT scene_id FROM scenes WHERE scene_id % 2 = 0)")
def r2_scene_sets(spark, sf_dir):
    s = scenes(spark, sf_dir)
    union = s.where("cloud <= 5").select("scene_id").unionByName(s.where("snow = 0").select("scene_id")).dropDuplicates(["scene_id"])
    return union.join(s.where("scene_id % 2 = 0").select("scene_id"), "scene_id", "left_anti")

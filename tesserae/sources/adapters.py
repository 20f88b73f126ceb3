"""The driver's tables in the shapes of this library: pixels, scenes, footprints, runs and so on.

Each adapter is one SELECT in the SQL that Spark and DuckDB share, over integers derived from keys and cents, so that
both engines agree bit for bit. A tile is a grid of 30 rows and 50 columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

WIDTH, HEIGHT = 50, 30

PIXELS = """SELECT CAST(floor(o_orderkey / 1500) AS INT) AS tile_id, CAST(floor((o_orderkey % 1500) / 50) AS INT) AS y, CAST(o_orderkey % 50 AS INT) AS x,
 CAST(c % 3001 AS INT) AS blue_dn, CAST((c * 7) % 3501 AS INT) AS green_dn, CAST(floor(c / 11) % 4001 AS INT) AS red_dn, CAST(floor(c / 13) % 6001 AS INT) AS nir_dn,
 CAST(c % 12 AS INT) AS s2_scl, CAST(floor(c / 17) % 9 AS INT) AS s2_observations, CAST(floor(c / 19) % 5 AS INT) / 4 AS clear_sky,
 200 + CAST(floor(c / 23) % 400 AS INT) / 8 AS dem, CAST(floor(c / 29) % 1000 AS INT) / 1000 AS prob_a, CAST(floor(c / 31) % 1000 AS INT) / 1000 AS prob_b,
 CASE WHEN floor(c / 37) % 10 < 3 THEN 1 WHEN floor(c / 37) % 10 = 9 THEN 2 ELSE 0 END AS target
 FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM {orders}) o"""

SCENES = """SELECT event_id AS scene_id, ts, CAST(abs(CAST(round(value * 100) AS BIGINT)) % 101 AS INT) AS cloud, CAST(user_id % 40 AS INT) AS snow,
 concat('MGRS-', CAST(event_id % 60 AS STRING), CASE WHEN event_id % 2 = 0 THEN 'VXK' ELSE 'WDT' END) AS grid_code,
 CAST(event_id * 37 % 1000 AS INT) AS xmin, CAST(event_id * 53 % 1000 AS INT) AS ymin, CAST(event_id * 37 % 1000 + 40 AS INT) AS xmax, CAST(event_id * 53 % 1000 + 40 AS INT) AS ymax,
 CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month FROM {events}"""

FOOTPRINTS = """SELECT c_custkey AS image_id, CAST(c_custkey % 30 AS INT) AS day, CAST(c_custkey * 41 % 980 AS INT) AS xmin, CAST(c_custkey * 59 % 980 AS INT) AS ymin,
 CAST(c_custkey * 41 % 980 + 30 AS INT) AS xmax, CAST(c_custkey * 59 % 980 + 20 AS INT) AS ymax, c_nationkey AS region FROM {customer}"""

RUNS = """SELECT CAST(p_partkey AS BIGINT) AS trial, CAST(p_partkey % 15 AS INT) AS run, CAST(p_partkey % 5 AS INT) AS fold, CAST(floor(p_partkey / 5) % 3 AS INT) AS seed,
 CAST(CAST(round(p_retailprice * 100) AS BIGINT) % 1000 AS INT) / 1000 AS jaccard, p_size / 50 AS recall, (CAST(round(p_retailprice * 100) AS BIGINT) % 700 + 1) / 1000 AS loss FROM {part}"""

PATCHES = """SELECT l_suppkey AS sample_id, CAST(l_suppkey % 7 AS INT) AS region, l_discount < 0.05 AS is_empty, l_orderkey, l_linenumber, l_partkey FROM {lineitem}"""

NAMES = {"pixels": (PIXELS, "orders"), "scenes": (SCENES, "events"), "footprints": (FOOTPRINTS, "customer"), "runs": (RUNS, "part"), "patches": (PATCHES, "lineitem")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An adapter by name."""
    sql, source = NAMES[name]
    return spark.sql(sql, **{source: table(spark, sf_dir, source)})


def cte(*names: str) -> str:
    """The same adapters as the start of a DuckDB statement."""
    parts = []
    for name in names:
        sql, source = NAMES[name]
        parts.append(f"{name} AS ({sql.replace('{' + source + '}', source)})")
    return "WITH " + ", ".join(parts)

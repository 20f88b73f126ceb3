"""Registration of queries with their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tesserae.functions.safe import places
from tesserae.operators import bands
from tesserae.sources import adapters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function ``(spark, sf_dir) -> DataFrame`` under its name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.load(spark, sf_dir, "pixels")


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands.decode_scene(pixels(spark, sf_dir))


def rounded(df: DataFrame, names: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({n: places(F.col(n), digits) for n in names})


def r6(c: Column | str, digits: int = 6) -> Column:
    return places(F.col(c) if isinstance(c, str) else c, digits)


CELL = ("tile_id", "y", "x")
_QUALITY = "CASE WHEN s2_scl IN (0, 1) THEN 0 WHEN s2_scl IN (2, 4, 5, 6, 7, 10) THEN 2 ELSE 1 END"
_BANDS = ", ".join(f"CASE WHEN s2_scl <> 0 AND {b}_dn <> 0 THEN {b}_dn / 10000 - 0.1 END AS {b}" for b in bands.OPTICAL)
#: Decoded pixels as CTEs of a DuckDB statement.
DECODED = f"{adapters.cte('pixels')}, decoded AS (SELECT *, {_BANDS}, {_QUALITY} AS quality FROM pixels)"

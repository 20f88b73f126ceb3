"""Registered queries against DuckDB on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
ORACLES = entry.base.ORACLES

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v.replace(tzinfo=None)) if isinstance(v, datetime.datetime) else repr(v)


@pytest.mark.parametrize("name", sorted(set(ORACLES)))
def test_against_duckdb(spark, con, name):
    df = entry.base.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    found = con.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="the driver's tables are not here")
def test_equal_footprints_are_intersected_once(spark, monkeypatch):
    from tesserae.operators import polygons

    given, whole = [], polygons.with_shared_area
    monkeypatch.setattr(polygons, "with_shared_area", lambda pairs, *a: given.append(pairs) or whole(pairs, *a))
    assert entry.base.QUERIES["k3_k4_polygon_intersection"](spark, "/root/testdata/sf0.1").count() > given[0].count() == given[0].distinct().count()

"""Commits of a training set, and state between batches of a stream."""

import datetime

import pytest
from pyspark.sql import functions as F

from tesserae.functions.rank import numbered
from tesserae.sources import training
from tesserae.streaming import ingest


def build(new, first):
    meta = numbered(new.where("id <> 3"), ["id"], "z_idx", first)
    return {"metadata": meta, "x": meta.select("z_idx", (F.col("id") * 10).alias("v")), "items": new.select("id", F.when(F.col("id") == 3, "empty").otherwise("ready").alias("status"))}


def test_commits(spark, tmp_path):
    path = f"{tmp_path}/set"
    items = spark.range(8)
    assert training.read(spark, path, "x") is None
    assert training.append(items.where("id < 5"), "id", path, build) == 0

    def broken(new, first):
        tables = build(new, first)
        return tables | {"y": tables["x"].withColumn("v", F.raise_error(F.lit("disk full")).cast("long"))}

    with pytest.raises(Exception, match="disk full"):
        training.append(items, "id", path, broken)
    assert training.read(spark, path, "metadata").count() == 4  # nothing of the broken build is seen
    (tmp_path / "set/manifest/commit=1/_temporary").mkdir(parents=True)  # a row that was begun
    assert training.append(items, "id", path, build) == 1
    assert training.append(items, "id", path, build) is None
    got = training.read(spark, path, "metadata").join(training.read(spark, path, "x").drop("commit"), "z_idx").orderBy("z_idx").collect()
    assert [(r["z_idx"], r["id"], r["commit"], r["v"]) for r in got] == [(z, i, c, i * 10) for z, (i, c) in enumerate([(0, 0), (1, 0), (2, 0), (4, 0), (5, 1), (6, 1), (7, 1)])]
    assert training.read(spark, path, "items").where("status = 'empty'").count() == 1
    with pytest.raises(RuntimeError):
        training._record(spark, path, 1, ("other", 4, 9, ["x"]))


def test_tiles_from_bands(spark, tmp_path):
    """Bands in different batches, repeats late and early, a tile that waits too long, and one that goes on waiting."""
    day = lambda d: datetime.datetime(2024, 1, d)
    batches = [
        [("a", "red", day(1)), ("b", "red", day(1)), ("a", "red", day(1))],
        [("a", "nir", day(2)), ("c", "nir", day(2)), ("c", "odd", day(2))],
        [("a", "red", day(3)), ("c", "red", day(3)), ("d", "nir", day(3))],
        [("d", "nir", day(9)), ("e", "red", day(9))],
        [("f", "red", day(10))],
    ]
    for rows in batches:
        spark.createDataFrame(rows, "scene_id string, band string, ts timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    for _ in range(2):  # a restart has nothing to add
        stream = ingest.scene_stream(spark, f"{tmp_path}/in", schema, files_per_batch=1)
        found = ingest.tiles_from_bands(stream, ("red", "nir"), late="1 day", patience_ms=4 * 86_400_000)
        store = lambda df, n: df.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}")
        found.writeStream.foreachBatch(store).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").drop("batch").collect())
    assert got == [("a", "complete", ""), ("b", "missing", "nir"), ("c", "complete", "")]


def test_unique_scenes(spark, tmp_path):
    rows = [(k % 5, datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=k)) for k in range(20)]
    for part in (rows[:9], rows[9:], rows[:3]):
        spark.createDataFrame(part, "scene_id int, ts timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = ingest.scene_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, files_per_batch=1)
    store = lambda df, n: df.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}")
    ingest.unique_scenes(stream).writeStream.foreachBatch(store).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["scene_id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [0, 1, 2, 3, 4]

"""A training set that grows by commits of several tables.

The tables of a commit are written under a name of their own; a row in the manifest makes them part of the set. Readers
take what the manifest names, so the parts of a build that broke are never seen, and a rerun starts where the last
commit ended.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

MANIFEST = "part string, first long, next long, tables array<string>, commit long"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``commit, part, first, next, tables`` of every commit; empty if there is none."""
    try:
        return spark.read.schema(MANIFEST).json(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def read(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """A table of the set with the number of each row's ``commit``; None before the first commit that has it."""
    parts = manifest(spark, path).where(F.array_contains("tables", name)).orderBy("commit").collect()  # a row a commit
    found = None
    for row in parts:
        part = spark.read.parquet(f"{path}/data/{row['part']}/{name}").withColumn("commit", F.lit(row["commit"]))
        found = part if found is None else found.unionByName(part, allowMissingColumns=True)
    return found


def _record(spark: SparkSession, path: str, number: int, row: tuple) -> None:
    """Write a commit's row; fails if another build has written that commit meanwhile."""
    target = f"{path}/manifest/commit={number}"
    one = spark.createDataFrame([row], "part string, first long, next long, tables array<string>").coalesce(1)
    try:
        one.write.mode("error").json(target)
    except AnalysisException as e:
        if e.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        if manifest(spark, path).where(F.col("commit") == number).count():
            raise RuntimeError(f"commit {number} was written by another build") from e
        one.write.mode("overwrite").json(target)  # a row that was begun and never finished


def append(items: DataFrame, key: str, path: str, build: Callable[[DataFrame, int], Mapping[str, DataFrame]]) -> int | None:
    """Add the items that no commit has yet, and return the commit's number; None if there are none.

    ``build`` takes the new items and the first free number, and gives the tables to write: ``metadata`` with ``z_idx``
    from that number on, ``items`` with the ``key`` of every new item, skipped ones too, and any others. All of them
    count once the manifest has the commit, or none does.
    """
    spark = items.sparkSession
    last = manifest(spark, path).agg(F.coalesce(F.max("commit") + 1, F.lit(0)).alias("commit"), F.coalesce(F.max("next"), F.lit(0)).alias("first")).first()
    done = read(spark, path, "items")
    new = items if done is None else items.join(done.select(key).distinct(), key, "left_anti")
    if new.isEmpty():
        return None
    part = uuid.uuid4().hex
    tables = build(new, last["first"])
    for name, df in tables.items():
        df.write.parquet(f"{path}/data/{part}/{name}")
    rows = spark.read.parquet(f"{path}/data/{part}/metadata").count()
    _record(spark, path, last["commit"], (part, last["first"], last["first"] + rows, sorted(tables)))
    return last["commit"]

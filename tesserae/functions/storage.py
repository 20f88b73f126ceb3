"""Cutting lineage through a folder that every machine of the cluster can read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; in plain local mode a temporary one if that is unset."""
    context = spark.sparkContext
    path = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="tesserae-")
        context.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again: short lineage, no lost blocks."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")  # the written table stands for the shuffles that made it
    try:
        df.select("*").write.option("compression", "zstd").parquet(path)  # a new plan, made under the setting
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def cut_parts(df: DataFrame, by: str, values: list[int]) -> list[DataFrame]:
    """``cut`` with the rows of each value of the integer ``by`` in a folder of their own, as tables without ``by``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    for value in values:  # a value without rows is an empty table
        spark.createDataFrame([], df.drop(by).schema).coalesce(1).write.parquet(f"{path}/{by}={value}")
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.select("*").write.mode("append").option("compression", "zstd").partitionBy(by).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return [spark.read.schema(df.drop(by).schema).parquet(f"{path}/{by}={value}") for value in values]


def discard(tables: list[DataFrame]) -> None:
    """Free the space of tables made by ``cut`` that nothing reads any more: empty ones take their place."""
    for df in tables:
        spark = df.sparkSession
        path = next(iter(df.inputFiles()), None)
        if path:
            spark.createDataFrame([], df.schema).coalesce(1).write.mode("overwrite").parquet(path.rpartition("/")[0])

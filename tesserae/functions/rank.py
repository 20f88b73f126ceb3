"""Running numbers over a whole table without bringing it to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tesserae.functions.storage import cut


def numbered(df: DataFrame, order: Sequence[str | Column], name: str, first: int = 0) -> DataFrame:
    """``df`` with ``name``: its rows' numbers in the order (total), from ``first`` on.

    Rows are dealt by ranges of the order and numbered within each; what comes before a range is a sum over as many
    rows as there are ranges.
    """
    keys = {f"_o{i}": (F.col(o) if isinstance(o, str) else o) for i, o in enumerate(order)}
    dealt = cut(df.withColumns(keys).repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()))
    counts = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*keys))
    return dealt.join(F.broadcast(starts), "_range").withColumn(name, F.col("_before") + own - 1 + F.lit(first)).select(*df.columns, name)

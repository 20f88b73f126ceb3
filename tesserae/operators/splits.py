"""Reproducible splits, folds and subsamples, and statistics of patches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tesserae.functions.rank import numbered


def _order(seed: int, *keys: str) -> Column:
    return F.xxhash64(F.lit(seed), *keys)


def split_by_value(meta: DataFrame, column: str, values: Sequence) -> DataFrame:
    """``part``: test for rows with one of the values, train for the rest."""
    return meta.withColumn("part", F.when(F.col(column).isin(list(values)), "test").otherwise("train"))


def split_random(meta: DataFrame, key: str, train_share: float, positive: Column, tries: int = 100) -> DataFrame:
    """The first ``train_share`` of rows in hash order train; seeds are tried until the test part has a positive.

    Places come from counts by hash bucket, so no task orders all rows.
    """
    n = meta.count()
    keep = round(n * train_share)
    for seed in range(tries):
        found = _head(meta, key, keep, seed)
        if seed == tries - 1 or found.where((F.col("part") == "test") & positive).limit(1).count():
            return found
    raise AssertionError


def _head(meta: DataFrame, key: str, keep: int, seed: int, name: str = "part") -> DataFrame:
    buckets = 1024
    h = _order(seed, key)
    rows = meta.withColumns({"_h": h, "_b": F.shiftrightunsigned(h, 54)})
    counts = rows.groupBy("_b").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    assert buckets == 1024  # the window above has one row for each bucket
    placed = rows.join(F.broadcast(before), "_b").withColumn("_k", F.col("_before") + F.row_number().over(Window.partitionBy("_b").orderBy("_h", key)))
    return placed.withColumn(name, F.when(F.col("_k") <= keep, "train").otherwise("test")).drop("_h", "_b", "_before", "_k")


def no_split(meta: DataFrame) -> DataFrame:
    """Every row in both parts."""
    return meta.withColumn("part", F.explode(F.array(F.lit("train"), F.lit("test"))))


def contiguous_folds(meta: DataFrame, order: str, k: int, n: int | None = None) -> DataFrame:
    """``fold`` 0..k-1 of contiguous, equally long pieces (the first ones are longer by one); ``order`` is dense from 0."""
    n = meta.count() if n is None else n
    long, short = n % k, n // k
    edge = long * (short + 1)
    at = F.col(order)
    return meta.withColumn("fold", F.when(at < edge, F.floor(at / (short + 1))).otherwise(F.lit(long) + F.floor((at - edge) / max(short, 1))).cast("int"))


def stratified_folds(meta: DataFrame, key: str, stratum: str, k: int, seed: int = 0) -> DataFrame:
    """Folds of equal shares of each stratum, in hash order; strata are cut into hash buckets first."""
    h = _order(seed, key)
    rows = meta.withColumns({"_h": h, "_b": F.shiftrightunsigned(h, 54)})
    counts = rows.groupBy(stratum, "_b").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(stratum).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    placed = rows.join(before, [stratum, "_b"]).withColumn("_k", F.col("_before") + F.row_number().over(Window.partitionBy(stratum, "_b").orderBy("_h", key)))
    return placed.withColumn("fold", ((F.col("_k") - 1) % k).cast("int")).drop("_h", "_b", "_before", "_k")


def shuffled_folds(meta: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    return meta.withColumn("fold", F.pmod(_order(seed, key), F.lit(k)).cast("int"))


def group_folds(meta: DataFrame, group: str, k: int, seed: int = 0, stratum: Column | None = None) -> DataFrame:
    """Whole groups go to folds: by size of the group (of its stratum cells if given), then hash, dealt in turn."""
    weight = F.sum(stratum.cast("long")) if stratum is not None else F.count("*")
    groups = meta.groupBy(group).agg(weight.alias("_w"))
    dealt = numbered(groups, [-F.col("_w"), _order(seed, group), group], "_k").withColumn("fold", (F.col("_k") % k).cast("int"))
    return meta.join(dealt.select(group, "fold"), group)


def subsample(meta: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """The first ``n`` rows in hash order, or all if there are fewer; placed as by ``split_random``, not in one task."""
    return _head(meta, key, n, seed, "_part").where(F.col("_part") == "train").drop("_part")


def select_bands(df: DataFrame, keys: Sequence[str], bands: Sequence[str]) -> DataFrame:
    unknown = [b for b in bands if b not in df.columns]
    if unknown:
        raise ValueError(f"unknown bands: {unknown}")
    return df.select(*keys, *bands)


def split_statistics(meta: DataFrame, by: Sequence[str] = ("part",), empty: str = "is_empty", region: str = "region", sample: str = "sample_id") -> DataFrame:
    return meta.groupBy(*by).agg(F.count_if(~F.col(empty)).alias("positives"), F.count_if(F.col(empty)).alias("negatives"), F.count("*").alias("total"), F.count_distinct(region).alias("regions"), F.count_distinct(sample).alias("samples"))


def by_region(meta: DataFrame, region: str = "region", empty: str = "is_empty") -> DataFrame:
    return meta.groupBy(region).agg(F.count_if(F.col(empty)).alias("empty_patches"), F.count_if(~F.col(empty)).alias("non_empty_patches"))


def dissolve(meta: DataFrame, sample: str = "sample_id", empty: str = "is_empty") -> DataFrame:
    """Each sample's non-empty patches and the area-weighted middle of its patches' boxes."""
    a = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    middle = lambda lo, hi: F.try_divide(F.sum(a * (F.col(lo) + F.col(hi)) / 2), F.sum(a))
    return meta.groupBy(sample).agg(F.count_if(~F.col(empty)).alias("non_empty"), middle("xmin", "xmax").alias("cx"), middle("ymin", "ymax").alias("cy"))

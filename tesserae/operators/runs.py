"""Scores of runs, trials and timers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def _split(metric: str) -> tuple[str, bool]:
    name, _, way = metric.partition(":")
    return name, way == "lower"


def unstable(metrics: Sequence[str]) -> Column:
    """Whether any metric is missing, not finite or 0; suffixes of the names do not count."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")) | (c == 0)
    return reduce(lambda a, b: a | b, [bad(F.col(_split(m)[0]).cast("double")) for m in metrics])


def _value(metric: str) -> Column:
    name, lower = _split(metric)
    c = F.col(name).cast("double")
    return F.try_divide(F.lit(1.0), c) if lower else c


def combined(metrics: Sequence[str], how: str) -> Column:
    """One run's metrics in one number: harmonic, arithmetic, geometric mean or least. One metric stands for itself."""
    if len(metrics) == 1:
        return F.col(_split(metrics[0])[0]).cast("double")
    v = [_value(m) for m in metrics]
    if how == "harmonic":
        return F.try_divide(F.lit(float(len(v))), reduce(lambda a, b: a + b, [F.try_divide(F.lit(1.0), c) for c in v]))
    if how == "geometric":
        return F.pow(reduce(lambda a, b: a * b, v), 1.0 / len(v))
    if how == "arithmetic":
        return reduce(lambda a, b: a + b, v) / len(v)
    if how == "min":
        return F.least(*v)
    raise ValueError(f"no such mean: {how}")


def run_score(metrics: Sequence[str], how: str) -> Column:
    """Score of one run; an unstable run has 0 under the harmonic and geometric mean."""
    score = combined(metrics, how)
    return F.when(unstable(metrics), 0.0).otherwise(score) if how in ("harmonic", "geometric") else score


def group_score(runs: DataFrame, metrics: Sequence[str], how: str, by: str = "run") -> DataFrame:
    """Mean score of each group; unstable runs do not count under harmonic and geometric means, none left: 0."""
    kept = F.when(~unstable(metrics), combined(metrics, how)) if how in ("harmonic", "geometric") else combined(metrics, how)
    return runs.groupBy(by).agg(F.coalesce(F.avg(kept), F.lit(0.0)).alias("score"), F.bool_or(unstable(metrics)).alias("is_unstable"))


def with_summary(runs: DataFrame, metrics: Sequence[str], how: str, by: str = "run") -> DataFrame:
    """Every run row with the score and stability of its group."""
    return runs.join(group_score(runs, metrics, how, by), by)


def best(scored: DataFrame, by: str = "run") -> DataFrame:
    """The stable group with the highest score over 0; the smallest name of equals."""
    return scored.where(~F.col("is_unstable") & (F.col("score") > 0)).agg(F.max_by(F.struct(by, "score"), F.struct("score", (-F.col(by)).alias("_o"))).alias("b")).select("b.*").where(f"{by} IS NOT NULL")


def timer_summary(timers: DataFrame, step: str = "step", seconds: str = "seconds") -> DataFrame:
    return timers.groupBy(step).agg(F.avg(seconds).alias("mean"), F.stddev_samp(seconds).alias("std"), F.count(seconds).alias("n"), F.sum(seconds).alias("total"))


def long_form(wide: DataFrame, keys: Sequence[str], steps: Sequence[str]) -> DataFrame:
    return wide.unpivot(list(keys), list(steps), "step", "seconds")


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold nothing but NULL (one pass for the counts)."""
    counts = df.agg(*(F.count(c).alias(c) for c in df.columns)).first()
    return df.select(*(c for c in df.columns if counts[c]))

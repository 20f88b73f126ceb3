"""Joins of a large table with hot keys and a smaller one with distinct keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: Copies of the smaller table, so that the rows with one key are dealt over as many tasks.
SALTS = 16


def spread(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """``big`` joined with ``small``; the rows of ``big`` that have one key meet in up to ``SALTS`` tasks."""
    salted = small.withColumn("salt", F.explode(F.array(*(F.lit(i) for i in range(SALTS)))))
    salt = F.pmod(F.xxhash64(*big.columns), F.lit(SALTS)).cast("int")
    return big.withColumn("salt", salt).join(salted, [*on, "salt"], how).drop("salt")

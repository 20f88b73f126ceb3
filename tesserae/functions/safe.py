"""Arithmetic rules that every operator shares: missing is NULL, a zero denominator gives NULL, casts truncate."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def clip(c: Column, low: float, high: float) -> Column:
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def truncated(c: Column) -> Column:
    return c.cast("int")


def places(c: Column, digits: int = 6) -> Column:
    """Rounded for comparison, without a negative zero."""
    return F.round(c, digits) + F.lit(0.0)


def shifted(c: Column, by: int, window) -> Column:
    return F.lag(c, by).over(window) if by > 0 else F.lead(c, -by).over(window) if by < 0 else c

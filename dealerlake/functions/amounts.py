"""Exact money arithmetic: sums stay decimal, ratios are double over double."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, null when the denominator is 0."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def mean(total: Column, n: Column) -> Column:
    return ratio(total, n)


def sum_where(condition: Column, value: Column) -> Column:
    """Sum over the rows that meet the condition; null when there is none."""
    return F.sum(F.when(condition, value))


def sum0_where(condition: Column, value: Column) -> Column:
    return or_zero(sum_where(condition, value))


def first_rows(ordered: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` rows, or all with None."""
    return ordered if n is None else ordered.limit(n)

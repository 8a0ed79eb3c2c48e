"""Sums over the days that follow a date, per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def forward_sums(df: DataFrame, keys: Sequence[str], day: str, measures: Sequence[str], days: int) -> DataFrame:
    """For every distinct (keys, day) with an ``is_anchor`` row: sums of the measures in [day, day + days].

    Anchors and amounts come as one table, whose rows may be either or both. Instead of joining each
    anchor to all amounts of its window, the table is reduced to one row per key and day, and a
    sliding range frame runs over those. A key then has at most as many rows as there are days,
    however many events it had, and nothing is paired within a key. Rows with a missing key match
    nothing and are left out.
    """
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    daily = (
        df.filter(present)
        .groupBy(*keys, day)
        .agg(F.max("is_anchor").alias("is_anchor"), *[F.sum(m).alias(m) for m in measures])
    )
    frame = Window.partitionBy(*keys).orderBy(F.unix_date(day)).rangeBetween(0, days)
    return (
        daily.select(*keys, day, "is_anchor", *[F.sum(m).over(frame).alias(m) for m in measures])
        .filter("is_anchor")
        .drop("is_anchor")
    )

"""Numbers as Brazilian report text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dealerlake.functions.amounts import or_zero


def _two_decimals(value: Column) -> Column:
    return F.translate(F.format_number(value.cast("double"), 2), ",.", ".,")


def money_text(value: Column) -> Column:
    """``R$ 1.234,56``; missing as 0."""
    return F.concat(F.lit("R$ "), _two_decimals(or_zero(value)))


def percent_text(value: Column) -> Column:
    """``12,34%`` of a share; missing as ``-``."""
    return F.coalesce(F.concat(_two_decimals(value.cast("double") * 100), F.lit("%")), F.lit("-"))


def int_text(value: Column) -> Column:
    """Whole part; missing as 0."""
    return or_zero(value.cast("double")).cast("bigint").cast("string")

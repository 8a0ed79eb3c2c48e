"""Who a customer is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized_name(name: Column) -> Column:
    """Upper-case trimmed name; a blank one counts as missing."""
    return F.nullif(F.upper(F.trim(name)), F.lit(""))

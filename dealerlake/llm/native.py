"""Column expressions on words, for the operators that stay in Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
_RUN = r"[\x20\x09-\x0D]+"


def word_array(text: Column) -> Column:
    """Runs of characters outside ``\\x20 \\x09-\\x0D``, in order; none for null and blank texts."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, _RUN)).otherwise(F.array().cast("array<string>"))


def has_word(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(BLANKS))) > 0


def head(array: Column, size: Column) -> Column:
    """The first elements; none for sizes below 1."""
    return F.slice(array, F.lit(1), F.greatest(size, F.lit(0)))

"""Cleaning jobs: each takes a table and returns it with the named columns repaired."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealerlake.functions import clean
from dealerlake.session import written


def _each(df: DataFrame, columns: Sequence[str], rule: Callable[[Column], Column]) -> DataFrame:
    """The rule on the trimmed text of each column, trimmed in a step of its own."""
    trimmed = df.withColumns({c: clean.text(F.col(c)) for c in columns})
    return trimmed.withColumns({c: rule(F.col(c)) for c in columns})


def _text_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return list(columns) or [name for name, dtype in df.dtypes if dtype == "string"]


def null_tokens(df: DataFrame, *columns: str) -> DataFrame:
    """Missing-value texts as null, in the named or all text columns."""
    return df.withColumns({c: clean.null_token(F.col(c)) for c in _text_columns(df, columns)})


def clean_strings(df: DataFrame, *columns: str) -> DataFrame:
    """Trimmed texts, blank as null, in the named or all text columns."""
    return df.withColumns({c: clean.text(F.col(c)) for c in _text_columns(df, columns)})


def parse_iso_dates(df: DataFrame, *columns: str) -> DataFrame:
    return _each(df, columns, clean.iso_date)


def parse_br_dates(df: DataFrame, *columns: str) -> DataFrame:
    return _each(df, columns, clean.br_date)


def parse_locale_numbers(df: DataFrame, *columns: str) -> DataFrame:
    return _each(df, columns, clean.locale_number)


def parse_strict_numbers(df: DataFrame, *columns: str) -> DataFrame:
    return _each(df, columns, clean.strict_number)


def parse_integers(df: DataFrame, *columns: str) -> DataFrame:
    return _each(df, columns, clean.integer)


def parse_strict_integers(df: DataFrame, *columns: str) -> DataFrame:
    return _each(df, columns, clean.strict_integer)


def normalize_flags(df: DataFrame, *columns: str) -> DataFrame:
    return _each(df, columns, clean.flag)


def bucket_to_days(df: DataFrame, *columns: str) -> DataFrame:
    return _each(df, columns, clean.age_days)


def default_zero(df: DataFrame, *columns: str) -> DataFrame:
    """Missing as text ``0``, other texts unchanged; columns the table does not have are skipped."""
    existing = [c for c in columns if c in df.columns]
    return df.withColumns(
        {c: F.when(clean.stated(clean.text(F.col(c))).isNull(), "0").otherwise(F.col(c)) for c in existing}
    )


def whitelist_values(df: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    return _each(df, [column], lambda c: clean.one_of(c, allowed))


def fix_mojibake(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: clean.fix_mojibake(F.col(c)) for c in columns})


def derive_branch_codes(df: DataFrame, dealer_name: str, branch_name: str) -> DataFrame:
    """Adds COD_CONCESSIONARIA and COD_FILIAL derived from the two names."""
    helpers = {"_dealer": clean.text(F.col(dealer_name)), "_branch": clean.text(F.col(branch_name))}
    return (
        df.withColumns(helpers)
        .withColumn("COD_CONCESSIONARIA", clean.dealer_code(F.col("_dealer")))
        .withColumn("COD_FILIAL", clean.branch_code(F.col("_branch"), F.col("COD_CONCESSIONARIA")))
        .drop(*helpers)
    )


def repair_shifted_rows(df: DataFrame, days: str, chassis: str, lost: Sequence[str]) -> DataFrame:
    """Rows whose columns slid by one: the days column holds a chassis number, the ``lost`` ones nothing usable."""
    existing = F.col(chassis) if chassis in df.columns else F.lit(None).cast("string")
    marked = df.withColumn("_days", clean.text(F.col(days))).withColumn(
        "_shifted", clean.looks_like_chassis(F.col("_days"))
    )
    shifted = F.col("_shifted")
    return marked.withColumns(
        {chassis: F.when(shifted, F.col("_days")).otherwise(existing)}
        | {c: F.when(~shifted, F.col(c)) for c in (days, *lost) if c in df.columns}
    ).drop("_days", "_shifted")


def coalesce_duplicate_columns(df: DataFrame, base: str) -> DataFrame:
    """Columns ``base``, ``base_1``, ... as one: the first stated value per row."""
    copies = [c for c in df.columns if c == base or c.startswith(base + "_")]
    if len(copies) <= 1:
        return df
    kept = base if base in copies else copies[0]
    trimmed = df.withColumns({c: clean.text(F.col(c)) for c in copies})
    return trimmed.withColumn(kept, F.coalesce(*[clean.stated(F.col(c)) for c in copies])).drop(
        *[c for c in copies if c != kept]
    )


def drop_unnamed_columns(df: DataFrame) -> DataFrame:
    """Without columns whose header was empty."""
    return df.drop(*[c for c in df.columns if not c.strip() or c.strip().lower().startswith("unnamed")])


def dedupe_keep_first(df: DataFrame, order: str, subset: Sequence[str] = ()) -> DataFrame:
    """Of rows equal on ``subset`` (all columns when none of it exists) the first by ``order``.

    Missing values count as equal. The first row is picked by an aggregate, so copies collapse before
    the shuffle and a value with very many copies is no burden on one task.
    """
    keys = [c for c in subset if c in df.columns] or [c for c in df.columns if c != order]
    others = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.col(order)).alias("kept"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"kept.{c}").alias(c) for c in df.columns])


def dedupe_numbered(df: DataFrame, number: str, subset: Sequence[str] = ()) -> DataFrame:
    """``dedupe_keep_first`` for rows that come with a whole number each, none twice and none missing.

    Only the numbers are aggregated, in hash maps and before the shuffle, whereas whole rows would be sorted. The first numbers are written,
    so that Spark knows whether they are few enough to be sent to the rows.
    """
    keys = [c for c in subset if c in df.columns] or [c for c in df.columns if c != number]
    first = written(df.groupBy(*keys).agg(F.min(number).alias(number)).select(number))
    return df.join(first, number, "left_semi").select(*df.columns)


def contract_reason(required: Sequence[str], max_lengths: dict[str, int] | None = None) -> Column:
    """Which required columns are missing and which texts are too long, null when none is."""
    rules = {f"missing: {c}": F.col(c).isNull() for c in required}
    rules |= {f"longer than {n}: {c}": F.coalesce(F.length(c) > n, F.lit(False)) for c, n in (max_lengths or {}).items()}
    broken = reduce(Column.__or__, rules.values())
    # The text is put together only for rows that need one.
    return F.when(broken, F.concat_ws(", ", *[F.when(rule, F.lit(name)) for name, rule in rules.items()]))


def contract_valid(df: DataFrame, required: Sequence[str], max_lengths: dict[str, int] | None = None) -> DataFrame:
    """Rows that meet the contract."""
    return df.filter(contract_reason(required, max_lengths).isNull())


def contract_rejects(df: DataFrame, required: Sequence[str], max_lengths: dict[str, int] | None = None) -> DataFrame:
    """The other rows, with the REASON."""
    return df.withColumn("REASON", contract_reason(required, max_lengths)).filter(F.col("REASON").isNotNull())


def unique_violations(df: DataFrame, *key: str) -> DataFrame:
    """Key values that occur more than once, with how often; a missing key is allowed any number of times."""
    present = df.dropna(subset=list(key))
    return present.groupBy(*key).agg(F.count("*").alias("OCORRENCIAS")).filter(F.col("OCORRENCIAS") > 1)

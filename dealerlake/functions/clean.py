"""Expressions that turn exported text into typed values. None of them raises on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dealerlake.schemas import MONEY

# Texts the exports use for a missing value, matched exactly.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The characters Unicode counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Spellings of yes and no.
YES = ("true", "1", "sim", "yes", "y")
NO = ("false", "0", "nao", "não", "no", "n")

# Stock-age texts in the order they are tested, with the days they stand for.
AGE_DAYS = (
    ("MENOS DE 1 MES", 15),
    ("1 A 3 MESES", 60),
    ("3 A 6 MESES", 135),
    ("6 A 9 MESES", 225),
    ("9 A 12 MESES", 315),
    ("1 A 2 ANOS", 540),
    ("2 A 3 ANOS", 900),
)

# Codes of the dealer and of its named branches.
DEALER_CODES = {"CCM": "0"}
BRANCH_CODES = {"CCM AUTOS 1": "0-1-1", "CCM AUTOS 2": "0-1-2", "CCM AUTOS 3": "0-1-3"}

# States and macro-regions of Brazil.
STATES = (
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
    "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
)
REGIONS = ("NORTE", "NORDESTE", "CENTRO-OESTE", "SUDESTE", "SUL")

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def null_token(c: Column) -> Column:
    return F.when(~c.isin(*NULL_TOKENS), c)


def text(c: Column) -> Column:
    """Trimmed text, null when blank."""
    return F.nullif(F.btrim(c, F.lit(WHITESPACE)), F.lit(""))


# The rules below take trimmed text, so that a job trims a column once however often a rule looks at it.


def stated(value: Column) -> Column:
    """The text, null when it spells out a missing value."""
    return F.when(~F.lower(value).isin("nan", "none"), value)


def iso_date(value: Column) -> Column:
    """``2025-01-31``, one-digit month and day accepted."""
    return F.when(value.rlike("^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), value.try_cast("date"))


def br_date(value: Column) -> Column:
    """``31/01/2025``, one-digit day and month accepted."""
    parts = [F.split_part(value, F.lit("/"), F.lit(i)) for i in (3, 2, 1)]
    return F.when(value.rlike("^[0-9]{1,2}/[0-9]{1,2}/(?!0000)[0-9]{4}$"), F.concat_ws("-", *parts).try_cast("date"))


def locale_number(value: Column, dtype=MONEY) -> Column:
    """``1.234,56`` or ``1234.56`` as an exact number: with both marks the points are thousands marks."""
    both = F.contains(value, F.lit(",")) & F.contains(value, F.lit("."))
    plain = F.when(both, F.replace(value, F.lit("."), F.lit(""))).otherwise(value)
    return strict_number(F.replace(plain, F.lit(","), F.lit(".")), dtype)


def strict_number(value: Column, dtype=MONEY) -> Column:
    """``1234.56`` as an exact number; a comma makes it invalid."""
    # A number far below the last decimal place is too long for the exact cast.
    tiny = value.try_cast("double").try_cast(dtype)
    return F.when(value.rlike(_NUMBER), F.coalesce(value.try_cast(dtype), tiny))


def integer(value: Column, dtype: str = "bigint") -> Column:
    """Whole part of a number whose decimal mark may be a comma."""
    return strict_integer(F.replace(value, F.lit(","), F.lit(".")), dtype)


def strict_integer(value: Column, dtype: str = "bigint") -> Column:
    """Whole part of a plain number."""
    return F.when(value.rlike(_NUMBER), value.try_cast("double").try_cast("bigint").try_cast(dtype))


def flag(value: Column) -> Column:
    """SIM, NAO or null."""
    lower = F.lower(value)
    return F.when(lower.isin(*YES), "SIM").when(lower.isin(*NO), "NAO")


def age_days(value: Column) -> Column:
    """Days of a stock-age text such as ``1 A 3 MESES``, else the number in it."""
    upper = F.upper(value)
    days = F.when(F.contains(upper, F.lit(AGE_DAYS[0][0])), F.lit(AGE_DAYS[0][1]))
    for label, value_days in AGE_DAYS[1:]:
        days = days.when(F.contains(upper, F.lit(label)), F.lit(value_days))
    return days.otherwise(integer(value)).cast("bigint")


def _coded(value: Column, codes: dict[str, str], otherwise: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.when(value.isNotNull(), F.coalesce(F.try_element_at(table, F.upper(value)), otherwise))


def dealer_code(name: Column) -> Column:
    """Code of a dealer from its name."""
    return _coded(name, DEALER_CODES, name)


def branch_code(name: Column, dealer: Column) -> Column:
    """Code of a branch from its name, else built on the dealer code, else the name itself."""
    return _coded(name, BRANCH_CODES, F.coalesce(F.concat(dealer, F.lit("-1-0")), name))


def one_of(value: Column, allowed: tuple[str, ...]) -> Column:
    """Upper-case value when it is on the list."""
    upper = F.upper(value)
    return F.when(upper.isin(*allowed), upper)


def fix_mojibake(value: Column) -> Column:
    """Text that was UTF-8 but got read as Latin-1, read again; any other text unchanged."""
    # Plain ASCII reads the same both ways; a character beyond Latin-1 rules the mix-up out.
    suspect = value.rlike(r"[\x80-\xFF]") & ~value.rlike(r"[^\x00-\xFF]")
    repaired = F.when(suspect, F.try_validate_utf8(F.encode(value, "ISO-8859-1").cast("string")))
    return F.coalesce(repaired, value)


def looks_like_chassis(value: Column) -> Column:
    return F.coalesce(value.rlike("^[A-Z0-9]{10,20}$"), F.lit(False))

"""Row filters (FLT-*). Each returns a predicate ``Column`` or a filtered frame;
predicates on scan columns reach the Parquet reader as pushed filters."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith.functions.blanks import is_blank
from recsmith.functions.strings import col, contains_none, zip_line_ok  # noqa: F401

# Country spellings that mark a foreign address (FLT-04).
FOREIGN_COUNTRIES = [
    "SINGAPORE", "CANADA", "SINGAPORE`", "LONDON", "AUS", "AUSTRIA",
    "BAHRAIN", "BANGLADESH", "BRUNEI DAR", "CAMBODIA", "CAN", "CAYMAN ISL",
    "CHINA", "BRUNEI", "INDONESIA", "DARUSSALAM", "DENMARK", "EMIRATES",
    "ENGLAND", "EUROPEAN", "FRANCE", "GERMANY", "HONG KONG", "INDIA",
    "IRAN (ISLA", "IRELAND", "JAPAN", "KOREA REPU", "MACAU", "MAURITIUS",
    "MEXICO", "MYANMAR", "NEPAL", "NETHERLAND", "NEW ZEALAN", "NEWZEALAND",
    "NIGERIA", "NORWAY", "OMAN", "PAKISTAN", "PANAMA", "PHILIPPINE",
    "ROC", "S ARABIA", "SAMOA", "SAUDI ARAB", "SIGAPORE", "SIMGAPORE",
    "SINGAPOREW", "SINGPAORE", "SINGPORE", "SINAGPORE", "SNGAPORE", "SINGOPORE",
    "SPAIN", "SRI LANKA", "SWAZILAND", "SWEDEN", "SWITZERLAN", "TAIWAN",
    "TAIWAN,PRO", "THAILAND", "U KINGDOM", "U.K.", "UNITED ARA", "UK",
    "UNITED KIN", "UNITED STA", "VIRGIN ISL", "USA", "PAPUA NEW", "AUSTRALIA",
]

# Words whose presence in an address line marks it foreign (FLT-08).
FOREIGN_WORDS = [
    "SINGAPORE", "HONG HONG", "QATAR", "TAMIL NADU", "STAFFORDSHIRE", "HANOI",
    "VIETNAM", "NEW ZEALAND", "ENGLAND", "AUCKLAND", "SHANGHAI", "DOHA QATAR",
    "THAILAND", "HONG KONG", "SEOUL", "#", "NSW", "NETHERLANDS", "AUSTRALIA",
    "S'PORE",
]


def keep_equal(df: DataFrame, c: str, value) -> DataFrame:
    """FLT-01."""
    return df.filter(F.col(c) == F.lit(value))


def drop_equal(df: DataFrame, c: str, value) -> DataFrame:
    """FLT-02: delete rows equal to ``value``; missing values are kept."""
    return df.filter(~F.col(c).eqNullSafe(F.lit(value)))


def keep_in(df: DataFrame, c: str, values: Iterable) -> DataFrame:
    """FLT-03 (blank-padded text compared rtrimmed)."""
    return df.filter(F.rtrim(F.col(c)).isin([str(v).rstrip(" ") for v in values]))


def drop_in(df: DataFrame, c: str, values: Iterable[str]) -> DataFrame:
    """FLT-04: denylist of literals. A short list stays an ``isin``; missing
    values are kept (a missing country is not on the list)."""
    vals = [v.rstrip(" ") for v in values]
    return df.filter(~F.coalesce(F.rtrim(F.col(c)).isin(vals), F.lit(False)))


def greater_than_text(df: DataFrame, c: str, bound: str) -> DataFrame:
    """FLT-05: binary text lower bound (pushed to the scan)."""
    return df.filter(F.col(c) > F.lit(bound))


def drop_blank(df: DataFrame, c: str) -> DataFrame:
    """FLT-06: missing, blank or NUL-only values are deleted."""
    return df.filter(~is_blank(c))


def keep_blank(df: DataFrame, c: str) -> DataFrame:
    return df.filter(is_blank(c))


def any_blank(*cols) -> Column:
    """FLT-07: disjunction of blank tests."""
    p = None
    for c in cols:
        p = is_blank(c) if p is None else (p | is_blank(c))
    return p


def drop_words(df: DataFrame, c: str, words: Iterable[str] = FOREIGN_WORDS) -> DataFrame:
    """FLT-08: drop rows whose text contains any listed word."""
    return df.filter(contains_none(F.coalesce(F.col(c), F.lit("")), list(words)))


def not_expired(d, run_date) -> Column:
    """FLT-09: keep when the date is missing or not before the run date."""
    rd = run_date if isinstance(run_date, Column) else F.lit(run_date).cast("date")
    return col(d).isNull() | (col(d) >= rd)


def open_range(c, low, high) -> Column:
    """FLT-10: ``low < c < high``."""
    return (col(c) > F.lit(low)) & (col(c) < F.lit(high))


def closed_range(c, low, high) -> Column:
    """FLT-10: ``low <= c <= high``."""
    return col(c).between(low, high)


def record_type(rept, fmt, rept_value, fmt_values) -> Column:
    """FLT-11: compound record-type test of a multi-format file."""
    return (col(rept) == F.lit(rept_value)) & col(fmt).isin(list(fmt_values))

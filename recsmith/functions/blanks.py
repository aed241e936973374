"""Missing / blank handling (NUL-*, FLT-06)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsmith.functions.strings import col

NIL = "NIL"


def is_blank(c, nul_is_blank: bool = True) -> Column:
    """Missing, empty, all blanks (and optionally all NUL bytes) -> true (FLT-06)."""
    v = F.coalesce(col(c).cast("string"), F.lit(""))
    if nul_is_blank:
        v = F.translate(v, "\u0000", " ")
    return F.trim(v) == F.lit("")


def default_text(c, default: str = NIL) -> Column:
    """Blank or missing -> ``default`` (NUL-01)."""
    return F.when(is_blank(c), F.lit(default)).otherwise(col(c))


def zero_if_missing(c) -> Column:
    """Missing number -> 0 (NUL-02)."""
    return F.coalesce(col(c), F.lit(0))


def fill_frame(df: DataFrame, value, subset=None) -> DataFrame:
    """Whole-frame fill of the columns whose type matches ``value`` (NUL-03)."""
    return df.na.fill(value, subset=subset)


def blank_strings(df: DataFrame) -> DataFrame:
    """Missing text -> '' in every string column (NUL-04)."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.na.fill("", subset=names) if names else df


def missing(c) -> Column:
    return col(c).isNull()


def present(c) -> Column:
    return col(c).isNotNull()

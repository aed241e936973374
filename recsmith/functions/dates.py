"""Date column functions (DAT-*). Invalid input gives missing, never an error
(ANSI mode raises on bad casts, so everything goes through ``try_*``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recsmith.functions.strings import col

# Output date patterns used by the record layouts.
DATE_PATTERNS = {
    "YYMMDD10": "yyyy-MM-dd",
    "DDMMYYN8": "ddMMyyyy",
    "YYMMDDN8": "yyyyMMdd",
    "MMDDYYN8": "MMddyyyy",
}

# The dummy open date and its replacement (DAT-07).
DUMMY_DATE_TEXT = "00002000000"
DUMMY_DATE_VALUE = "20000101"


def date_from_parts(y, m, d) -> Column:
    """Date from year/month/day numbers; impossible dates -> missing (DAT-01)."""
    txt = F.format_string("%04d-%02d-%02d", col(y).cast("int"), col(m).cast("int"),
                          col(d).cast("int"))
    return F.try_to_date(txt, "yyyy-MM-dd")


def parse_date(c, pattern: str = "yyyy-MM-dd") -> Column:
    """Text -> date, invalid -> missing (SRC-07 / DAT-02)."""
    return F.try_to_date(col(c), pattern)


def date_parts(c) -> dict[str, Column]:
    """Year / month / day numbers of a date (DAT-03)."""
    d = col(c)
    return {"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)}


def format_date(c, fmt: str = "YYMMDD10") -> Column:
    """Render a date with one of the layout formats; missing prints blank (DAT-04)."""
    pattern = DATE_PATTERNS.get(fmt, fmt)
    return F.coalesce(F.date_format(col(c), pattern), F.lit(""))


def run_timestamp_text(run_date: str, run_time: str) -> Column:
    """Run stamp text ``yyyymmdd`` + ``HHMMSS`` from the control date and the
    caller's run time; never the wall clock (DAT-05)."""
    return F.lit(run_date.replace("-", "") + run_time.replace(":", ""))


def packed_mmddyyyy_to_yyyymmdd(n) -> Column:
    """Decode a packed ``MMDDYYYYnnn`` number to ``yyyymmdd`` text (DAT-06).

    The number is zero-padded to 11 digits first, so 0 gives ``'00000000'``.
    """
    z = F.lpad(col(n).cast("long").cast("string"), 11, "0")
    return F.concat(F.substring(z, 5, 4), F.substring(z, 1, 2), F.substring(z, 3, 2))


def replace_dummy_date(text) -> Column:
    """``'00002000000'`` -> ``'20000101'`` (DAT-07); other values unchanged."""
    return F.when(col(text) == F.lit(DUMMY_DATE_TEXT), F.lit(DUMMY_DATE_VALUE)).otherwise(col(text))


def open_date_text(raw) -> Column:
    """Open-date rule of the combined customer file: blanks -> zeros, dummy date
    replaced, otherwise decoded from MMDDYYYY order (DAT-06/07, STR-05)."""
    zeros = F.translate(F.lpad(F.coalesce(col(raw).cast("string"), F.lit("")), 11, " "), " ", "0")
    return F.when(zeros == F.lit(DUMMY_DATE_TEXT), F.lit(DUMMY_DATE_VALUE)).otherwise(
        F.concat(F.substring(zeros, 5, 4), F.substring(zeros, 1, 2), F.substring(zeros, 3, 2)))

"""Projections (PRJ-*) and ordering helpers (SRT-*)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_renamed(df: DataFrame, columns: Sequence[str], rename: dict[str, str] | None = None
                   ) -> DataFrame:
    """PRJ-01/02/03: keep ``columns`` in order, renaming on the way."""
    rename = rename or {}
    return df.select(*[F.col(c).alias(rename.get(c, c)) for c in columns])


def strict_cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """PRJ-04: cast that fails the job on bad input (ANSI)."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def lenient_cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """PRJ-05: cast where bad input becomes missing."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def with_literals(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """PRJ-06."""
    return df.withColumns({c: F.lit(v) for c, v in values.items()})


def truncate_width(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """PRJ-08: declared-width text (longer values cut, never padded)."""
    return df.withColumns({c: F.substring(F.col(c).cast("string"), 1, w) for c, w in widths.items()})


def ensure_columns(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """PRJ-09: add any absent column with a default; present ones unchanged.
    The check is on the schema (driver side, no data read)."""
    missing = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def copy_column(df: DataFrame, src: str, dst: str) -> DataFrame:
    """PRJ-11: the same column under a second name."""
    return df.withColumn(dst, F.col(src))


def ordered(df: DataFrame, *order: Column | str) -> DataFrame:
    """SRT-01..03: total output order (range-partitioned sort)."""
    return df.orderBy(*order)


def preview(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """SRT-04: first ``n`` rows in ``order`` (a top-n: each task keeps n)."""
    return df.orderBy(*order).limit(n)

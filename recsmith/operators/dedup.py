"""Deduplication and duplicate listing (DED-*, AGG-01).

"Keep the first row per key" is an aggregation, not a window: the survivor
is ``min(struct(order..., payload...))`` per key. Aggregates combine
map-side, so a key that holds a third of all rows is reduced to one row
per map task before the shuffle, and no task ever holds a whole group.
The order must be total for a deterministic survivor: the remaining
columns are always appended as tie-breakers.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.sources.readers import SEQ


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _pick(df: DataFrame, keys: list[str], order: list[str], agg) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in rest])
    best = df.groupBy(*keys).agg(agg(packed).alias("_best"))
    return best.select(*keys, *[F.col(f"_best._o{i}").alias(c) for i, c in enumerate(order)],
                       *[F.col(f"_best.{c}") for c in rest]).select(*df.columns)


def first_per_key(df: DataFrame, keys, order: Sequence[str]) -> DataFrame:
    """DED-01/03 (keep first): the row with the smallest ``order`` per key,
    ties broken by the remaining columns ascending."""
    return _pick(df, _keys(keys), list(order), F.min)


def seq_of(df: DataFrame) -> list[str]:
    """The record sequence column, if the frame carries one."""
    return [SEQ] if SEQ in df.columns else []


def in_order(df: DataFrame, *otherwise: str) -> list[str]:
    """The order of records: as they stand in their files where the reader's sequence
    came along, else the columns ``otherwise``."""
    return seq_of(df) or list(otherwise)


def first_record(df: DataFrame, keys, *columns, otherwise: Sequence[str] = ()) -> DataFrame:
    """DED-01 on records as read (NODUPKEY): ``columns`` of the first record per key in input
    order. Frames that were not read from record files have no such order: there the
    smallest by ``otherwise``, then by content, is taken."""
    rows = df.select(*(columns or [c for c in df.columns if c != SEQ]), *seq_of(df))
    return first_per_key(rows, keys, in_order(df, *otherwise)).drop(SEQ)


def last_per_key(df: DataFrame, keys, order: Sequence[str]) -> DataFrame:
    """DED-03 (keep last) / DED-04 (latest record per key): the row with the
    largest ``order``, ties broken by the remaining columns descending."""
    return _pick(df, _keys(keys), list(order), F.max)


latest_per_key = last_per_key


def distinct_on(df: DataFrame, keys) -> DataFrame:
    """DED-02: one row per key, any survivor (``dropDuplicates``)."""
    return df.dropDuplicates(_keys(keys))


def distinct_rows(df: DataFrame) -> DataFrame:
    """DED-05: full-row distinct."""
    return df.distinct()


def distinct_on_prefix(df: DataFrame, record_col: str, width: int,
                       order: Sequence[str]) -> DataFrame:
    """DED-06: dedup on the first ``width`` characters of a rendered record,
    keeping the first by ``order`` (then the record text)."""
    keyed = df.withColumn("_prefix", F.substring(F.col(record_col), 1, width))
    return first_per_key(keyed, ["_prefix"], list(order)).drop("_prefix")


def union_distinct(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """DED-07: stack several key columns into one, drop blanks, distinct."""
    stacked = df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias(name))
    return stacked.filter(F.trim(F.coalesce(F.col(name), F.lit(""))) != "").distinct()


def all_duplicates(df: DataFrame, keys) -> DataFrame:
    """AGG-01: every row whose key occurs more than once.

    Counting is a map-side-combined aggregation; the duplicated keys are then
    matched back with a null-safe semi join (AQE broadcasts the key set when
    its measured size is small and splits skewed partitions otherwise).
    """
    keys = _keys(keys)
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
           .filter(F.col("_n") > 1).drop("_n"))
    d = dup.select(*[F.col(k).alias("_d_" + k) for k in keys])
    cond = reduce(and_, [df[k].eqNullSafe(d["_d_" + k]) for k in keys])
    return df.join(d, cond, "left_semi")

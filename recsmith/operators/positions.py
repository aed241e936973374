"""Row positions without single-task groups (WIN-01, and the slot numbers used
by the positional match-merge JON-10).

A plain ``row_number().over(Window.orderBy(o))`` puts the whole table into one
task, and ``row_number().over(Window.partitionBy(k).orderBy(o))`` puts a
whole key group into one task. Both are avoided:

* ``global_row_number``: rows are range-partitioned and sorted on the order;
  each row records its range partition and its index inside it; that frame
  is written once to the shared checkpoint folder, so every later branch
  (counts and data) reads the very same numbering even if tasks are retried
  or AQE re-plans the readers. Per-partition counts (one row per partition,
  a proven bound) are broadcast as offsets.
* ``group_positions``: the global number over ``(keys, order)`` minus the
  number of the key's first row. The first numbers come from a map-side
  combined ``min`` per key and are joined back with an equi-join, which AQE
  splits when one key holds a large share of the rows.

The order must be total (append tie-breaking columns) for the numbering to
be reproducible.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsmith.functions.strings import col
from recsmith.session import materialize


def global_row_number(df: DataFrame, order: Sequence, name: str = "row_no",
                      partitions: int | None = None) -> DataFrame:
    """1-based row number over the whole frame in ``order`` (WIN-01)."""
    ords = [col(o) for o in order]
    # Without an explicit count AQE sizes the range partitions from the data
    # (it only merges neighbouring ranges, so partition ids stay in order).
    ranged = df.repartitionByRange(partitions, *ords) if partitions else df.repartitionByRange(*ords)
    srt = (ranged.sortWithinPartitions(*ords)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_mid", F.monotonically_increasing_id()))
    srt = materialize(srt, "rownum")
    counts = srt.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # One row per range partition: bounded by ``n``, so broadcasting is safe.
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(
            Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("_off"))
    out = srt.join(F.broadcast(offsets), "_pid")
    # monotonically_increasing_id = (partition index << 33) + index in partition
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return out.withColumn(name, F.col("_off") + local + F.lit(1)).drop("_pid", "_mid", "_off")


def group_positions(df: DataFrame, keys: Sequence[str], order: Sequence,
                    name: str = "pos", partitions: int | None = None,
                    skew_safe: bool = False) -> DataFrame:
    """1-based position of each row inside its key group, in ``order``; null
    keys are a group like any other.

    ``skew_safe`` is the caller's statement about the data. False: one shuffle
    and a window, which sorts a key group in one task (spilling). True, for
    keys that may hold a large share of the rows: the range-partitioned
    numbering, where every task is bounded. Both give the same numbers for a
    total order.
    """
    keys = list(keys)
    ords = [col(o) for o in order]
    if not skew_safe:
        w = Window.partitionBy(*keys).orderBy(*ords)
        return df.withColumn(name, F.row_number().over(w).cast("long"))
    numbered = global_row_number(df, [F.col(k) for k in keys] + ords, "_g", partitions)
    firsts = numbered.groupBy(*keys).agg(F.min("_g").alias("_g0"))
    firsts = firsts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_g0")
    cond = reduce(and_, [numbered[k].eqNullSafe(firsts[f"_k{i}"]) for i, k in enumerate(keys)])
    out = numbered.join(firsts, cond, "inner")
    return out.select(*df.columns, (F.col("_g") - F.col("_g0") + F.lit(1)).alias(name))

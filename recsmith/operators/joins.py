"""Joins and match-merges (JON-*).

Broadcast policy: no hints. The planner broadcasts a side only when its known
size is below ``spark.sql.autoBroadcastJoinThreshold``; otherwise AQE converts
to a broadcast at run time from real shuffle statistics and splits skewed
partitions (``skewJoin``).
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsmith.operators.positions import group_positions


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def inner_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """JON-01/03/05: equi-join, all pairs of equal keys (relational semantics)."""
    return left.join(right, _keys(on), "inner")


def lookup(fact: DataFrame, table: DataFrame, on) -> DataFrame:
    """JON-02/04: left lookup merge; every fact row kept.

    No broadcast hint: the planner broadcasts a side only when its estimated
    size is below ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-decides
    from the measured shuffle size, so a code table is broadcast and a large
    table is shuffled without an extra counting job."""
    return fact.join(table, _keys(on), "left")


def join_renamed(left: DataFrame, right: DataFrame, pairs: dict[str, str],
                 how: str = "inner") -> DataFrame:
    """JON-06: join on differently named keys; right key columns are dropped."""
    cond = reduce(and_, [left[l] == right[r] for l, r in pairs.items()])
    out = left.join(right, cond, how)
    for r in pairs.values():
        if r not in pairs:
            out = out.drop(right[r])
    return out


def flag_join(fact: DataFrame, keys_df: DataFrame, left_on: Sequence[str],
              right_on: Sequence[str] | None = None, flag: str = "found") -> DataFrame:
    """JON-07: keep every fact row, add boolean ``flag`` = key present on the
    right. The right side is reduced to distinct keys first, so the fact never
    fans out."""
    right_on = list(right_on or left_on)
    marks = keys_df.select(*[F.col(r).alias(f"_k{i}") for i, r in enumerate(right_on)]) \
        .distinct().withColumn(flag, F.lit(True))
    cond = reduce(and_, [fact[l] == marks[f"_k{i}"] for i, l in enumerate(left_on)])
    out = fact.join(marks, cond, "left")
    return out.select(*[fact[c] for c in fact.columns],
                      F.coalesce(marks[flag], F.lit(False)).alias(flag))


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """JON-08: rows of ``left`` with no key match in ``right``."""
    return left.join(right, _keys(on), "left_anti")


def outer_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """JON-09: full outer join, coalesced key columns."""
    return left.join(right, _keys(on), "full")


def self_join(df: DataFrame, left_on: str, right_on: str, suffix: str = "_r",
              how: str = "left") -> DataFrame:
    """JON-12: join a frame to itself; right columns get ``suffix``."""
    r = df.select(*[F.col(c).alias(c + suffix) for c in df.columns])
    return df.join(r, df[left_on] == r[right_on + suffix], how)


def star_lookup(fact: DataFrame, tables: Iterable[tuple[DataFrame, object]]) -> DataFrame:
    """JON-13: one fact, N code tables, each a left lookup; small tables are
    broadcast by the planner, so the fact is not shuffled for them."""
    out = fact
    for table, on in tables:
        out = lookup(out, table, on)
    return out


def attach_details(fact: DataFrame, details: Iterable[DataFrame], on) -> DataFrame:
    """JON-14: chained left joins of several detail frames on one key. Each
    detail is made unique per key by the caller; the planner reuses the
    fact's partitioning, so the fact shuffles once."""
    out = fact
    for d in details:
        out = out.join(d, _keys(on), "left")
    return out


def overlay_merge(left: DataFrame, right: DataFrame, on, how: str = "left") -> DataFrame:
    """JON-11: merge where same-named non-key columns take the right value
    whenever the key matched, else keep the left value."""
    keys = _keys(on)
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    r = right.withColumn("_matched", F.lit(True))
    l_ = left.alias("l")
    r_ = r.alias("r")
    out = l_.join(r_, keys, how)
    sel = [F.col(k) for k in keys]
    for c in left.columns:
        if c in keys:
            continue
        if c in shared:
            sel.append(F.when(F.col("r._matched"), F.col(f"r.{c}"))
                       .otherwise(F.col(f"l.{c}")).alias(c))
        else:
            sel.append(F.col(f"l.{c}"))
    sel += [F.col(f"r.{c}") for c in right.columns if c not in keys and c not in shared]
    return out.select(*sel)


def match_merge(left: DataFrame, right: DataFrame, on, left_order: Sequence[str],
                right_order: Sequence[str], keep: str = "left",
                overlay: str = "matched", skew_safe: bool | None = None,
                histogram: DataFrame | None = None) -> DataFrame:
    """JON-10: positional match-merge of a key group with ``nl`` left and ``nr``
    right rows (the sequential MERGE-BY semantics).

    Output slot ``i = 1..max(nl, nr)`` pairs left row ``min(i, nl)`` with right
    row ``min(i, nr)``; a side with no rows contributes nulls. Missing keys
    match missing keys. Each side is ordered by its order columns, then by its
    other columns, so the order is total. ``keep``: 'left' (IF A), 'inner'
    (IF A AND B), 'all'. Shared non-key columns take the right value where the
    right side has a row at that slot (``overlay='positional'``) or whenever
    the group matched (``overlay='matched'``). Plan: see ``merge_files``."""
    keys = _keys(on)
    lcols = [c for c in left.columns if c not in keys]
    rcols = [c for c in right.columns if c not in keys]
    j = _merged([left, right], keys, [left_order, right_order], skew_safe, histogram)
    in_left, in_right = F.col("_last0").isNotNull(), F.col("_last1").isNotNull()
    if keep == "left":
        j = j.filter(in_left)
    elif keep == "inner":
        j = j.filter(in_left & in_right)
    has_r = F.col("_at1") if overlay == "positional" else in_right
    out = [F.col(k) for k in keys]
    for c in lcols:
        value = F.col("_last0").getField(c)
        out.append((F.when(has_r, F.col("_last1").getField(c)).otherwise(value) if c in rcols else value).alias(c))
    out += [F.col("_last1").getField(c).alias(c) for c in rcols if c not in lcols]
    return j.select(*out, F.col("_pos").alias("slot"), in_left.alias("in_left"), in_right.alias("in_right"))


# Rows of one key above which it gets more than one task, and the share of rows the
# histogram of keys is taken from.
HOT_ROWS = 2_000_000
SAMPLE = 0.01


def merge_files(files: Sequence[DataFrame], on, orders: Sequence[Sequence[str]], keep: Sequence[int] = (0,),
                skew_safe: bool | None = None, histogram: DataFrame | None = None) -> DataFrame:
    """JON-10/14 for any number of files: the same as merging the second file by position
    to the first, the third to the result, and so on. Slot ``i`` of a key takes row ``min(i, n)`` of
    each file, a file without rows contributes nulls; keys with rows in all files
    ``keep`` stay. Besides the keys no two files share a column. Adds ``slot``.

    Plan: one shuffle. All files are stacked and dealt out by key; the rows of each file are numbered,
    and a running last value per file fills the slots: its own row there, or its final one. A histogram of a sample of
    the keys (its result holds only keys of some ``HOT_ROWS`` rows or more) finds hot keys; their rows are
    numbered over range partitions and meet by (key, number), so no task holds a hot key, and no all-pairs
    product and no slot list is formed. Both ways give the same rows. ``histogram``: a frame with the
    keys to sample in place of the files, where those take long to compute; ``skew_safe``: True or False sends all keys
    one way without looking."""
    keys = _keys(on)
    columns = [[c for c in f.columns if c not in keys] for f in files]
    names = [c for cols in columns for c in cols]
    if len(set(names)) < len(names):
        raise ValueError("files to merge share columns besides the keys")
    j = _merged(list(files), keys, orders, skew_safe, histogram)
    for i in keep:
        j = j.filter(F.col(f"_last{i}").isNotNull())
    return j.select(*keys, *[F.col(f"_last{i}").getField(c).alias(c) for i, cols in enumerate(columns) for c in cols],
                    F.col("_pos").alias("slot"))


def hot_keys(frames: Sequence[DataFrame], keys: Sequence[str], rows: int | None = None,
             share: float | None = None) -> list[tuple]:
    """Keys that hold about ``rows`` rows or more, from a sample: at most one per ``rows`` rows."""
    rows, share = rows or HOT_ROWS, share or SAMPLE
    picked = reduce(DataFrame.union, [f.select(*keys) for f in frames])
    if share < 1:
        picked = picked.sample(share, 11)
    return [tuple(r) for r in picked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= rows * share)
            .drop("_n").collect()]


def _merged(files: list[DataFrame], keys: list[str], orders, skew_safe: bool | None, histogram: DataFrame | None) -> DataFrame:
    """Slots: keys, ``_pos``, and per file the row of the slot (``_last<i>``) and whether it
    stands at that very slot (``_at<i>``)."""
    rows = []
    for i, (f, order) in enumerate(zip(files, orders)):
        cols = [c for c in f.columns if c not in keys]
        rows.append(f.select(*keys, F.struct(F.lit(True).alias("_row"), *cols).alias(f"_s{i}"),
                             *[F.col(c).alias(f"_o{i}_{k}") for k, c in enumerate(order)]))
    if skew_safe is not None:
        return (_slots_split if skew_safe else _slots_stacked)(rows, keys)
    hot = hot_keys([histogram] if histogram is not None else files, keys)
    if not hot:
        return _slots_stacked(rows, keys)
    is_hot = reduce(or_, [reduce(and_, [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(keys, key)]) for key in hot])
    return _slots_stacked([r.where(~is_hot) for r in rows], keys).unionByName(
        _slots_split([r.where(is_hot) for r in rows], keys))


def _slots_stacked(rows: list[DataFrame], keys: list[str]) -> DataFrame:
    """One shuffle by key; everything after it is keyed by ``keys``."""
    n = len(rows)
    stack = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                   [r.withColumn("_side", F.lit(i)) for i, r in enumerate(rows)]).repartition(*keys)
    order = [c for c in stack.columns if c.startswith("_o")] + [f"_s{i}" for i in range(n)]
    pos = F.row_number().over(Window.partitionBy(*keys, "_side").orderBy(*order)).cast("long")
    w = Window.partitionBy(*keys).orderBy("_pos", "_side")
    sofar = w.rowsBetween(Window.unboundedPreceding, 0)
    last = {f"_last{i}": F.last(f"_s{i}", ignorenulls=True).over(sofar) for i in range(n)}
    at = {f"_at{i}": F.coalesce(F.last(F.when(F.col("_side") == i, F.col("_pos")), ignorenulls=True).over(sofar) == F.col("_pos"),
                                F.lit(False)) for i in range(n)}
    # The last row of a slot has seen all files' rows there.
    end = F.lead("_pos").over(w)
    numbered = stack.withColumn("_pos", pos).withColumns({**last, **at, "_next": end})
    return numbered.where("_next is null or _next > _pos").select(*keys, "_pos", *last, *at)


def _slots_split(rows: list[DataFrame], keys: list[str]) -> DataFrame:
    """The same slots for hot keys: numbered over range partitions, met by (key, number)."""
    sides = []
    for i, r in enumerate(rows):
        order = [c for c in r.columns if c.startswith("_o")] + [f"_s{i}"]
        sides.append(group_positions(r, keys, order, "_pos", skew_safe=True).select(*keys, "_pos", f"_s{i}"))
    stack = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    j = stack.groupBy(*keys, "_pos").agg(*[F.max(f"_s{i}").alias(f"_s{i}") for i in range(len(rows))])
    for i, side in enumerate(sides):
        last = side.groupBy(*keys).agg(F.max(F.struct("_pos", f"_s{i}")).alias("_end")).select(
            *[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)], F.col("_end").getField(f"_s{i}").alias("_end"))
        same = reduce(and_, [j[k].eqNullSafe(last[f"_k{n}"]) for n, k in enumerate(keys)])
        j = j.join(last, same, "left").select(*j.columns, F.coalesce(F.col(f"_s{i}"), F.col("_end")).alias(f"_last{i}"),
                                              F.col(f"_s{i}").isNotNull().alias(f"_at{i}"))
    n = len(rows)
    return j.select(*keys, "_pos", *[f"_last{i}" for i in range(n)], *[f"_at{i}" for i in range(n)])

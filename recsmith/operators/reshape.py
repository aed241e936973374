"""Set operations, routing and reshaping (SET-*, PRJ-10)."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_all(*dfs: DataFrame) -> DataFrame:
    """SET-01: same-schema union, matched by name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_missing(*dfs: DataFrame) -> DataFrame:
    """SET-02: union by name, absent columns become missing."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def _numeric(t: T.DataType) -> bool:
    return isinstance(t, (T.NumericType, T.NullType))


def union_widen(*dfs: DataFrame) -> DataFrame:
    """SET-03: union by name with type widening. Numeric columns widen by
    Spark's own set-operation coercion (int -> long -> decimal -> double);
    a column whose inputs mix numbers and other types becomes string."""
    seen: dict[str, list[T.DataType]] = {}
    for df in dfs:
        for f in df.schema.fields:
            seen.setdefault(f.name, []).append(f.dataType)
    to_string = {c for c, ts in seen.items()
                 if len({t.simpleString() for t in ts}) > 1 and not all(_numeric(t) for t in ts)}
    cast = [df.select(*[F.col(c).cast("string").alias(c) if c in to_string else F.col(c)
                        for c in df.columns]) for df in dfs]
    return union_missing(*cast)


def flip_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """PRJ-10: swap the two sides of an edge, column by column."""
    swap = {}
    for a, b in pairs:
        swap[a], swap[b] = b, a
    return df.select(*[F.col(swap.get(c, c)).alias(c) for c in df.columns])


def symmetrise(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """SET-04: edge rows plus their flipped copies (never a self-join, so
    duplicated edges do not fan out).

    One pass: each row is exploded into its stored and its flipped form, so
    the input is scanned (and any upstream dedup computed) once, not twice as
    with a union of two branches."""
    swap = {}
    for a, b in pairs:
        swap[a], swap[b] = b, a
    stored = F.struct(*[F.col(c).alias(c) for c in df.columns])
    flipped = F.struct(*[F.col(swap.get(c, c)).alias(c) for c in df.columns])
    return df.select(F.explode(F.array(stored, flipped)).alias("_e")).select("_e.*")


def route(df: DataFrame, routes: dict[str, Column], label: str = "route",
          default: str | None = None) -> DataFrame:
    """SET-05: tag each row with the first route whose predicate holds; one
    pass over the input, write with ``partitionBy(label)`` or filter per
    output. Rows matching no route are dropped unless ``default`` is given."""
    expr = None
    for name, pred in routes.items():
        expr = F.when(pred, F.lit(name)) if expr is None else expr.when(pred, F.lit(name))
    if default is not None:
        expr = expr.otherwise(F.lit(default))
    out = df.withColumn(label, expr)
    return out if default is not None else out.filter(F.col(label).isNotNull())


def split(df: DataFrame, pred: Column) -> tuple[DataFrame, DataFrame]:
    """SET-06: complementary split; a missing predicate counts as false, so
    the two parts always add up to the input."""
    p = F.coalesce(pred, F.lit(False))
    return df.filter(p), df.filter(~p)


def unpivot_nonblank(df: DataFrame, ids: Sequence[str], columns: Sequence[str],
                     value: str = "value", source: str = "source") -> DataFrame:
    """SET-07: one row per (id, non-blank value of ``columns``)."""
    out = df.unpivot(list(ids), list(columns), source, value)
    return out.filter(F.trim(F.coalesce(F.col(value), F.lit(""))) != "")

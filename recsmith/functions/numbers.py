"""Money, numeric coercion and conditional helpers (MTH-*, CND-*).

Money is carried as ``decimal(18,2)``, never as double text.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from recsmith.functions.strings import col

MONEY = "decimal(18,2)"


def money(c) -> Column:
    return col(c).try_cast(MONEY)


def cents_to_units(c) -> Column:
    """Integer cents -> units with two decimals (MTH-01)."""
    return (col(c).try_cast("decimal(20,0)") / F.lit(100)).cast(MONEY)


def positive_or_zero(c) -> Column:
    """Keep a positive value, else 0; missing -> 0 (MTH-02)."""
    v = col(c)
    return F.when(v > 0, v).otherwise(F.lit(0))


def nonzero_or_zero(c) -> Column:
    """Keep a non-zero value; zero and missing -> 0 (MTH-03)."""
    v = col(c)
    return F.when((v < 0) | (v > 0), v).otherwise(F.lit(0))


def zero_outside(c, category, keep: Iterable[str]) -> Column:
    """Value only when ``category`` is in ``keep`` (rtrimmed), else 0 (MTH-04)."""
    return F.when(F.rtrim(col(category)).isin(list(keep)), col(c)).otherwise(F.lit(0))


def to_number(c, type_: str = "long") -> Column:
    """Lenient text -> number, failures -> missing (MTH-05, PRJ-05)."""
    return F.trim(col(c)).try_cast(type_)


def first_match(cases: Sequence[tuple[Column, object]], default=None) -> Column:
    """``CASE`` where the first true condition wins (CND-01)."""
    expr = None
    for cond, value in cases:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    if default is not None:
        expr = expr.otherwise(default if isinstance(default, Column) else F.lit(default))
    return expr


def last_match(cases: Sequence[tuple[Column, object]], default=None) -> Column:
    """Sequential ``IF`` statements where a later true condition overwrites an
    earlier one (CND-02): the same CASE with the rule order reversed."""
    return first_match(list(reversed(list(cases))), default)


def first_matching_source(candidates: Sequence[tuple[Column, Column]]) -> Column:
    """First source whose test passes supplies the value (CND-03): ``coalesce``
    of ``when(test, value)``; value is usually a struct of several fields."""
    return F.coalesce(*[F.when(test, value) for test, value in candidates])


def copy_when(cond: Column, value, otherwise=None) -> Column:
    """Conditional copy (CND-04)."""
    v = value if isinstance(value, Column) else col(value)
    e = F.when(cond, v)
    return e.otherwise(otherwise) if otherwise is not None else e


def any_of(preds: Iterable[Column]) -> Column:
    """OR across predicates / columns (CND-05)."""
    return reduce(or_, list(preds))


def two_outputs(cases: Sequence[tuple[Column, tuple]], default: tuple,
                names: tuple[str, str]) -> Column:
    """One decision producing two values as a struct (CND-06); select
    ``s.<name>`` afterwards to split it."""
    def pack(vals):
        return F.struct(*[F.lit(v).alias(n) for v, n in zip(vals, names)])
    return first_match([(c, pack(v)) for c, v in cases], pack(default))

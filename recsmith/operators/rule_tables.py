"""Rule tables as data (CLS-02, CLS-03, CLS-04): ranges with a value, a precedence and a validity,
read from a table or file instead of being written into code.

``compile_rules`` keeps the rules that hold on the run date and cuts overlapping ranges into
segments that do not overlap, each with the value of the rule that wins there: the larger
precedence, then the later start of validity, then the narrower range, then the smaller
value. ``RangeRules.value`` looks a number up by binary search in one constant array: a number
of steps logarithmic in the rules, no join, no chain of conditions. The rules go through the
driver and to every task, so their number is checked against ``MAX_RULES``."""

from __future__ import annotations

import datetime as dt
import heapq
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 10_000
# Columns of a rule table; missing validity and bounds are open.
RULE_COLUMNS = ["TABLE", "LOW", "HIGH", "CLOSED", "VALUE", "PRECEDENCE", "VALID_FROM", "VALID_TO"]
LOWEST, HIGHEST = -(1 << 62), 1 << 62


@dataclass(frozen=True)
class Rule:
    """Numbers from ``low`` to ``high``, both included."""

    low: int
    high: int
    value: str
    precedence: int = 0
    since: dt.date = dt.date.min


@dataclass(frozen=True)
class RangeRules:
    """Segments in order, not overlapping: first numbers, last numbers, values."""

    starts: list[int]
    ends: list[int]
    values: list[str]

    def value(self, number: Column, default: str | None = None) -> Column:
        """The value of ``number`` (a whole number); ``default`` outside all ranges and for
        a missing number."""
        if not self.starts:
            return F.lit(default).cast("string")
        starts, ends, values = (F.array(*map(F.lit, x)) for x in (
            [F.lit(s).cast("long") for s in self.starts], [F.lit(e).cast("long") for e in self.ends], self.values))
        x, n = number.cast("long"), len(self.starts)
        # The last segment that starts at or before the number, bit by bit.
        steps = F.array(*[F.lit(1 << b) for b in reversed(range(n.bit_length()))])
        at = F.aggregate(steps, F.lit(0), lambda found, step: F.when(
            (found + step <= n) & (F.get(starts, found + step - 1) <= x), found + step).otherwise(found))
        # Named once, so that the search runs once a row.
        hit = F.transform(F.array(at), lambda a: F.when((a > 0) & (x <= F.get(ends, a - 1)), F.get(values, a - 1)))
        return F.coalesce(F.get(hit, F.lit(0)), F.lit(default).cast("string"))


def compile_rules(rules: DataFrame, table: str, run_date: str) -> RangeRules:
    """The rules of one table that hold on ``run_date`` (yyyy-MM-dd). ``rules``: ``RULE_COLUMNS``, as text or
    typed; ``CLOSED`` 'N': both bounds are outside the range."""
    day = F.lit(run_date).cast("date")
    text = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    since, until = text("VALID_FROM").try_cast("date"), text("VALID_TO").try_cast("date")
    held = rules.where((F.trim("TABLE") == table) & (since.isNull() | (since <= day)) & (until.isNull() | (until >= day)))
    open_ = F.when(text("CLOSED") == "N", F.lit(1)).otherwise(F.lit(0))
    rows = held.select((F.coalesce(text("LOW").try_cast("long"), F.lit(LOWEST)) + open_).alias("low"),
                       (F.coalesce(text("HIGH").try_cast("long"), F.lit(HIGHEST)) - open_).alias("high"),
                       F.rtrim("VALUE").alias("value"), F.coalesce(text("PRECEDENCE").try_cast("int"), F.lit(0)).alias("precedence"),
                       since.alias("since")).limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules in table {table}")
    return segments(Rule(r.low, r.high, r.value, r.precedence, r.since or dt.date.min) for r in rows)


def segments(rules: Iterable[Rule]) -> RangeRules:
    """Overlapping ranges cut so that every number has the rule that wins there."""
    rules = sorted((r for r in rules if r.low <= r.high), key=lambda r: r.low)
    cuts = sorted({r.low for r in rules} | {r.high + 1 for r in rules})
    live: list = []
    starts, ends, values = [], [], []
    at = 0
    for low, after in zip(cuts, cuts[1:]):
        while at < len(rules) and rules[at].low <= low:
            r = rules[at]
            heapq.heappush(live, ((-r.precedence, -r.since.toordinal(), r.high - r.low, r.value), r.high, r.value))
            at += 1
        while live and live[0][1] < low:
            heapq.heappop(live)
        if not live:
            continue
        value = live[0][2]
        if starts and ends[-1] == low - 1 and values[-1] == value:
            ends[-1] = after - 1
        else:
            starts.append(low)
            ends.append(after - 1)
            values.append(value)
    return RangeRules(starts, ends, values)

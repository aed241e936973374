"""Rule tables as data, keyed lookups."""

import datetime as dt
import uuid

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from recsmith.functions import rules as R
from recsmith.operators import keyed, rule_tables as RT


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(-20, 40), st.integers(-3, 15), st.sampled_from("abc"), st.integers(0, 2), st.integers(1, 3)), max_size=12))
def test_segments_choose_by_precedence(raw):
    rules = [RT.Rule(lo, lo + n, v, p, dt.date(2000, 1, d)) for lo, n, v, p, d in raw]
    cut = RT.segments(rules)
    assert all(a <= z for a, z in zip(cut.starts, cut.ends)) and all(z < a for z, a in zip(cut.ends, cut.starts[1:]))
    for x in range(-25, 60):
        held = [r for r in rules if r.low <= x <= r.high]
        want = min(held, key=lambda r: (-r.precedence, -r.since.toordinal(), r.high - r.low, r.value)).value if held else None
        got = next((v for a, z, v in zip(cut.starts, cut.ends, cut.values) if a <= x <= z), None)
        assert got == want


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 100])
def test_search_finds_every_segment(spark, n):
    rules = RT.segments([RT.Rule(10 * i, 10 * i + 6, f"v{i}") for i in range(n)])
    xs = [None, -5, *range(-1, 10 * n + 12)]
    got = spark.createDataFrame([(x,) for x in xs], "x int").select("x", rules.value(F.col("x"), "none").alias("v")).collect()
    assert {r.x: r.v for r in got} == {x: f"v{x // 10}" if x is not None and 0 <= x < 10 * n and x % 10 <= 6 else "none" for x in xs}


def rule_rows(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in RT.RULE_COLUMNS))


def test_validity_and_open_bounds(spark):
    rules = rule_rows(spark, [("T", "10", "20", "N", "open", "0", "", ""), ("T", "15", "15", "Y", "then", "1", "2000-01-01", "2000-12-31"),
                              ("T", "", "5", "Y", "below", None, None, None), ("T", "x", "30", "Y", "bad", "-1", "", ""),
                              ("U", "0", "99", "Y", "other", "9", "", ""), ("T", "12", "11", "Y", "empty", "5", "", "")])
    value = lambda day, x: spark.range(1).select(RT.compile_rules(rules, "T", day).value(F.lit(x), "").alias("v")).first().v
    assert [value("2000-06-01", x) for x in (11, 15, 19, 20, 10, 5, -9)] == ["open", "then", "open", "bad", "bad", "below", "below"]
    assert [value("2001-01-01", 15), value("1999-12-31", 15)] == ["open", "open"]
    assert value("2001-01-01", 31) == ""


def test_too_many_rules_are_refused(spark, monkeypatch):
    monkeypatch.setattr(RT, "MAX_RULES", 3)
    rules = rule_rows(spark, [("T", str(i), str(i), "Y", "v", "0", "", "") for i in range(4)])
    with pytest.raises(ValueError):
        RT.compile_rules(rules, "T", "2000-01-01")


def test_zip_outside_every_range_has_no_state(spark):
    rules = RT.segments([RT.Rule(lo, hi, s) for lo, hi, s in R.ZIP_STATE_RANGES])
    both = spark.range(0, 100000, 37).select(R.state_of(F.col("id")).alias("a"), rules.value(F.col("id"), "").alias("b"))
    assert both.where("a <> b").count() == 0 and both.where("b = ''").count() > 0


@pytest.fixture(scope="module")
def table(spark):
    name = "keyed_" + uuid.uuid4().hex[:8]
    rows = spark.range(200_000).select((F.col("id") % 5000).cast("string").alias("K"), F.col("id").alias("ID"), F.lit("x" * 50).alias("T"))
    keyed.write_keyed(rows, name, "K", 8, ["ID"], row_group=65536)
    yield name
    spark.sql(f"DROP TABLE {name}")


def scan(df):
    """The executed scan of a plan without exchanges."""
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().apply(0)


def test_lookup_prunes_buckets_and_row_groups(spark, table):
    wanted = spark.createDataFrame([("17",), ("4242",), (None,), ("no such",)], "K string")
    found = keyed.lookup_rows(spark, table, "K", wanted)
    assert sorted(r.ID for r in found.collect()) == sorted(k for k in range(200_000) if k % 5000 in (17, 4242))
    # Rows of the row groups that were read: less than a whole bucket for each key.
    assert 80 <= scan(found).metrics().apply("numOutputRows").value() < 30_000
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        text = keyed.lookup_rows(spark, table, "K", wanted)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 3 out of 8" in text or "SelectedBucketsCount: 2 out of 8" in text


def test_many_keys_are_joined(spark, table):
    wanted = spark.range(0, 5000, 2).select(F.col("id").cast("string").alias("K"))
    found = keyed.lookup_rows(spark, table, "K", wanted, max_keys=100)
    assert found.count() == 100_000
    assert keyed.lookup_rows(spark, table, "K", wanted.limit(0)).count() == 0

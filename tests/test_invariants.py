"""Invariants and property tests: layout round trip, dedup, symmetrise,
split, lookups, positions."""

from datetime import date
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from recsmith.operators import dedup as DD
from recsmith.operators import joins as J
from recsmith.operators import reshape as RS
from recsmith.operators.positions import global_row_number, group_positions
from recsmith.sources.layout import Layout

LAY = Layout.of([("name", 1, 12), ("num", 13, 8, "z"), ("amt", 21, 12, "n", 2), ("d", 33, 10, "d"),
                 ("pk", 43, 5, "x")], lrecl=60)

text = st.text(alphabet="ABCXYZ 0123-,", min_size=0, max_size=12).map(lambda s: s.rstrip(" "))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(text, st.integers(0, 99_999_999),
                          st.decimals(min_value=-99999999, max_value=99999999, places=2),
                          st.dates(date(1950, 1, 1), date(2049, 12, 31)),
                          st.integers(-99_999_999, 99_999_999)), min_size=1, max_size=8))
def test_layout_round_trip(spark, data):
    df = spark.createDataFrame(data, "name string, num long, amt decimal(18,2), d date, pk long")
    back = LAY.decode(LAY.render(df))
    assert rows(back) == sorted((n, k, Decimal(a), d, p) for n, k, a, d, p in data)


def test_dedup_invariants(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    first = DD.first_per_key(li, ["l_orderkey", "l_linenumber"], ["l_partkey"])
    keys = li.select("l_orderkey", "l_linenumber").distinct().count()
    assert first.count() == keys
    again = DD.first_per_key(first, ["l_orderkey", "l_linenumber"], ["l_partkey"])
    assert rows(again) == rows(first)
    dups = DD.all_duplicates(li, ["l_orderkey", "l_linenumber"])
    singles = li.groupBy("l_orderkey", "l_linenumber").count().filter("count = 1").count()
    assert dups.count() + singles == li.count()


def test_symmetrise_closed_under_flip(spark):
    e = spark.createDataFrame([("1", "a", "2", "b"), ("3", "c", "3", "c")], "c1 string, k1 string, c2 string, k2 string")
    pairs = [("c1", "c2"), ("k1", "k2")]
    s = RS.symmetrise(e, pairs)
    assert s.count() == 2 * e.count()
    assert rows(RS.flip_pairs(s, pairs)) == rows(s)


def test_split_parts_add_up(spark):
    df = spark.createDataFrame([("O",), (None,), ("",), ("M",)], "g string")
    a, b = RS.split(df, F.col("g") == "O")
    assert a.count() + b.count() == df.count()


def test_lookup_keeps_row_count(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet").withColumnRenamed("c_custkey", "o_custkey")
    assert J.lookup(o, c, "o_custkey").count() == o.count()


def test_match_merge_rows_per_key(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    left = o.filter("o_orderstatus = 'O'").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("lo"))
    right = o.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("ro"))
    out = J.match_merge(left, right, "k", ["lo"], ["ro"], keep="all")
    got = {r.k: r["count"] for r in out.groupBy("k").count().collect()}
    nl = {r.k: r["count"] for r in left.groupBy("k").count().collect()}
    nr = {r.k: r["count"] for r in right.groupBy("k").count().collect()}
    for k in set(nl) | set(nr):
        assert got[k] == max(nl.get(k, 0), nr.get(k, 0))


def test_global_row_number_is_dense(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_custkey")
    n = global_row_number(o, ["o_custkey", "o_orderkey"], partitions=7)
    nums = sorted(r.row_no for r in n.collect())
    assert nums == list(range(1, o.count() + 1))
    first = n.orderBy("row_no").first()
    low = o.orderBy("o_custkey", "o_orderkey").first()
    assert (first.o_custkey, first.o_orderkey) == (low.o_custkey, low.o_orderkey)


def test_skew_safe_positions_equal_window(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    # one hot key holding a third of the rows
    hot = li.withColumn("k", F.when(F.col("l_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("l_orderkey")))
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_orderkey", "l_quantity", "l_extendedprice"]
    a = group_positions(hot, ["k"], order, skew_safe=True, partitions=5)
    b = group_positions(hot, ["k"], order, skew_safe=False)
    cols = ["k"] + order + ["pos"]
    assert rows(a, *cols) == rows(b, *cols)


def test_apply_defaults_sets_sql_settings(spark):
    from recsmith.session import DEFAULT_CONF, apply_defaults

    apply_defaults(spark)
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql."):
            assert spark.conf.get(k) == v, k

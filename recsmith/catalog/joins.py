"""Joins and match-merges over the test tables (JON-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from recsmith.catalog.registry import query, table
from recsmith.operators import dedup as DD
from recsmith.operators import joins as J


@query("join_inner", "JON-01", sql="""
SELECT o.o_orderkey, o.o_custkey, l.l_linenumber, l.l_partkey
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey""")
def join_inner(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    return J.inner_join(o, li, "o_orderkey")


@query("join_lookup", "JON-02", sql="""
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def join_lookup(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return J.lookup(o, c, "o_custkey")


@query("join_merge_inner", "JON-03", sql="""
SELECT c.c_custkey, c.c_nationkey, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE n.n_regionkey <> 2""")
def join_merge_inner(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").filter("n_regionkey <> 2").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return J.inner_join(c, n, "c_nationkey")


@query("join_left_3key", "JON-04", sql="""
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, r.RFLAG
FROM lineitem l LEFT JOIN (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, 'R' AS RFLAG FROM lineitem
                           WHERE l_returnflag = 'R') r
  ON l.l_orderkey = r.l_orderkey AND l.l_partkey = r.l_partkey AND l.l_suppkey = r.l_suppkey""")
def join_left_3key(spark, sf):
    li = table(spark, sf, "lineitem")
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    r = li.filter(li.l_returnflag == "R").select(*keys, F.lit("R").alias("RFLAG")).distinct()
    return J.lookup(li.select(*keys, "l_linenumber"), r, keys)


@query("join_inner_2key", "JON-05", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, s.SHIPYEAR
FROM lineitem l JOIN (SELECT DISTINCT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS SHIPYEAR
                      FROM lineitem WHERE l_linestatus = 'O') s
  ON l.l_orderkey = s.l_orderkey AND l.l_linenumber = s.l_linenumber""")
def join_inner_2key(spark, sf):
    li = table(spark, sf, "lineitem")
    s = li.filter(li.l_linestatus == "O").select("l_orderkey", "l_linenumber",
                                                 F.year("l_shipdate").alias("SHIPYEAR")).distinct()
    return J.inner_join(li.select("l_orderkey", "l_linenumber", "l_partkey"), s, ["l_orderkey", "l_linenumber"])


@query("join_diff_keys", "JON-06", sql="""
SELECT o.o_orderkey, o.o_custkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def join_diff_keys(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return J.join_renamed(o, c, {"o_custkey": "c_custkey"})


@query("join_flag", "JON-07", sql="""
SELECT c.c_custkey, c.c_name, COALESCE(f.found, false) AS has_pending
FROM customer c LEFT JOIN (SELECT DISTINCT o_custkey, true AS found FROM orders WHERE o_orderstatus = 'P') f
  ON c.c_custkey = f.o_custkey""")
def join_flag(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    o = table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    return J.flag_join(c, o, ["c_custkey"], ["o_custkey"], flag="has_pending")


@query("join_anti", "JON-08", sql="""
SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)""")
def join_anti(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return J.anti_join(c, o, "c_custkey")


@query("join_outer", "JON-09", sql="""
SELECT COALESCE(c.key, s.key) AS key, c.c_name, s.s_name
FROM (SELECT c_custkey AS key, c_name FROM customer WHERE c_custkey % 2 = 0) c
FULL JOIN (SELECT s_suppkey * 3 AS key, s_name FROM supplier) s ON c.key = s.key""")
def join_outer(spark, sf):
    c = table(spark, sf, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("key"), "c_name")
    s = table(spark, sf, "supplier").select((F.col("s_suppkey") * 3).alias("key"), "s_name")
    return J.outer_join(c, s, "key")


@query("join_self_suffix", "JON-12", sql="""
SELECT a.c_custkey, a.c_nationkey, b.c_custkey AS c_custkey_r, b.c_name AS c_name_r
FROM customer a LEFT JOIN customer b ON CAST(a.c_nationkey AS BIGINT) = b.c_custkey""")
def join_self_suffix(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    out = J.self_join(c, "c_nationkey", "c_custkey")
    return out.select("c_custkey", "c_nationkey", "c_custkey_r", "c_name_r")


@query("star_lookup", "JON-13", sql="""
SELECT c.c_custkey, n.n_name, r.r_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def star_lookup(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    r = table(spark, sf, "region").select("r_regionkey", "r_name")
    return J.star_lookup(c, [(n, "n_nationkey"), (r, "r_regionkey")]).select("c_custkey", "n_name", "r_name")


@query("detail_attach", "JON-14 DED-01 DED-03", sql="""
WITH f AS (SELECT l_orderkey, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
             ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS rn FROM
             (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem)) WHERE rn = 1),
     l AS (SELECT l_orderkey, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
             ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_returnflag DESC) AS rn FROM
             (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem)) WHERE rn = 1),
     r AS (SELECT l_orderkey, min(l_suppkey) AS s FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT o.o_orderkey, f.l_partkey AS D1_PART, l.l_partkey AS D2_PART, r.s AS D3_SUPP
FROM orders o LEFT JOIN f ON o.o_orderkey = f.l_orderkey LEFT JOIN l ON o.o_orderkey = l.l_orderkey
LEFT JOIN r ON o.o_orderkey = r.l_orderkey""")
def detail_attach(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    d1 = DD.first_per_key(li, "l_orderkey", ["l_linenumber"]).select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("D1_PART"))
    d2 = DD.last_per_key(li, "l_orderkey", ["l_linenumber"]).select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("D2_PART"))
    d3 = DD.first_per_key(li.filter("l_returnflag = 'R'").select("l_orderkey", "l_suppkey"),
                          "l_orderkey", ["l_suppkey"]).select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("D3_SUPP"))
    return J.attach_details(table(spark, sf, "orders").select("o_orderkey"), [d1, d2, d3], "o_orderkey")


MM_SQL = """
WITH lt AS (SELECT o_custkey AS CUSTNO, o_orderkey AS ORDERNO, o_orderpriority AS STATUS FROM orders WHERE o_orderstatus = 'O'),
     rt AS (SELECT o_custkey AS CUSTNO, o_orderpriority || '#' || CAST(o_orderkey AS VARCHAR) AS ALIAS,
                   substr(o_orderpriority, 3) AS STATUS FROM orders WHERE o_orderstatus = 'F'),
     l AS (SELECT *, row_number() OVER (PARTITION BY CUSTNO ORDER BY ORDERNO) AS p FROM lt),
     r AS (SELECT *, row_number() OVER (PARTITION BY CUSTNO ORDER BY ALIAS) AS p FROM rt),
     c AS (SELECT COALESCE(a.CUSTNO, b.CUSTNO) AS CUSTNO, COALESCE(a.n, 0) AS nl, COALESCE(b.n, 0) AS nr
           FROM (SELECT CUSTNO, count(*) AS n FROM lt GROUP BY 1) a FULL JOIN (SELECT CUSTNO, count(*) AS n FROM rt GROUP BY 1) b
             ON a.CUSTNO = b.CUSTNO),
     s AS (SELECT CUSTNO, nl, nr, unnest(range(1, greatest(nl, nr) + 1)) AS slot FROM c WHERE nl > 0)
SELECT s.CUSTNO, l.ORDERNO, CASE WHEN {has_r} THEN r.STATUS ELSE l.STATUS END AS STATUS, r.ALIAS,
       s.slot, s.nl > 0 AS in_left, s.nr > 0 AS in_right
FROM s LEFT JOIN l ON l.CUSTNO = s.CUSTNO AND l.p = least(s.slot, s.nl)
       LEFT JOIN r ON r.CUSTNO = s.CUSTNO AND r.p = least(s.slot, s.nr)"""


def _mm_inputs(spark, sf):
    o = table(spark, sf, "orders")
    left = o.filter(o.o_orderstatus == "O").select(
        F.col("o_custkey").alias("CUSTNO"), F.col("o_orderkey").alias("ORDERNO"),
        F.col("o_orderpriority").alias("STATUS"))
    right = o.filter(o.o_orderstatus == "F").select(
        F.col("o_custkey").alias("CUSTNO"),
        F.concat("o_orderpriority", F.lit("#"), F.col("o_orderkey").cast("string")).alias("ALIAS"),
        F.substring("o_orderpriority", 3, 100).alias("STATUS"))
    return left, right


@query("match_merge", "JON-10", sql=MM_SQL.format(has_r="s.slot <= s.nr"))
def match_merge(spark, sf):
    left, right = _mm_inputs(spark, sf)
    return J.match_merge(left, right, "CUSTNO", ["ORDERNO"], ["ALIAS"], keep="left", overlay="positional")


@query("overlay_merge", "JON-11", sql="""
SELECT m.c_custkey, CASE WHEN g.c_custkey IS NOT NULL THEN g.BRANCH ELSE m.BRANCH END AS BRANCH, m.c_name, g.SEGMENT
FROM (SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS BRANCH, c_name FROM customer) m
LEFT JOIN (SELECT c_custkey, 'ORG' || CAST(c_custkey % 10 AS VARCHAR) AS BRANCH, c_mktsegment AS SEGMENT
           FROM customer WHERE c_custkey % 3 = 0) g ON m.c_custkey = g.c_custkey""")
def overlay_merge(spark, sf):
    c = table(spark, sf, "customer")
    main = c.select("c_custkey", F.col("c_nationkey").cast("string").alias("BRANCH"), "c_name")
    org = c.filter(c.c_custkey % 3 == 0).select(
        "c_custkey", F.concat(F.lit("ORG"), (c.c_custkey % 10).cast("string")).alias("BRANCH"),
        F.col("c_mktsegment").alias("SEGMENT"))
    return J.overlay_merge(main, org, "c_custkey")


@query("match_merge_hot", "JON-10 WIN-01 (skew-safe path forced)", sql=MM_SQL.format(has_r="s.slot <= s.nr"))
def match_merge_hot(spark, sf):
    left, right = _mm_inputs(spark, sf)
    return J.match_merge(left, right, "CUSTNO", ["ORDERNO"], ["ALIAS"], keep="left", overlay="positional",
                         skew_safe=True)

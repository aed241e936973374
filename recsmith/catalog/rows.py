"""Row operators over the test tables: filters (FLT), sorts (SRT), set
operations (SET), deduplication (DED), duplicate listing (AGG-01) and row
numbers (WIN-01)."""

from __future__ import annotations

from pyspark.sql import functions as F

from recsmith.catalog import roles, spec
from recsmith.catalog.registry import query, table
from recsmith.functions import strings as S
from recsmith.operators import dedup as DD
from recsmith.operators import filters as FL
from recsmith.operators import reshape as RS
from recsmith.operators.positions import global_row_number
from recsmith.operators.project import preview
from recsmith.sources.layout import Layout

ACCT = roles.ACCT_SQL


def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


# =============================================================== FLT
@query("flt_eq", "FLT-01", sql="SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def flt_eq(spark, sf):
    return FL.keep_equal(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", "F")


GENDER_SQL = ("CASE c_custkey % 5 WHEN 0 THEN 'O' WHEN 1 THEN NULL WHEN 2 THEN '' "
              "WHEN 3 THEN 'M' ELSE 'F' END")


def _gender():
    k = F.col("c_custkey") % 5
    return (F.when(k == 0, F.lit("O")).when(k == 1, F.lit(None).cast("string"))
            .when(k == 2, F.lit("")).when(k == 3, F.lit("M")).otherwise(F.lit("F")))


@query("flt_not_nullsafe", "FLT-02 SET-06", sql=f"""
SELECT c_custkey, g AS GENDER FROM (SELECT c_custkey, {GENDER_SQL} AS g FROM customer)
WHERE g IS DISTINCT FROM 'O'""")
def flt_not_nullsafe(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", _gender().alias("GENDER"))
    return FL.drop_equal(c, "GENDER", "O")


@query("flt_in", "FLT-03", sql="""
SELECT o_orderkey, a AS O_APPL_CODE
FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'DP   ' WHEN 1 THEN 'DP' ELSE 'LN   ' END AS a FROM orders)
WHERE rtrim(a) IN ('DP')""")
def flt_in(spark, sf):
    o = table(spark, sf, "orders")
    k = o.o_orderkey % 3
    a = F.when(k == 0, F.lit("DP   ")).when(k == 1, F.lit("DP")).otherwise(F.lit("LN   "))
    return FL.keep_in(o.select("o_orderkey", a.alias("O_APPL_CODE")), "O_APPL_CODE", ["DP   "])


def _country_sql():
    arr = "[" + ", ".join(_q(c) for c in spec.COUNTRIES) + "]"
    n = len(spec.COUNTRIES)
    return (f"CASE WHEN c_custkey % 4 = 0 THEN {arr}[CAST(c_custkey % {n} AS INTEGER) + 1] "
            f"WHEN c_custkey % 4 = 1 THEN rpad({arr}[CAST(c_custkey % {n} AS INTEGER) + 1], 10, ' ') "
            f"WHEN c_custkey % 9 = 2 THEN NULL ELSE 'MALAYSIA' END")


def _country():
    arr = F.array(*[F.lit(c) for c in spec.COUNTRIES])
    k = F.col("c_custkey")
    pick = F.element_at(arr, (k % len(spec.COUNTRIES)).cast("int") + 1)
    return (F.when(k % 4 == 0, pick).when(k % 4 == 1, F.rpad(pick, 10, " "))
            .when(k % 9 == 2, F.lit(None).cast("string")).otherwise(F.lit("MALAYSIA")))


@query("flt_denylist", "FLT-04", sql=f"""
SELECT c_custkey, COUNTRY FROM (SELECT c_custkey, {_country_sql()} AS COUNTRY FROM customer)
WHERE NOT COALESCE(rtrim(COUNTRY) IN ({', '.join(_q(c) for c in spec.COUNTRIES)}), false)""")
def flt_denylist(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", _country().alias("COUNTRY"))
    return FL.drop_in(c, "COUNTRY", FL.FOREIGN_COUNTRIES)


@query("flt_str_range", "FLT-05", sql=f"""
SELECT o_orderkey, a AS ACCTNO FROM (SELECT o_orderkey, {ACCT} AS a FROM orders) WHERE a > '010000000000'""")
def flt_str_range(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", roles.acct_no().alias("ACCTNO"))
    return FL.greater_than_text(o, "ACCTNO", "010000000000")


BLANKY_SQL = ("CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN NULL "
              "WHEN o_orderkey % 13 = 0 THEN '    ' ELSE o_orderpriority END")


def _blanky():
    k = F.col("o_orderkey")
    return (F.when(k % 7 == 0, F.lit("")).when(k % 11 == 0, F.lit(None).cast("string"))
            .when(k % 13 == 0, F.lit("    ")).otherwise(F.col("o_orderpriority")))


@query("flt_blank", "FLT-06", sql=f"""
SELECT o_orderkey, s FROM (SELECT o_orderkey, {BLANKY_SQL} AS s FROM orders) WHERE trim(COALESCE(s, '')) <> ''""")
def flt_blank(spark, sf):
    return FL.drop_blank(table(spark, sf, "orders").select("o_orderkey", _blanky().alias("s")), "s")


@query("flt_or_blank", "FLT-07", sql=f"""
SELECT o_orderkey, CITY, ZIP FROM (SELECT o_orderkey, {BLANKY_SQL} AS CITY,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE lpad(CAST(o_custkey AS VARCHAR), 5, '0') END AS ZIP FROM orders)
WHERE trim(COALESCE(CITY, '')) = '' OR trim(COALESCE(ZIP, '')) = ''""")
def flt_or_blank(spark, sf):
    o = table(spark, sf, "orders")
    z = F.when(o.o_orderkey % 5 == 0, F.lit("")).otherwise(F.lpad(o.o_custkey.cast("string"), 5, "0"))
    o = o.select("o_orderkey", _blanky().alias("CITY"), z.alias("ZIP"))
    return o.filter(FL.any_blank("CITY", "ZIP"))


def _addr_sql():
    arr = "[" + ", ".join(_q(w) for w in spec.WORDS) + "]"
    n = len(spec.WORDS)
    return (f"'NO ' || CAST(o_orderkey AS VARCHAR) || ' ' || CASE WHEN o_orderkey % 6 = 0 "
            f"THEN {arr}[CAST(o_orderkey % {n} AS INTEGER) + 1] ELSE 'JALAN' END")


def _addr():
    arr = F.array(*[F.lit(w) for w in spec.WORDS])
    k = F.col("o_orderkey")
    w = F.when(k % 6 == 0, F.element_at(arr, (k % len(spec.WORDS)).cast("int") + 1)).otherwise(F.lit("JALAN"))
    return F.concat(F.lit("NO "), k.cast("string"), F.lit(" "), w)


@query("flt_words", "FLT-08", sql=f"""
SELECT o_orderkey, ADDRLINE FROM (SELECT o_orderkey, {_addr_sql()} AS ADDRLINE FROM orders)
WHERE NOT ({' OR '.join(f'contains(ADDRLINE, {_q(w)})' for w in spec.WORDS)})""")
def flt_words(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", _addr().alias("ADDRLINE"))
    return FL.drop_words(o, "ADDRLINE")


@query("flt_expiry", "FLT-09", sql="""
SELECT o_orderkey, e AS EXPDATE FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL
                                      ELSE CAST(o_orderdate AS DATE) END AS e FROM orders)
WHERE e IS NULL OR e >= DATE '1997-06-30'""")
def flt_expiry(spark, sf):
    o = table(spark, sf, "orders")
    o = o.select("o_orderkey", F.when(o.o_orderkey % 5 != 0, F.to_date("o_orderdate")).alias("EXPDATE"))
    return o.filter(FL.not_expired("EXPDATE", "1997-06-30"))


@query("flt_num_range", "FLT-10", sql="""
SELECT o_orderkey, c, (c > 3000 AND c < 3999) AS inside_open
FROM (SELECT o_orderkey, o_orderkey % 5000 AS c FROM orders) WHERE c BETWEEN 3000 AND 3999""")
def flt_num_range(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 5000).alias("c"))
    return o.filter(FL.closed_range("c", 3000, 3999)).withColumn("inside_open", FL.open_range("c", 3000, 3999))


@query("flt_record_type", "FLT-11", sql="""
SELECT o_orderkey, REPTNO, FMTCODE FROM (SELECT o_orderkey,
  CASE WHEN o_orderkey % 3 = 0 THEN 1001 ELSE 1002 END AS REPTNO, o_orderkey % 25 AS FMTCODE FROM orders)
WHERE REPTNO = 1001 AND FMTCODE IN (1, 10, 19, 20, 21, 22)""")
def flt_record_type(spark, sf):
    o = table(spark, sf, "orders")
    o = o.select("o_orderkey", F.when(o.o_orderkey % 3 == 0, F.lit(1001)).otherwise(F.lit(1002)).alias("REPTNO"),
                 (o.o_orderkey % 25).alias("FMTCODE"))
    return o.filter(FL.record_type("REPTNO", "FMTCODE", 1001, [1, 10, 19, 20, 21, 22]))


from recsmith.catalog.columns import ZIP_OK_SQL, _zip_line, _zip_line_sql  # noqa: E402


@query("flt_char_class", "FLT-12", sql=f"""
SELECT o_orderkey, line FROM (SELECT o_orderkey, {_zip_line_sql()} AS line FROM orders) WHERE {ZIP_OK_SQL}""")
def flt_char_class(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", _zip_line().alias("line"))
    return o.filter(S.zip_line_ok("line"))


@query("flt_at_write", "FLT-13 STR-08 STR-09", sql=f"""
SELECT rpad(CAST(o_orderkey AS VARCHAR), 11, ' ') || rpad(upper(ltrim(COALESCE(city, ''))), 25, ' ') ||
       rpad(COALESCE(zip, ''), 5, ' ') AS value
FROM (SELECT o_orderkey, CASE WHEN {ZIP_OK_SQL} THEN substr(line, 1, 5) ELSE ' ' END AS zip,
             CASE WHEN {ZIP_OK_SQL} THEN substr(line, 7, 25) ELSE '' END AS city
      FROM (SELECT o_orderkey, {_zip_line_sql()} AS line FROM orders))
WHERE ltrim(zip) <> ''""")
def flt_at_write(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", _zip_line().alias("line"))
    ok = S.zip_line_ok("line")
    o = o.select("o_orderkey", F.when(ok, S.zip_of("line")).otherwise(F.lit(" ")).alias("zip"),
                 F.when(ok, S.city_of("line")).otherwise(F.lit("")).alias("city"))
    o = o.withColumn("zip", S.left_justify("zip")).filter(F.col("zip") != "")
    lay = Layout.of([("o_orderkey", 1, 11), ("city", 12, 25), ("zip", 37, 5)])
    return lay.render(o.withColumn("city", S.upper_text(S.left_justify("city"))))


# =============================================================== SRT / WIN
@query("sort_one", "SRT-01 WIN-01", sql="""
SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS row_no FROM orders""")
def sort_one(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return global_row_number(o, ["o_custkey", "o_orderkey"])


@query("sort_multi", "SRT-02", sql="""
SELECT o_orderkey, o_orderstatus, o_orderpriority,
       row_number() OVER (ORDER BY o_orderstatus, o_orderpriority, o_orderkey) AS row_no FROM orders""")
def sort_multi(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return global_row_number(o, ["o_orderstatus", "o_orderpriority", "o_orderkey"])


@query("sort_mixed", "SRT-03", sql="""
SELECT o_orderkey, o_custkey, o_orderdate,
       row_number() OVER (ORDER BY o_custkey, o_orderdate DESC, o_orderkey) AS row_no FROM orders""")
def sort_mixed(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return global_row_number(o, [F.col("o_custkey"), F.col("o_orderdate").desc(), F.col("o_orderkey")])


@query("preview_n", "SRT-04", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""")
def preview_n(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return preview(o, 5, F.col("o_totalprice").desc(), F.col("o_orderkey"))


@query("report_row_no", "WIN-01 SET-02", sql=f"""
SELECT src, ACCTNOC, row_number() OVER (ORDER BY src, ACCTNOC) AS row_no
FROM (SELECT 1 AS src, {ACCT} AS ACCTNOC FROM orders WHERE o_orderstatus <> 'P'
      UNION ALL SELECT 2 AS src, {ACCT} AS ACCTNOC FROM orders WHERE o_orderstatus = 'P')""")
def report_row_no(spark, sf):
    o = table(spark, sf, "orders")
    dp = o.filter(o.o_orderstatus != "P").select(F.lit(1).alias("src"), roles.acct_no().alias("ACCTNOC"))
    ln = o.filter(o.o_orderstatus == "P").select(F.lit(2).alias("src"), roles.acct_no().alias("ACCTNOC"))
    return global_row_number(RS.union_missing(dp, ln), ["src", "ACCTNOC"])


# =============================================================== SET
@query("union_all", "SET-01", sql="""
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'O'""")
def union_all(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return RS.union_all(o.filter(o.o_orderstatus == "P"), o.filter(o.o_orderstatus != "O"))


@query("union_missing", "SET-02", sql="""
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, NULL::DOUBLE AS acctbal FROM customer
UNION ALL SELECT s_suppkey AS key, s_name AS name, NULL::INTEGER AS nationkey, s_acctbal AS acctbal FROM supplier""")
def union_missing(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                             F.col("c_nationkey").alias("nationkey"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
                                             F.col("s_acctbal").alias("acctbal"))
    return RS.union_missing(c, s)


@query("union_widen", "SET-03", sql="""
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS val FROM nation
UNION ALL SELECT c_custkey AS id, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS val FROM customer""")
def union_widen(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("val"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"),
                                             F.col("c_acctbal").cast("decimal(18,2)").alias("val"))
    return RS.union_widen(n, c)


@query("symmetrise", "SET-04", sql=f"""
WITH e AS ({roles.CUST_REL_SQL})
SELECT CUST1, CODE1, CUST2, CODE2 FROM e UNION ALL SELECT CUST2, CODE2, CUST1, CODE1 FROM e""")
def symmetrise(spark, sf):
    return RS.symmetrise(roles.cust_rel(spark, sf), [("CUST1", "CUST2"), ("CODE1", "CODE2")])


@query("route_outputs", "SET-05", sql="""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'open' WHEN o_orderstatus = 'F' THEN 'final'
                        ELSE 'other' END AS route FROM orders""")
def route_outputs(spark, sf):
    o = table(spark, sf, "orders")
    return RS.route(o, {"open": o.o_orderstatus == "O", "final": o.o_orderstatus == "F"},
                    default="other").select("o_orderkey", "route")


@query("split_complement", "SET-06", sql=f"""
SELECT c_custkey, 'other' AS part FROM customer WHERE ({GENDER_SQL}) = 'O'
UNION ALL SELECT c_custkey, 'rest' AS part FROM customer WHERE ({GENDER_SQL}) IS DISTINCT FROM 'O'""")
def split_complement(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", _gender().alias("g"))
    a, b = RS.split(c, F.col("g") == "O")
    return RS.union_all(a.select("c_custkey", F.lit("other").alias("part")),
                        b.select("c_custkey", F.lit("rest").alias("part")))


@query("unpivot_ids", "SET-07", sql=f"""
SELECT c_custkey, 'ID1' AS source, c_name AS value FROM customer
UNION ALL SELECT c_custkey, 'ID2' AS source, s AS value FROM (SELECT c_custkey, {BLANKY_SQL.replace('o_orderkey', 'c_custkey').replace('o_orderpriority', 'c_mktsegment')} AS s FROM customer)
WHERE trim(COALESCE(s, '')) <> ''""")
def unpivot_ids(spark, sf):
    c = table(spark, sf, "customer")
    k = c.c_custkey
    s = (F.when(k % 7 == 0, F.lit("")).when(k % 11 == 0, F.lit(None).cast("string"))
         .when(k % 13 == 0, F.lit("    ")).otherwise(c.c_mktsegment))
    c = c.select("c_custkey", F.col("c_name").alias("ID1"), s.alias("ID2"))
    return RS.unpivot_nonblank(c, ["c_custkey"], ["ID1", "ID2"])


# =============================================================== DED / AGG
LI_REST = ("l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, "
           "l_linestatus, l_shipdate")


@query("first_per_key", "DED-01", sql=f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, {LI_REST}) AS rn FROM lineitem)
WHERE rn = 1""")
def first_per_key(spark, sf):
    return DD.first_per_key(table(spark, sf, "lineitem"), "l_orderkey", ["l_linenumber"])


@query("distinct_subset", "DED-02", sql="SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_subset(spark, sf):
    return DD.distinct_on(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]) \
        .select("l_orderkey", "l_linenumber")


@query("keep_first_last", "DED-03", sql=f"""
SELECT f.l_orderkey, f.l_partkey AS first_part, l.l_partkey AS last_part
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, {LI_REST}) AS rn FROM lineitem) f
JOIN (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC,
        {', '.join(c.strip() + ' DESC' for c in LI_REST.split(','))}) AS rn FROM lineitem) l
  ON f.l_orderkey = l.l_orderkey AND f.rn = 1 AND l.rn = 1""")
def keep_first_last(spark, sf):
    li = table(spark, sf, "lineitem")
    f = DD.first_per_key(li, "l_orderkey", ["l_linenumber"]).select("l_orderkey", F.col("l_partkey").alias("first_part"))
    last = DD.last_per_key(li, "l_orderkey", ["l_linenumber"]).select("l_orderkey", F.col("l_partkey").alias("last_part"))
    return f.join(last, "l_orderkey")


@query("latest_per_key", "DED-04 SRT-03", sql="""
SELECT user_id, ts, event_id, event_type, value, props
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, event_type DESC,
                                   value DESC, props DESC) AS rn FROM events) WHERE rn = 1""")
def latest_per_key(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value", "props")
    return DD.latest_per_key(ev, "user_id", ["ts"])


@query("distinct_rows", "DED-05", sql="SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def distinct_rows(spark, sf):
    return DD.distinct_rows(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


LI_LAYOUT = Layout.of([("l_orderkey", 1, 10, "z"), ("l_linenumber", 11, 3, "z"), ("l_returnflag", 14, 1),
                       ("l_partkey", 15, 8, "z"), ("l_linestatus", 23, 1)])
LI_LINE_SQL = ("lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') || "
               "rpad(l_returnflag, 1, ' ') || lpad(CAST(l_partkey AS VARCHAR), 8, '0') || rpad(l_linestatus, 1, ' ')")


@query("record_prefix_key", "DED-06 SNK-04", sql=f"""
SELECT record FROM (SELECT record, row_number() OVER (PARTITION BY substr(record, 1, 14) ORDER BY record) AS rn
                    FROM (SELECT {LI_LINE_SQL} AS record FROM lineitem)) WHERE rn = 1""")
def record_prefix_key(spark, sf):
    recs = LI_LAYOUT.render(table(spark, sf, "lineitem"), name="record")
    return DD.distinct_on_prefix(recs, "record", 14, ["record"])


@query("alias_union_distinct", "DED-07", sql=f"""
SELECT DISTINCT v AS ALIAS FROM (
  SELECT c_name AS v FROM customer
  UNION ALL SELECT {BLANKY_SQL.replace('o_orderkey', 'c_custkey').replace('o_orderpriority', 'c_mktsegment')} AS v FROM customer)
WHERE trim(COALESCE(v, '')) <> ''""")
def alias_union_distinct(spark, sf):
    c = table(spark, sf, "customer")
    k = c.c_custkey
    s = (F.when(k % 7 == 0, F.lit("")).when(k % 11 == 0, F.lit(None).cast("string"))
         .when(k % 13 == 0, F.lit("    ")).otherwise(c.c_mktsegment))
    return DD.union_distinct(c.select("c_name", s.alias("seg")), ["c_name", "seg"], "ALIAS")


@query("all_dups", "AGG-01", sql="""
SELECT l.* FROM lineitem l JOIN (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1) d
  ON l.l_orderkey = d.l_orderkey AND l.l_linenumber = d.l_linenumber""")
def all_dups(spark, sf):
    return DD.all_duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])

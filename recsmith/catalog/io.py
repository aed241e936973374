"""Sources and sinks over the test tables (SRC-*, SNK-*).

Writers are checked by reading their output back: files go to a fresh
folder under the shared checkpoint directory (never a machine-local temp
folder), and the DuckDB twin is the source rows the file must reproduce.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from recsmith.catalog import roles
from recsmith.catalog.registry import query, table
from recsmith.functions.numbers import money
from recsmith.session import scratch_path
from recsmith.sinks import writers as W
from recsmith.sources import readers as RD
from recsmith.sources.layout import Layout

ACCT = roles.ACCT_SQL


def _fresh(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


# ================================================================ scans
@query("scan_parquet", "SRC-01", sql="SELECT * FROM orders")
def scan_parquet(spark, sf):
    return RD.read_parquet(spark, f"{sf}/orders.parquet")


@query("scan_named", "SRC-02", sql="SELECT * FROM customer")
def scan_named(spark, sf):
    return RD.Catalog(spark, root=sf).load("customer")


@query("scan_pruned", "SRC-03", sql="SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'R'")
def scan_pruned(spark, sf):
    li = RD.Catalog(spark, root=sf).load("lineitem", ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag"])
    return li.filter(F.col("l_returnflag") == "R").drop("l_returnflag")


@query("scan_multi_path", "SRC-12", sql="""
SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT s_suppkey AS key, s_name AS name FROM supplier""")
def scan_multi_path(spark, sf):
    c = RD.read_parquet(spark, f"{sf}/customer.parquet").select(F.col("c_custkey").alias("key"),
                                                                 F.col("c_name").alias("name"))
    s = RD.read_parquet(spark, f"{sf}/supplier.parquet").select(F.col("s_suppkey").alias("key"),
                                                                 F.col("s_name").alias("name"))
    return RD.union_inputs([c, s])


@query("scan_latest_generation", "SRC-13", sql="""
SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS generation FROM orders
WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""")
def scan_latest_generation(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("generation"))
    return RD.latest_generation(o)


@query("scan_control_date", "SRC-14 FLT-09", sql="""
SELECT o_orderkey, CAST(o_orderdate AS DATE) >= (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) - INTERVAL 365 DAY AS recent
FROM orders""")
def scan_control_date(spark, sf):
    o = table(spark, sf, "orders")
    ctl = o.agg(F.max("o_orderdate").alias("d")).select(F.year("d").alias("YY"), F.month("d").alias("MM"),
                                                        F.dayofmonth("d").alias("DD"))
    run = RD.control_date(ctl)
    return o.select("o_orderkey", (F.to_date("o_orderdate") >= F.date_sub(F.lit(run).cast("date"), 365)).alias("recent"))


@query("scan_table", "SRC-15", sql="SELECT n_nationkey, n_name FROM nation")
def scan_table(spark, sf):
    table(spark, sf, "nation").createOrReplaceTempView("recsmith_nation")
    return RD.read_table(spark, "recsmith_nation").select("n_nationkey", "n_name")


# ======================================================= fixed-width text
ORDER_LAYOUT = Layout.of([
    ("o_orderkey", 1, 11, "z"), ("o_custkey", 12, 11, "z"), ("o_orderstatus", 23, 1),
    ("o_orderpriority", 25, 15), ("price", 41, 15, "n", 2), ("odate", 57, 10, "d"),
], lrecl=80)


@query("fixed_roundtrip", "SRC-04 SRC-05 SRC-07 SNK-04 SNK-10", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(o_totalprice AS DECIMAL(16,2)) AS price,
       CAST(o_orderdate AS DATE) AS odate FROM orders""")
def fixed_roundtrip(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                                          money("o_totalprice").alias("price"),
                                          F.to_date("o_orderdate").alias("odate"))
    path = _fresh(spark, "fixed")
    W.write_lines(W.fixed_lines(o, ORDER_LAYOUT), path)
    return RD.read_fixed_text(spark, path, ORDER_LAYOUT)


@query("numeric_fields", "SRC-05", sql="""
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(13,2)) AS amount, o_custkey AS custno FROM orders""")
def numeric_fields(spark, sf):
    o = table(spark, sf, "orders")
    cents = (money("o_totalprice") * 100).cast("long")
    rec = o.select("o_orderkey", F.concat(F.lpad(cents.cast("string"), 12, "0"), F.lit(" "),
                                          F.lpad(o.o_custkey.cast("string"), 6, " ")).alias("value"))
    lay = Layout.of([("amount", 1, 12, "n", 2), ("custno", 14, 6, "n")])
    return lay.decode(rec, keep=["o_orderkey"])


@query("overlap_fields", "SRC-08", sql=f"""
SELECT o_orderkey, {ACCT} AS ACCTNOC, substr({ACCT}, 1, 2) AS ACCTNOR, substr({ACCT}, 6, 4) AS PART
FROM orders""")
def overlap_fields(spark, sf):
    rec = table(spark, sf, "orders").select("o_orderkey", roles.acct_no().alias("value"))
    # PART is declared twice on the same record: the later declaration wins.
    lay = Layout.of([("ACCTNOC", 1, 11), ("ACCTNOR", 1, 2), ("PART", 3, 4), ("PART", 6, 4)])
    return lay.decode(rec, keep=["o_orderkey"])


@query("short_records", "SRC-10", sql="""
SELECT o_orderkey, o_orderstatus AS status, '' AS missing_text, CAST(NULL AS BIGINT) AS missing_num FROM orders""")
def short_records(spark, sf):
    rec = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("value"))
    lay = Layout.of([("status", 1, 1), ("missing_text", 2, 20), ("missing_num", 30, 5, "n")])
    return lay.decode(rec, keep=["o_orderkey"])


@query("multi_format", "SRC-11 FLT-11", sql="""
SELECT CAST(REPTNO AS BIGINT) AS REPTNO, FMTCODE, o_custkey AS CUSTNO, o_orderpriority AS PRIORITY
FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 1001 ELSE 1002 END AS REPTNO, o_orderkey % 25 AS FMTCODE FROM orders)
WHERE REPTNO = 1001 AND FMTCODE IN (1, 10, 19, 20, 21, 22)""")
def multi_format(spark, sf):
    o = table(spark, sf, "orders")
    rept = F.when(o.o_orderkey % 3 == 0, F.lit("1001")).otherwise(F.lit("1002"))
    rec = o.select(F.concat(rept, F.lpad((o.o_orderkey % 25).cast("string"), 2, "0"),
                            F.lpad(o.o_custkey.cast("string"), 8, "0"),
                            F.rpad("o_orderpriority", 15, " ")).alias("value"))
    head = Layout.of([("REPTNO", 1, 4, "n"), ("FMTCODE", 5, 2, "n")])
    body = Layout.of([("CUSTNO", 7, 8, "n"), ("PRIORITY", 15, 15)])
    pred = (F.col("REPTNO") == 1001) & F.col("FMTCODE").isin(1, 10, 19, 20, 21, 22)
    return RD.decode_when(rec, head, pred, body)


PACKED_SQL = "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey - 7500 END"


@query("packed_roundtrip", "SRC-06", sql=f"""
SELECT o_orderkey, {PACKED_SQL} AS hexval, {PACKED_SQL} AS binval,
       CAST(CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE (o_orderkey - 7500) / 100 END AS DECIMAL(38,2)) AS scaled
FROM orders""")
def packed_roundtrip(spark, sf):
    from recsmith.sources.layout import pack_hex
    o = table(spark, sf, "orders")
    hx = pack_hex(o.o_orderkey - 7500, 6)
    # every 13th record carries an invalid sign nibble -> missing
    hx = F.when(o.o_orderkey % 13 == 0, F.concat(F.substring(hx, 1, 11), F.lit("A"))).otherwise(hx)
    rec = o.select("o_orderkey", hx.alias("value"), F.unhex(hx).alias("bin"))
    txt = Layout.of([("hexval", 1, 6, "x"), ("scaled", 1, 6, "x", 2)]).decode(rec, keep=["o_orderkey", "bin"])
    out = Layout.of([("binval", 1, 6, "p")]).decode(txt, record="bin", keep=["o_orderkey", "hexval", "scaled"],
                                                   binary=True)
    return out


@query("delimited_roundtrip", "SRC-09 SNK-02 SNK-07", sql="""
SELECT substr(CAST(o_orderkey AS VARCHAR), 1, 3) AS ALIASKEY, substr(o_orderpriority, 1, 37) AS ALIAS,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS AMOUNT FROM orders""")
def delimited_roundtrip(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("ALIASKEY"),
                                          F.col("o_orderpriority").alias("ALIAS"),
                                          money("o_totalprice").alias("AMOUNT"))
    path = _fresh(spark, "csv")
    W.write_csv(o, path, sep=";", header=False, quote_all=True)
    return RD.read_delimited(spark, path, ["ALIASKEY", "ALIAS", "AMOUNT"], sep=";",
                             max_width={"ALIASKEY": 3, "ALIAS": 37})


@query("parquet_roundtrip", "SNK-01 SNK-10", sql="SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def parquet_roundtrip(spark, sf):
    path = _fresh(spark, "pq")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    W.write_parquet(o, path)
    W.write_parquet(o, path)  # rerun replaces, never appends
    return RD.read_parquet(spark, path)


# =============================================================== text sinks
PARTY_SQL = ("'\"' || CAST(c_custkey AS VARCHAR) || '\",\"' || c_name || '\",\"' || c_mktsegment || '\", \\N'")


@query("quoted_line", "SNK-03", sql=f"SELECT {PARTY_SQL} AS value FROM customer")
def quoted_line(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(W.quoted_line([c.c_custkey.cast("string"), c.c_name, c.c_mktsegment], ",", ", \\N")
                    .alias("value"))


@query("fixed_line", "SNK-04", sql=f"""
SELECT rpad('DP', 5, ' ') || rpad({ACCT}, 20, ' ') || rpad(substr(o_orderpriority, 1, 3), 3, ' ') ||
       rpad(CAST(o_custkey AS VARCHAR), 11, ' ') || rpad('', 111, ' ') AS value FROM orders""")
def fixed_line(spark, sf):
    from recsmith.plans.owners import OWNER_LAYOUT
    o = table(spark, sf, "orders").select(
        F.lit("DP").alias("ACCTCODE"), roles.acct_no().alias("ACCTNOC"),
        F.substring("o_orderpriority", 1, 3).alias("RLENCODE"), F.col("o_custkey").cast("string").alias("CUSTNO"),
        F.lit("").alias("CODE1"), F.lit("").alias("CUSTNO2"), F.lit("").alias("CODE2"))
    return W.fixed_lines(o, OWNER_LAYOUT)


@query("header_report", "SNK-05 WIN-02", sql=f"""
SELECT 0::BIGINT AS line_no, rpad('CIS #', 12, ' ') || rpad('STATUS', 8, ' ') || 'PRIORITY' AS value
UNION ALL
SELECT row_number() OVER (ORDER BY a), rpad(a, 12, ' ') || rpad(o_orderstatus, 8, ' ') || o_orderpriority
FROM (SELECT {ACCT} AS a, o_orderstatus, o_orderpriority FROM orders)""")
def header_report(spark, sf):
    o = table(spark, sf, "orders").select(roles.acct_no().alias("a"), "o_orderstatus", "o_orderpriority")
    body = o.select("a", F.concat(F.rpad("a", 12, " "), F.rpad("o_orderstatus", 8, " "),
                                  F.col("o_orderpriority")).alias("value"))
    head = "CIS #".ljust(12) + "STATUS".ljust(8) + "PRIORITY"
    return W.with_header(body, head, ["a"])


@query("semicolon_report", "SNK-06", sql=f"""
SELECT 0::BIGINT AS line_no, 'CUSTOMER REPORT' AS value
UNION ALL
SELECT row_number() OVER (ORDER BY c_custkey),
       rpad(CAST(c_custkey AS VARCHAR), 8, ' ') || ';' || rpad(c_name, 20, ' ') || ';' ||
       rpad(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), 12, ' ')
FROM customer""")
def semicolon_report(spark, sf):
    c = table(spark, sf, "customer")
    body = c.select("c_custkey", W.report_line([c.c_custkey, c.c_name, money("c_acctbal")], [8, 20, 12])
                    .alias("value"))
    return W.with_header(body, "CUSTOMER REPORT", ["c_custkey"])


@query("multi_layout", "SNK-08 SNK-03 SNK-04", sql="""
SELECT 'Q' AS layout, '"' || CAST(c_custkey AS VARCHAR) || '","' || c_name || '"' AS value FROM customer
UNION ALL SELECT 'F' AS layout, lpad(CAST(c_custkey AS VARCHAR), 8, '0') || rpad(c_name, 25, ' ') FROM customer""")
def multi_layout(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    base = _fresh(spark, "layouts")
    lay = Layout.of([("c_custkey", 1, 8, "z"), ("c_name", 9, 25)])
    W.write_lines(c.select(W.quoted_line([c.c_custkey.cast("string"), c.c_name]).alias("value")), base + "/quoted")
    W.write_lines(W.fixed_lines(c, lay), base + "/fixed")
    q = spark.read.text(base + "/quoted").select(F.lit("Q").alias("layout"), "value")
    f = spark.read.text(base + "/fixed").select(F.lit("F").alias("layout"), "value")
    return q.unionByName(f)


@query("generation_write", "SNK-09 SRC-13", sql="""
SELECT o_orderkey, o_orderstatus, 2 AS generation FROM orders WHERE o_orderstatus = 'F'""")
def generation_write(spark, sf):
    base = _fresh(spark, "gdg")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    W.write_generation(o.filter("o_orderstatus = 'O'"), base, 1)
    W.write_generation(o.filter("o_orderstatus = 'F'"), base, 2)
    return RD.latest_generation(spark.read.parquet(base)).select("o_orderkey", "o_orderstatus", "generation")


@query("bucketed_table", "SNK-11 SRC-15", sql="""
SELECT o_custkey AS CUSTNO, o_orderkey AS ID, o_orderpriority AS IDTYPE FROM orders""")
def bucketed_table(spark, sf):
    name = "recsmith_idx_" + uuid.uuid4().hex[:8]
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("CUSTNO"), F.col("o_orderpriority").alias("IDTYPE"),
                                          F.col("o_orderkey").alias("ID"))
    W.write_bucketed(o, name, ["CUSTNO"], 8, ["CUSTNO", "IDTYPE", "ID"], path=_fresh(spark, name))
    return RD.read_table(spark, name).select("CUSTNO", "ID", "IDTYPE")


@query("daily_stream_generation", "SNK-09 SRC-13 PIPE-06 (available-now daily run)", sql="""
SELECT CASE WHEN substr(ACCTNOC, 1, 2) IN ('02', '08') THEN 'LN'
            WHEN substr(ACCTNOC, 1, 2) IN ('01', '03', '04', '05', '06', '07') THEN 'DP' ELSE '' END AS ACCTCODE,
       ACCTNOC, CUSTNO, RLENCODE
FROM (SELECT lpad(CAST((o_orderkey % 9 + 1) * 1000000000 + o_orderkey AS VARCHAR), 11, '0') AS ACCTNOC,
             CAST(o_custkey AS VARCHAR) AS CUSTNO, substr(o_orderpriority, 1, 3) AS RLENCODE, o_orderstatus FROM orders)
WHERE o_orderstatus = 'F'""")
def daily_stream_generation(spark, sf):
    """Primary accounts computed by an available-now streaming run over the
    landed orders extract; the newest generation is read back."""
    from recsmith.plans.owners import primary_accounts
    from recsmith.streaming.daily import run_available

    def plan(batch):
        rel = batch.select(roles.acct_no().alias("ACCTNOC"), F.col("o_custkey").cast("string").alias("CUSTNO"),
                           F.substring("o_orderpriority", 1, 3).alias("RLENCODE"),
                           F.when(F.col("o_orderstatus") == "F", F.lit("901")).otherwise(F.lit("000")).alias("PRISEC"))
        return primary_accounts(rel)

    sink = _fresh(spark, "daily")
    schema = table(spark, sf, "orders").schema
    run_available(spark, sf, schema, plan, sink, _fresh(spark, "daily-checkpoint"), glob="orders.parquet")
    return RD.latest_generation(spark.read.parquet(sink)).drop("generation")

"""Column functions over the test tables: projections (PRJ), strings (STR),
dates (DAT), blanks (NUL), money (MTH), conditions (CND), rules (CLS) and the
expression-helper surface (UDF-03/04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from recsmith.catalog import roles, spec
from recsmith.catalog.registry import query, table
from recsmith.functions import blanks as B
from recsmith.functions import dates as D
from recsmith.functions import numbers as N
from recsmith.functions import rules as R
from recsmith.functions import strings as S
from recsmith.operators import project as P
from recsmith.operators.reshape import flip_pairs
from recsmith.sources.readers import control_date

ACCT = roles.ACCT_SQL


def _orders(spark, sf):
    return table(spark, sf, "orders")


def _cust(spark, sf):
    return table(spark, sf, "customer")


# =============================================================== PRJ
@query("select_rename_keep", "PRJ-01 PRJ-02 PRJ-03", sql="""
SELECT c_custkey AS CUSTNO, c_name AS CUSTNAME, c_mktsegment AS SEGMENT FROM customer""")
def select_rename_keep(spark, sf):
    return P.select_renamed(_cust(spark, sf), ["c_custkey", "c_name", "c_mktsegment"],
                            {"c_custkey": "CUSTNO", "c_name": "CUSTNAME", "c_mktsegment": "SEGMENT"})


@query("derived_cols", "PRJ-07", sql="""
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS BAL, o_orderkey % 100 AS BRANCH,
       o_orderstatus || o_orderpriority AS TAG
FROM orders""")
def derived_cols(spark, sf):
    return _orders(spark, sf).select(
        "o_orderkey", N.money("o_totalprice").alias("BAL"), (F.col("o_orderkey") % 100).alias("BRANCH"),
        S.concat_text("o_orderstatus", "o_orderpriority").alias("TAG"))


@query("strict_cast", "PRJ-04", sql="""
SELECT CAST(o_custkey AS VARCHAR) AS CUSTNO, CAST(o_orderkey AS INTEGER) AS KEYINT FROM orders""")
def strict_cast(spark, sf):
    o = _orders(spark, sf).select(F.col("o_custkey").alias("CUSTNO"), F.col("o_orderkey").alias("KEYINT"))
    return P.strict_cast(o, {"CUSTNO": "string", "KEYINT": "int"})


@query("lenient_cast", "PRJ-05", sql="""
SELECT o_orderkey, TRY_CAST(t AS BIGINT) AS NUM
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' || CAST(o_orderkey AS VARCHAR)
                              ELSE CAST(o_orderkey AS VARCHAR) END AS t FROM orders)""")
def lenient_cast(spark, sf):
    o = _orders(spark, sf)
    t = F.when(o.o_orderkey % 5 == 0, F.concat(F.lit("X"), o.o_orderkey.cast("string"))) \
        .otherwise(o.o_orderkey.cast("string"))
    return P.lenient_cast(o.select("o_orderkey", t.alias("NUM")), {"NUM": "long"})


@query("literal_cols", "PRJ-06", sql="""
SELECT o_orderkey, 0 AS LEDGERBAL, 'C' AS BANKINDC FROM orders""")
def literal_cols(spark, sf):
    return P.with_literals(_orders(spark, sf).select("o_orderkey"), {"LEDGERBAL": 0, "BANKINDC": "C"})


@query("truncate_width", "PRJ-08", sql="""
SELECT c_custkey, substr(c_name, 1, 10) AS c_name, substr(c_mktsegment, 1, 4) AS c_mktsegment FROM customer""")
def truncate_width(spark, sf):
    c = _cust(spark, sf).select("c_custkey", "c_name", "c_mktsegment")
    return P.truncate_width(c, {"c_name": 10, "c_mktsegment": 4})


@query("optional_cols", "PRJ-09", sql="""
SELECT c_custkey, c_name, 'NIL' AS c_phone FROM customer""")
def optional_cols(spark, sf):
    c = _cust(spark, sf).select("c_custkey", "c_name")
    return P.ensure_columns(c, {"c_phone": "NIL", "c_name": "unused"})


@query("flip_pairs", "PRJ-10", sql=f"""
SELECT CUST2 AS CUST1, CODE2 AS CODE1, CUST1 AS CUST2, CODE1 AS CODE2 FROM ({roles.CUST_REL_SQL}) e""")
def flip_pairs_q(spark, sf):
    return flip_pairs(roles.cust_rel(spark, sf), [("CUST1", "CUST2"), ("CODE1", "CODE2")])


@query("alias_copy", "PRJ-11", sql="""
SELECT c_custkey, c_name, c_name AS CUSTNAME2 FROM customer""")
def alias_copy(spark, sf):
    return P.copy_column(_cust(spark, sf).select("c_custkey", "c_name"), "c_name", "CUSTNAME2")


# =============================================================== STR
@query("str_substring", "STR-01", sql="SELECT c_custkey, substr(c_name, 10, 9) AS part FROM customer")
def str_substring(spark, sf):
    return _cust(spark, sf).select("c_custkey", S.substr("c_name", 10, 9).alias("part"))


@query("str_suffix", "STR-02", sql="SELECT c_custkey, right(c_name, 3) AS tail FROM customer")
def str_suffix(spark, sf):
    return _cust(spark, sf).select("c_custkey", S.suffix("c_name", 3).alias("tail"))


@query("str_concat", "STR-03", sql="""
SELECT c_custkey, c_name || '-' || c_mktsegment AS label FROM customer""")
def str_concat(spark, sf):
    return _cust(spark, sf).select("c_custkey", S.concat_text("c_name", F.lit("-"), "c_mktsegment").alias("label"))


@query("str_remove", "STR-04", sql="""
SELECT o_orderkey, translate(o_orderpriority, ' -', '') AS packed FROM orders""")
def str_remove(spark, sf):
    return _orders(spark, sf).select("o_orderkey", S.remove_chars("o_orderpriority", " -").alias("packed"))


@query("str_translate", "STR-05", sql="""
SELECT o_orderkey, translate(o_orderpriority, ' -', '0_') AS mapped FROM orders""")
def str_translate(spark, sf):
    return _orders(spark, sf).select("o_orderkey",
                                     S.translate_chars("o_orderpriority", " -", "0_").alias("mapped"))


@query("str_zero_pad", "STR-06", sql="""
SELECT o_orderkey,
  CASE WHEN v < 0 THEN '-' || CASE WHEN length(CAST(abs(v) AS VARCHAR)) >= 5 THEN CAST(abs(v) AS VARCHAR)
                                   ELSE lpad(CAST(abs(v) AS VARCHAR), 5, '0') END
       ELSE CASE WHEN length(CAST(v AS VARCHAR)) >= 6 THEN CAST(v AS VARCHAR)
                 ELSE lpad(CAST(v AS VARCHAR), 6, '0') END END AS padded
FROM (SELECT o_orderkey, o_orderkey * 37 - 100000 AS v FROM orders)""")
def str_zero_pad(spark, sf):
    o = _orders(spark, sf)
    return o.select("o_orderkey", S.zero_pad(o.o_orderkey * 37 - 100000, 6).alias("padded"))


@query("str_trim", "STR-07", sql="""
SELECT c_custkey, trim('  ' || c_mktsegment || '  ') AS seg FROM customer""")
def str_trim(spark, sf):
    return _cust(spark, sf).select(
        "c_custkey", S.trim_text(F.concat(F.lit("  "), "c_mktsegment", F.lit("  "))).alias("seg"))


@query("str_left", "STR-08", sql="""
SELECT c_custkey, ltrim('   ' || c_name || ' ') AS name_left FROM customer""")
def str_left(spark, sf):
    return _cust(spark, sf).select(
        "c_custkey", S.left_justify(F.concat(F.lit("   "), "c_name", F.lit(" "))).alias("name_left"))


@query("str_upper", "STR-09", sql="SELECT p_partkey, upper(p_name) AS name_uc FROM part")
def str_upper(spark, sf):
    return table(spark, sf, "part").select("p_partkey", S.upper_text("p_name").alias("name_uc"))


@query("str_contains", "STR-10", sql="""
SELECT p_partkey, contains(p_name, 'red') AS has_red,
       (contains(p_name, 'ring') OR contains(p_name, 'bolt')) AS has_any,
       regexp_matches(p_name, '^(small|large) ') AS sized
FROM part""")
def str_contains(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", S.contains_text("p_name", "red").alias("has_red"),
                    S.contains_any("p_name", ["ring", "bolt"]).alias("has_any"),
                    p.p_name.rlike("^(small|large) ").alias("sized"))


@query("str_replace_value", "STR-11", sql="""
SELECT c_custkey, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'NIL' ELSE c_mktsegment END AS seg
FROM customer""")
def str_replace_value(spark, sf):
    return _cust(spark, sf).select("c_custkey", S.replace_value("c_mktsegment", "HOUSEHOLD", "NIL").alias("seg"))


@query("str_overlay", "STR-12", sql=f"""
SELECT o_orderkey, '0' || substr({ACCT}, 2) AS acct0 FROM orders""")
def str_overlay(spark, sf):
    return _orders(spark, sf).select("o_orderkey", S.overlay_at(roles.acct_no(), "0", 1).alias("acct0"))


def _zip_line_sql(key="o_orderkey"):
    return (f"CASE WHEN {key} % 13 = 0 THEN lpad(CAST({key} % 100000 AS VARCHAR), 5, '0') || 'X' || 'CITY ' || CAST(o_custkey AS VARCHAR) "
            f"WHEN {key} % 11 = 0 THEN substr(lpad(CAST({key} % 100000 AS VARCHAR), 5, '0'), 1, 2) || ',' || substr(lpad(CAST({key} % 100000 AS VARCHAR), 5, '0'), 4, 2) || ' CITY ' || CAST(o_custkey AS VARCHAR) "
            f"WHEN {key} % 7 = 0 THEN lpad(CAST({key} % 100000 AS VARCHAR), 5, '0') "
            f"ELSE lpad(CAST({key} % 100000 AS VARCHAR), 5, '0') || ' CITY ' || CAST(o_custkey AS VARCHAR) END")


def _zip_line():
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    z = F.lpad((k % 100000).cast("string"), 5, "0")
    return (F.when(k % 13 == 0, F.concat(z, F.lit("X"), F.lit("CITY "), c.cast("string")))
            .when(k % 11 == 0, F.concat(F.substring(z, 1, 2), F.lit(","), F.substring(z, 4, 2),
                                        F.lit(" CITY "), c.cast("string")))
            .when(k % 7 == 0, z)
            .otherwise(F.concat(z, F.lit(" CITY "), c.cast("string"))))


ZIP_OK_SQL = ("(substr(rpad(line, 6, ' '), 1, 5) > '00001' AND substr(rpad(line, 6, ' '), 1, 5) < '99998' "
              "AND regexp_matches(substr(rpad(line, 6, ' '), 1, 5), '^[^ ,&/\\-]{5}$') "
              "AND substr(rpad(line, 6, ' '), 6, 1) = ' ')")


@query("str_zip_city", "STR-13 FLT-12", sql=f"""
SELECT o_orderkey, CASE WHEN {ZIP_OK_SQL} THEN substr(line, 1, 5) END AS zip,
       CASE WHEN {ZIP_OK_SQL} THEN substr(line, 7, 25) END AS city
FROM (SELECT o_orderkey, {_zip_line_sql()} AS line FROM orders)""")
def str_zip_city(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", _zip_line().alias("line"))
    ok = S.zip_line_ok("line")
    return o.select("o_orderkey", F.when(ok, S.zip_of("line")).alias("zip"),
                    F.when(ok, S.city_of("line")).alias("city"))


@query("str_pad", "STR-14", sql="""
SELECT c_custkey, rpad(c_name, 25, ' ') AS name25, lpad(CAST(c_custkey AS VARCHAR), 8, ' ') AS key8
FROM customer""")
def str_pad(spark, sf):
    return _cust(spark, sf).select("c_custkey", S.pad_right("c_name", 25).alias("name25"),
                                   S.pad_left("c_custkey", 8).alias("key8"))


@query("str_template", "STR-15", sql="""
SELECT o_orderkey, printf('%04d-%02d-%02d', year(o_orderdate), month(o_orderdate), day(o_orderdate)) AS ymd
FROM orders""")
def str_template(spark, sf):
    d = F.col("o_orderdate")
    return _orders(spark, sf).select("o_orderkey", S.format_template(
        "%04d-%02d-%02d", F.year(d), F.month(d), F.dayofmonth(d)).alias("ymd"))


@query("str_digits", "STR-16", sql="""
SELECT o_orderkey, CASE WHEN regexp_matches(t, '^[0-9]+$') THEN TRY_CAST(t AS BIGINT) END AS num
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN 'A' || CAST(o_orderkey AS VARCHAR)
                              ELSE CAST(o_orderkey AS VARCHAR) END AS t FROM orders)""")
def str_digits(spark, sf):
    o = _orders(spark, sf)
    t = F.when(o.o_orderkey % 6 == 0, F.concat(F.lit("A"), o.o_orderkey.cast("string"))) \
        .otherwise(o.o_orderkey.cast("string"))
    return o.select("o_orderkey", S.digits_to_long(t).alias("num"))


@query("str_repeat_concat", "STR-17", sql="""
SELECT o_orderkey,
  lpad(CAST(COALESCE(h1, 0) AS VARCHAR), 3, '0') || lpad(CAST(COALESCE(h2, 0) AS VARCHAR), 3, '0') ||
  lpad(CAST(COALESCE(h3, 0) AS VARCHAR), 3, '0') || lpad(CAST(COALESCE(h4, 0) AS VARCHAR), 3, '0') AS HRCALL
FROM (SELECT o_orderkey, o_orderkey % 1000 AS h1, o_custkey % 1000 AS h2,
             CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 7 END AS h3,
             CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey % 17 END AS h4 FROM orders)""")
def str_repeat_concat(spark, sf):
    o = _orders(spark, sf)
    k, c = o.o_orderkey, o.o_custkey
    h = o.select("o_orderkey", (k % 1000).alias("h1"), (c % 1000).alias("h2"),
                 F.when(k % 4 != 0, k % 7).alias("h3"), F.when(k % 3 != 0, c % 17).alias("h4"))
    return h.select("o_orderkey", S.pad_concat(["h1", "h2", "h3", "h4"], 3).alias("HRCALL"))


# =============================================================== DAT
@query("dat_from_parts", "DAT-01", sql="""
SELECT o_orderkey, TRY_CAST(printf('%04d-%02d-%02d', year(o_orderdate), month(o_orderdate),
                                   o_orderkey % 35 + 1) AS DATE) AS d
FROM orders""")
def dat_from_parts(spark, sf):
    o = _orders(spark, sf)
    return o.select("o_orderkey", D.date_from_parts(F.year("o_orderdate"), F.month("o_orderdate"),
                                                    o.o_orderkey % 35 + 1).alias("d"))


@query("date_field_parse", "SRC-07 DAT-02", sql="""
SELECT o_orderkey, TRY_CAST(t AS DATE) AS d
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '2000-13-45'
                              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS t FROM orders)""")
def date_field_parse(spark, sf):
    o = _orders(spark, sf)
    t = F.when(o.o_orderkey % 7 == 0, F.lit("2000-13-45")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", D.parse_date(t).alias("d"))


@query("dat_parse", "DAT-02", sql="""
SELECT o_orderkey, CAST(try_strptime(t, '%Y%m%d') AS DATE) AS d
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'ABCDEFGH'
                              ELSE strftime(o_orderdate, '%Y%m%d') END AS t FROM orders)""")
def dat_parse(spark, sf):
    o = _orders(spark, sf)
    t = F.when(o.o_orderkey % 9 == 0, F.lit("ABCDEFGH")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return o.select("o_orderkey", D.parse_date(t, "yyyyMMdd").alias("d"))


@query("dat_parts", "DAT-03", sql="""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day FROM orders""")
def dat_parts(spark, sf):
    parts = D.date_parts(F.to_date("o_orderdate"))
    return _orders(spark, sf).select("o_orderkey", *[v.alias(k) for k, v in parts.items()])


@query("dat_formats", "DAT-04", sql="""
SELECT o_orderkey, COALESCE(strftime(d, '%Y-%m-%d'), '') AS f1, COALESCE(strftime(d, '%d%m%Y'), '') AS f2,
       COALESCE(strftime(d, '%Y%m%d'), '') AS f3, COALESCE(strftime(d, '%m%d%Y'), '') AS f4
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d FROM orders)""")
def dat_formats(spark, sf):
    o = _orders(spark, sf)
    d = F.when(o.o_orderkey % 9 != 0, F.to_date("o_orderdate"))
    o = o.select("o_orderkey", d.alias("d"))
    return o.select("o_orderkey", *[D.format_date("d", f).alias(f"f{i + 1}") for i, f in
                                    enumerate(["YYMMDD10", "DDMMYYN8", "YYMMDDN8", "MMDDYYN8"])])


@query("dat_run_ts", "DAT-05 SRC-14", sql="""
SELECT o_orderkey, (SELECT strftime(max(o_orderdate), '%Y%m%d') FROM orders) || '120000' AS RUNTS
FROM orders WHERE o_orderstatus = 'P'""")
def dat_run_ts(spark, sf):
    o = _orders(spark, sf)
    ctl = o.agg(F.max("o_orderdate").alias("d")).select(
        F.year("d").alias("YY"), F.month("d").alias("MM"), F.dayofmonth("d").alias("DD"))
    run_date = control_date(ctl)
    return o.filter(o.o_orderstatus == "P").select(
        "o_orderkey", D.run_timestamp_text(run_date, "12:00:00").alias("RUNTS"))


PACKED_DATE_SQL = ("CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE month(o_orderdate) * 1000000000 + "
                   "day(o_orderdate) * 10000000 + year(o_orderdate) * 1000 + o_orderkey % 1000 END")


def _packed_date():
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    return F.when(k % 10 == 0, F.lit(0).cast("long")).otherwise(
        F.month(d).cast("long") * 1000000000 + F.dayofmonth(d).cast("long") * 10000000
        + F.year(d).cast("long") * 1000 + k % 1000)


@query("dat_packed", "DAT-06", sql=f"""
SELECT o_orderkey, substr(z, 5, 4) || substr(z, 1, 2) || substr(z, 3, 2) AS ymd
FROM (SELECT o_orderkey, lpad(CAST({PACKED_DATE_SQL} AS VARCHAR), 11, '0') AS z FROM orders)""")
def dat_packed(spark, sf):
    return _orders(spark, sf).select("o_orderkey", D.packed_mmddyyyy_to_yyyymmdd(_packed_date()).alias("ymd"))


@query("dat_dummy", "DAT-07 STR-05", sql=f"""
SELECT o_orderkey, CASE WHEN z = '00002000000' THEN '20000101'
                        ELSE substr(z, 5, 4) || substr(z, 1, 2) || substr(z, 3, 2) END AS OPENDATE
FROM (SELECT o_orderkey, translate(lpad(raw, 11, ' '), ' ', '0') AS z
      FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '00002000000'
                                    WHEN o_orderkey % 7 = 0 THEN ''
                                    ELSE CAST({PACKED_DATE_SQL} AS VARCHAR) END AS raw FROM orders))""")
def dat_dummy(spark, sf):
    k = F.col("o_orderkey")
    raw = F.when(k % 5 == 0, F.lit("00002000000")).when(k % 7 == 0, F.lit("")) \
        .otherwise(_packed_date().cast("string"))
    return _orders(spark, sf).select("o_orderkey", D.open_date_text(raw).alias("OPENDATE"))


# =============================================================== NUL
SEG_GAPS_SQL = ("CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN NULL "
                "WHEN c_custkey % 13 = 0 THEN '   ' ELSE c_mktsegment END")


def _seg_gaps():
    k = F.col("c_custkey")
    return (F.when(k % 7 == 0, F.lit("")).when(k % 11 == 0, F.lit(None).cast("string"))
            .when(k % 13 == 0, F.lit("   ")).otherwise(F.col("c_mktsegment")))


@query("nul_default_text", "NUL-01", sql=f"""
SELECT c_custkey, CASE WHEN trim(COALESCE(s, '')) = '' THEN 'NIL' ELSE s END AS seg
FROM (SELECT c_custkey, {SEG_GAPS_SQL} AS s FROM customer)""")
def nul_default_text(spark, sf):
    c = _cust(spark, sf).select("c_custkey", _seg_gaps().alias("s"))
    return c.select("c_custkey", B.default_text("s").alias("seg"))


@query("nul_zero", "NUL-02", sql="""
SELECT c_custkey, CAST(COALESCE(b, 0) AS DECIMAL(18,2)) AS bal
FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS b
      FROM customer)""")
def nul_zero(spark, sf):
    c = _cust(spark, sf)
    b = F.when(c.c_custkey % 7 != 0, N.money("c_acctbal"))
    return c.select("c_custkey", B.zero_if_missing(b).cast(N.MONEY).alias("bal"))


@query("nul_frame", "NUL-03", sql=f"""
SELECT c_custkey, COALESCE(s, 'NIL') AS s, COALESCE(n, 'NIL') AS n, b
FROM (SELECT c_custkey, {SEG_GAPS_SQL} AS s,
             CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS n,
             CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS b FROM customer)""")
def nul_frame(spark, sf):
    c = _cust(spark, sf)
    df = c.select("c_custkey", _seg_gaps().alias("s"),
                  F.when(c.c_custkey % 5 != 0, c.c_name).alias("n"),
                  F.when(c.c_custkey % 3 != 0, c.c_nationkey).alias("b"))
    return B.fill_frame(df, "NIL")


@query("nul_blank", "NUL-04", sql=f"""
SELECT c_custkey, COALESCE(s, '') AS s FROM (SELECT c_custkey, {SEG_GAPS_SQL} AS s FROM customer)""")
def nul_blank(spark, sf):
    return B.blank_strings(_cust(spark, sf).select("c_custkey", _seg_gaps().alias("s")))


@query("nul_tests", "NUL-05", sql=f"""
SELECT c_custkey, s IS NULL AS is_missing, s IS NOT NULL AS is_present
FROM (SELECT c_custkey, {SEG_GAPS_SQL} AS s FROM customer)""")
def nul_tests(spark, sf):
    c = _cust(spark, sf).select("c_custkey", _seg_gaps().alias("s"))
    return c.select("c_custkey", B.missing("s").alias("is_missing"), B.present("s").alias("is_present"))


# =============================================================== MTH
@query("mth_cents", "MTH-01", sql="""
SELECT o_orderkey, CAST(cents / 100 AS DECIMAL(18,2)) AS units
FROM (SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents FROM orders)""")
def mth_cents(spark, sf):
    o = _orders(spark, sf)
    cents = (N.money("o_totalprice") * 100).cast("long")
    return o.select("o_orderkey", N.cents_to_units(cents).alias("units"))


BAL_SQL = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) - 200000 AS DECIMAL(18,2))"


def _bal():
    return (N.money("o_totalprice") - F.lit(200000)).cast(N.MONEY)


@query("mth_positive", "MTH-02", sql=f"""
SELECT o_orderkey, CAST(CASE WHEN b > 0 THEN b ELSE 0 END AS DECIMAL(18,2)) AS pos
FROM (SELECT o_orderkey, {BAL_SQL} AS b FROM orders)""")
def mth_positive(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", _bal().alias("b"))
    return o.select("o_orderkey", N.positive_or_zero("b").cast(N.MONEY).alias("pos"))


@query("mth_nonzero", "MTH-03", sql=f"""
SELECT o_orderkey, CAST(CASE WHEN b < 0 OR b > 0 THEN b ELSE 0 END AS DECIMAL(18,2)) AS nz
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 0
                              ELSE {BAL_SQL} END AS b FROM orders)""")
def mth_nonzero(spark, sf):
    o = _orders(spark, sf)
    b = F.when(o.o_orderkey % 7 == 0, F.lit(None)).when(o.o_orderkey % 5 == 0, F.lit(0)).otherwise(_bal())
    o = o.select("o_orderkey", b.cast(N.MONEY).alias("b"))
    return o.select("o_orderkey", N.nonzero_or_zero("b").cast(N.MONEY).alias("nz"))


APPL_SQL = (f"CASE WHEN substr({ACCT}, 1, 2) IN ('01', '07') THEN 'FD' WHEN substr({ACCT}, 1, 2) = '03' THEN 'CA' "
            f"WHEN substr({ACCT}, 1, 2) IN ('04', '05') THEN 'SA  ' ELSE 'LN' END")


def _appl():
    p = F.substring(roles.acct_no(), 1, 2)
    return (F.when(p.isin("01", "07"), F.lit("FD")).when(p == "03", F.lit("CA"))
            .when(p.isin("04", "05"), F.lit("SA  ")).otherwise(F.lit("LN")))


@query("mth_zero_outside", "MTH-04", sql=f"""
SELECT o_orderkey, appl, CAST(CASE WHEN rtrim(appl) IN ('FD', 'CA', 'SA') THEN b ELSE 0 END AS DECIMAL(18,2)) AS bal
FROM (SELECT o_orderkey, {APPL_SQL} AS appl, {BAL_SQL} AS b FROM orders)""")
def mth_zero_outside(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", _appl().alias("appl"), _bal().alias("b"))
    return o.select("o_orderkey", "appl",
                    N.zero_outside("b", "appl", ["FD", "CA", "SA"]).cast(N.MONEY).alias("bal"))


@query("mth_coerce", "MTH-05", sql="""
SELECT o_orderkey, TRY_CAST(trim(substr(lpad(CAST(o_custkey * 13 AS VARCHAR), 7, '0'), 5, 3)) AS BIGINT) AS costctr
FROM orders""")
def mth_coerce(spark, sf):
    o = _orders(spark, sf)
    x = F.lpad((o.o_custkey * 13).cast("string"), 7, "0")
    return o.select("o_orderkey", N.to_number(F.substring(x, 5, 3)).alias("costctr"))


# =============================================================== CND
@query("cnd_first", "CND-01", sql="""
SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'HIGH' WHEN o_totalprice > 100000 THEN 'MID'
                        WHEN o_totalprice > 0 THEN 'LOW' ELSE 'NONE' END AS band FROM orders""")
def cnd_first(spark, sf):
    p = F.col("o_totalprice")
    return _orders(spark, sf).select("o_orderkey", N.first_match(
        [(p > 300000, "HIGH"), (p > 100000, "MID"), (p > 0, "LOW")], "NONE").alias("band"))


@query("cnd_last_wins", "CND-02", sql="""
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'URGENT'
                        WHEN o_orderstatus = 'F' THEN 'FINAL'
                        WHEN o_totalprice > 100000 THEN 'BIG' ELSE '' END AS tag FROM orders""")
def cnd_last_wins(spark, sf):
    o = _orders(spark, sf)
    return o.select("o_orderkey", N.last_match([
        (o.o_totalprice > 100000, "BIG"), (o.o_orderstatus == "F", "FINAL"),
        (o.o_orderpriority == "1-URGENT", "URGENT")], "").alias("tag"))


def _line_n(n):
    # address line n (2..5) of an order: a zip line only for some keys
    k = F.col("o_orderkey")
    zl = F.concat(F.lpad(((k * n) % 100000).cast("string"), 5, "0"), F.lit(" TOWN"), F.lit(str(n)))
    return F.when((k + n) % 3 == 0, zl).otherwise(F.concat(F.lit("LOT "), k.cast("string")))


def _line_n_sql(n):
    return (f"CASE WHEN (o_orderkey + {n}) % 3 = 0 THEN lpad(CAST((o_orderkey * {n}) % 100000 AS VARCHAR), 5, '0') "
            f"|| ' TOWN' || '{n}' ELSE 'LOT ' || CAST(o_orderkey AS VARCHAR) END")


def _zip_ok_sql(c):
    return ZIP_OK_SQL.replace("line", c)


@query("cnd_first_column", "CND-03", sql=f"""
SELECT o_orderkey,
  CASE WHEN {_zip_ok_sql('l2')} THEN substr(l2, 1, 5) WHEN {_zip_ok_sql('l3')} THEN substr(l3, 1, 5)
       WHEN {_zip_ok_sql('l4')} THEN substr(l4, 1, 5) WHEN {_zip_ok_sql('l5')} THEN substr(l5, 1, 5) END AS zip,
  CASE WHEN {_zip_ok_sql('l2')} THEN substr(l2, 7, 25) WHEN {_zip_ok_sql('l3')} THEN substr(l3, 7, 25)
       WHEN {_zip_ok_sql('l4')} THEN substr(l4, 7, 25) WHEN {_zip_ok_sql('l5')} THEN substr(l5, 7, 25) END AS city
FROM (SELECT o_orderkey, {_line_n_sql(2)} AS l2, {_line_n_sql(3)} AS l3, {_line_n_sql(4)} AS l4,
             {_line_n_sql(5)} AS l5 FROM orders)""")
def cnd_first_column(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", *[_line_n(n).alias(f"l{n}") for n in (2, 3, 4, 5)])
    pick = N.first_matching_source([
        (S.zip_line_ok(f"l{n}"), F.struct(S.zip_of(f"l{n}").alias("zip"), S.city_of(f"l{n}").alias("city")))
        for n in (2, 3, 4, 5)])
    return o.select("o_orderkey", pick.alias("m")).select("o_orderkey", "m.zip", "m.city")


@query("cnd_copy", "CND-04", sql="""
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'O' ELSE 'I' END AS INDORG,
       CASE WHEN c_custkey % 2 = 0 THEN c_name END AS BUSREG FROM customer""")
def cnd_copy(spark, sf):
    c = _cust(spark, sf)
    c = c.select("c_custkey", F.when(c.c_custkey % 2 == 0, F.lit("O")).otherwise(F.lit("I")).alias("INDORG"),
                 "c_name")
    return c.select("c_custkey", "INDORG", N.copy_when(F.col("INDORG") == "O", "c_name").alias("BUSREG"))


@query("cnd_any_of", "CND-05", sql="""
SELECT o_orderkey, (o_orderstatus = 'P' OR o_totalprice > 400000 OR contains(o_orderpriority, 'URGENT')) AS flag
FROM orders""")
def cnd_any_of(spark, sf):
    o = _orders(spark, sf)
    return o.select("o_orderkey", N.any_of([o.o_orderstatus == "P", o.o_totalprice > 400000,
                                            S.contains_text("o_orderpriority", "URGENT")]).alias("flag"))


@query("cnd_struct_split", "CND-06 CLS-08", sql="""
SELECT o_orderkey,
  CASE WHEN n AND o THEN 'Y' WHEN n THEN 'Y' WHEN o THEN 'Y' ELSE 'N' END AS hold_ind,
  CASE WHEN n AND o THEN 'B' WHEN n THEN 'N' WHEN o THEN 'O' ELSE 'X' END AS match_id
FROM (SELECT o_orderkey, o_orderkey % 2 = 0 AS n, o_orderkey % 3 = 0 AS o FROM orders)""")
def cnd_struct_split(spark, sf):
    o = _orders(spark, sf)
    n, old = (o.o_orderkey % 2 == 0), (o.o_orderkey % 3 == 0)
    s = N.two_outputs([(n & old, ("Y", "B")), (n, ("Y", "N")), (old, ("Y", "O"))], ("N", "X"),
                      ("hold_ind", "match_id"))
    return o.select("o_orderkey", s.alias("s")).select("o_orderkey", "s.hold_ind", "s.match_id")


# =============================================================== CLS
@query("cls_prefix", "CLS-01", sql=f"""
SELECT o_orderkey, CASE WHEN substr({ACCT}, 1, 2) IN ('02', '08') THEN 'LN'
                        WHEN substr({ACCT}, 1, 2) IN ('01', '03', '04', '05', '06', '07') THEN 'DP'
                        ELSE '' END AS ACCTCODE FROM orders""")
def cls_prefix(spark, sf):
    return _orders(spark, sf).select("o_orderkey", R.account_prefix_code(roles.acct_no()).alias("ACCTCODE"))


def _range_case_sql(col, ranges, default="''"):
    parts = " ".join(f"WHEN {col} > '{lo}' AND {col} < '{hi}' THEN '{code}'"
                     for lo, hi, code in reversed(ranges))
    return f"CASE {parts} ELSE {default} END"


PROD_SQL = "lpad(CAST(o_custkey % 500 AS VARCHAR), 3, '0')"


def _fcy_sql(inner):
    fd = ", ".join(f"'{p}'" for p in R.FCY_FD_PRODUCTS)
    ca = ", ".join(f"'{p}'" for p in R.FCY_CA_PRODUCTS)
    return f"CASE WHEN {PROD_SQL} IN ({ca}) THEN 'FCYCA' WHEN {PROD_SQL} IN ({fd}) THEN 'FCYFD' ELSE {inner} END"


@query("cls_account_range", "CLS-02", sql=f"""
SELECT o_orderkey, {_range_case_sql('a', spec.DEPOSITS)} AS DP_APPL,
       {_range_case_sql('a', spec.LOANS)} AS LN_APPL
FROM (SELECT o_orderkey, {ACCT} AS a FROM orders)""")
def cls_account_range(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", roles.acct_no().alias("a"))
    return o.select("o_orderkey", R.deposit_appl_code("a").alias("DP_APPL"),
                    R.loan_appl_code("a").alias("LN_APPL"))


@query("cls_product_set", "CLS-03", sql=f"""
SELECT o_orderkey, {PROD_SQL} AS PRODTY, {_fcy_sql(_range_case_sql('a', spec.DEPOSITS))} AS APPL_CODE
FROM (SELECT o_orderkey, o_custkey, {ACCT} AS a FROM orders)""")
def cls_product_set(spark, sf):
    o = _orders(spark, sf)
    o = o.select("o_orderkey", roles.acct_no().alias("a"),
                 F.lpad((o.o_custkey % 500).cast("string"), 3, "0").alias("PRODTY"))
    return o.select("o_orderkey", "PRODTY", R.deposit_appl_code("a", "PRODTY").alias("APPL_CODE"))


ZIP_SQL = ("CASE WHEN o_orderkey % 17 = 0 THEN '1ABCD' WHEN o_orderkey % 19 = 0 THEN '69000' "
           "WHEN o_orderkey % 23 = 0 THEN '68199' WHEN o_orderkey % 29 = 0 THEN '68200' "
           "ELSE lpad(CAST((o_orderkey * 7) % 100000 AS VARCHAR), 5, '0') END")


def _zip():
    k = F.col("o_orderkey")
    return (F.when(k % 17 == 0, F.lit("1ABCD")).when(k % 19 == 0, F.lit("69000"))
            .when(k % 23 == 0, F.lit("68199")).when(k % 29 == 0, F.lit("68200"))
            .otherwise(F.lpad(((k * 7) % 100000).cast("string"), 5, "0")))


def _zip_state_sql(z):
    parts = " ".join(f"WHEN TRY_CAST(trim({z}) AS INTEGER) BETWEEN {lo} AND {hi} THEN '{st}'"
                     for lo, hi, st in reversed(spec.ZIP_STATES))
    return f"CASE {parts} ELSE '' END"


@query("cls_zip_state", "CLS-04", sql=f"""
SELECT o_orderkey, z AS zip, {_zip_state_sql('z')} AS STATEX FROM (SELECT o_orderkey, {ZIP_SQL} AS z FROM orders)""")
def cls_zip_state(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", _zip().alias("zip"))
    return o.select("o_orderkey", "zip", R.zip_state("zip").alias("STATEX"))


OPENIND_SQL = ("CASE WHEN o_orderkey % 13 = 0 THEN 'Q' WHEN o_orderkey % 10 = 0 THEN 'C' "
               "WHEN o_orderstatus = 'F' THEN '' WHEN o_orderstatus = 'O' THEN 'B' ELSE 'Z' END")


def _openind():
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    return (F.when(k % 13 == 0, F.lit("Q")).when(k % 10 == 0, F.lit("C")).when(s == "F", F.lit(""))
            .when(s == "O", F.lit("B")).otherwise(F.lit("Z")))


@query("cls_open_ind", "CLS-05", sql=f"""
SELECT o_orderkey, CASE WHEN i = '' THEN 'ACTIVE' WHEN i IN ('B', 'C', 'P') THEN 'CLOSED'
                        WHEN i = 'Z' THEN 'ZERO BALANCE' ELSE '' END AS ACCTSTATUS
FROM (SELECT o_orderkey, {OPENIND_SQL} AS i FROM orders)""")
def cls_open_ind(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", _openind().alias("i"))
    return o.select("o_orderkey", R.open_indicator_status("i").alias("ACCTSTATUS"))


LOAN_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 4 = 0 THEN '3' ELSE '0' END AS npl,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey % 120 END AS arrear,
       CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN 'P' ELSE '' END AS paid,
       CAST(o_totalprice AS DECIMAL(18,2)) - 150000 AS bal
FROM orders"""


@query("cls_loan_status", "CLS-06", sql=f"""
SELECT o_orderkey, CASE WHEN paid = 'P' THEN 'PAID-OFF' WHEN arrear > 1 AND arrear < 92 THEN 'ACCOUNT IN ARREARS'
                        WHEN npl = '3' OR arrear > 92 THEN 'NPL' WHEN bal > 0 THEN 'ACTIVE' ELSE '' END AS ACCTSTATUS
FROM ({LOAN_SQL}) l""")
def cls_loan_status(spark, sf):
    o = _orders(spark, sf)
    k = o.o_orderkey
    l_ = o.select("o_orderkey", F.when(k % 4 == 0, F.lit("3")).otherwise(F.lit("0")).alias("npl"),
                  F.when(k % 5 != 0, o.o_custkey % 120).alias("arrear"),
                  F.when((o.o_orderstatus == "F") & (k % 3 == 0), F.lit("P")).otherwise(F.lit("")).alias("paid"),
                  (N.money("o_totalprice") - 150000).alias("bal"))
    return l_.select("o_orderkey", R.loan_status("npl", "arrear", "paid", "bal").alias("ACCTSTATUS"))


@query("cls_cost_centre", "CLS-07", sql="""
SELECT o_orderkey, CASE WHEN c > 3000 AND c < 3999 THEN 'I' ELSE 'C' END AS DP_BANKINDC,
       CASE WHEN c BETWEEN 3000 AND 3999 THEN 'I' ELSE 'C' END AS LN_BANKINDC
FROM (SELECT o_orderkey, o_orderkey % 5000 AS c FROM orders)""")
def cls_cost_centre(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", (F.col("o_orderkey") % 5000).alias("c"))
    return o.select("o_orderkey", R.bank_indicator("c", closed=False).alias("DP_BANKINDC"),
                    R.bank_indicator("c", closed=True).alias("LN_BANKINDC"))


@query("cls_match_id", "CLS-08", sql="""
SELECT o_orderkey,
  CASE WHEN n OR o THEN 'Y' ELSE 'N' END AS hold_ind,
  CASE WHEN n AND o THEN 'B' WHEN n THEN 'N' WHEN o THEN 'O' ELSE 'X' END AS match_id
FROM (SELECT o_orderkey, o_custkey % 2 = 0 AS n, o_orderkey % 5 = 0 AS o FROM orders)""")
def cls_match_id(spark, sf):
    o = _orders(spark, sf)
    m = R.match_id(o.o_custkey % 2 == 0, o.o_orderkey % 5 == 0)
    return o.select("o_orderkey", m.alias("m")).select("o_orderkey", "m.hold_ind", "m.match_id")


@query("cls_loan_code", "CLS-09", sql="""
SELECT o_orderkey, CASE WHEN c = 'A' THEN 'ACTIVE' WHEN c = 'P' THEN 'PAID_OFF' WHEN c = 'N' THEN 'NPL'
                        ELSE 'UNKNOWN' END AS loan_status
FROM (SELECT o_orderkey, substr('APNX', CAST(o_orderkey % 4 AS INTEGER) + 1, 1) AS c FROM orders)""")
def cls_loan_code(spark, sf):
    o = _orders(spark, sf)
    c = F.substring(F.lit("APNX"), (o.o_orderkey % 4 + 1).cast("int"), F.lit(1))
    return o.select("o_orderkey", R.loan_code_text(c).alias("loan_status"))


# =============================================================== UDF surface
def _with_zip(df):
    ok = S.zip_line_ok("line")
    return df.withColumn("zip", F.when(ok, S.zip_of("line")))


def _with_state(df):
    return df.withColumn("STATEX", F.coalesce(R.zip_state("zip"), F.lit("")))


@query("fn_transform", "UDF-03", sql=f"""
SELECT o_orderkey, zip, {_zip_state_sql('zip')} AS STATEX
FROM (SELECT o_orderkey, CASE WHEN {ZIP_OK_SQL} THEN substr(line, 1, 5) END AS zip
      FROM (SELECT o_orderkey, {_zip_line_sql()} AS line FROM orders))""")
def fn_transform(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", _zip_line().alias("line"))
    return o.transform(_with_zip).transform(_with_state).select("o_orderkey", "zip", "STATEX")


@query("fn_native", "UDF-01 UDF-02 UDF-04", sql=f"""
SELECT o_orderkey, {_zip_state_sql('z')} AS STATEX,
  CASE WHEN v < 0 THEN '-' || lpad(CAST(abs(v) AS VARCHAR), 2, '0') ELSE lpad(CAST(v AS VARCHAR), 3, '0') END AS Z3
FROM (SELECT o_orderkey, {ZIP_SQL} AS z, o_orderkey % 200 - 50 AS v FROM orders)""")
def fn_native(spark, sf):
    o = _orders(spark, sf)
    return o.select("o_orderkey", R.zip_state(_zip()).alias("STATEX"),
                    S.zero_pad(o.o_orderkey % 200 - 50, 3).alias("Z3"))

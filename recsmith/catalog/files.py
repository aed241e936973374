"""Jobs from file to file: each query writes record files from the test tables in a known record
order, runs a job on them and reads its published output back. The twins number the same
records by that order: "first" and positions are those of the files, and lines have numbers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from recsmith.catalog import jobs as J
from recsmith.catalog import roles, spec
from recsmith.catalog.registry import query, table
from recsmith.catalog.sqlgen import first_sql, positional_merge_sql, render_sql, zero_pad_sql
from recsmith.functions.numbers import MONEY
from recsmith.operators.dedup import first_per_key
from recsmith.operators.joins import merge_files
from recsmith.plans import files as FJ
from recsmith.plans import names as NM
from recsmith.plans import owners as OW
from recsmith.plans import parties as PT
from recsmith.plans import relationships as RL
from recsmith.plans import report as RP
from recsmith.session import materialize, scratch_path
from recsmith.sinks import writers as W
from recsmith.sinks.generations import Generations
from recsmith.sources import readers as RD
from recsmith.sources.layout import Layout, binary_record

# Files of an input, at least; and bytes of records that one task sorts and writes.
FILES = 4
FILE_BYTES = 64 << 20


def _fresh(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def put(df, layout, order, name="in", is_binary=False):
    """A folder of record files that hold ``df`` in ``order`` (SQL expressions). Files are compressed, as
    records are mostly blanks; each is read by one task."""
    path = _fresh(df.sparkSession, name)
    width = layout.lrecl or max(f.end for f in layout.fields)
    files = max(FILES, -(-df.count() * width // FILE_BYTES))
    rows = df.repartitionByRange(files, *[F.expr(o[:-5]).desc() if o.endswith(" DESC") else F.expr(o) for o in order])
    rows = rows.sortWithinPartitions(*[F.expr(o[:-5]).desc() if o.endswith(" DESC") else F.expr(o) for o in order])
    if is_binary:
        W.write_records(rows.select(binary_record(layout).alias("value")), path, compressed=True)
    else:
        W.write_lines(W.fixed_lines(rows, layout), path, compression="gzip")
    return path


def published(spark, name, keep=None):
    return Generations(spark, _fresh(spark, name), keep, compression="gzip")


def outputs(gen, names):
    """Lines of several outputs with their numbers."""
    frames = [gen.lines(n).select(F.lit(n).alias("output"), "line_no", "value") for n in names]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def numbered_sql(src, order, output=None):
    """Lines of ``src`` numbered in ``order``."""
    head = f"'{output}' AS output, " if output else ""
    return f"SELECT {head}row_number() OVER (ORDER BY {order}) AS line_no, value FROM ({src}) _l"


# ------------------------------------------------------------ record order
LINE_LAYOUT = Layout.of([("l_orderkey", 1, 11, "z"), ("l_linenumber", 12, 3, "z"), ("l_partkey", 15, 11, "z"), ("l_suppkey", 26, 9, "z")])
LINE_ORDER = ["l_suppkey", "l_partkey", "l_orderkey", "l_linenumber"]
_FIRST_SQL = f"""
SELECT l_orderkey, l_linenumber, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber <= 2, {', '.join(LINE_ORDER)}) AS rn FROM lineitem)
WHERE rn = 1"""


@query("first_in_file", "DED-01 SRC-04 SRC-12", sql=_FIRST_SQL)
def first_in_file(spark, sf):
    """Two concatenated inputs of several files each; the first record of each order."""
    li = table(spark, sf, "lineitem")
    paths = [put(li.where("l_linenumber > 2"), LINE_LAYOUT, LINE_ORDER), put(li.where("l_linenumber <= 2"), LINE_LAYOUT, LINE_ORDER)]
    rows = RD.read_fixed_text(spark, paths, LINE_LAYOUT, sequence=RD.SEQ)
    return first_per_key(rows, "l_orderkey", [RD.SEQ]).select("l_orderkey", F.col("l_linenumber").cast("int"), "l_partkey")


@query("first_in_delimited", "DED-01 SRC-09", sql="""
SELECT CAST(o_custkey AS VARCHAR) AS CUSTNO, CAST(max(o_orderkey) AS VARCHAR) AS ACCT FROM orders GROUP BY o_custkey""")
def first_in_delimited(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("CUSTNO"), F.col("o_orderkey").alias("k"))
    path = _fresh(spark, "csv")
    rows = o.repartitionByRange(FILES, F.desc("k")).sortWithinPartitions(F.desc("k"))
    W.write_csv(rows.select("CUSTNO", F.col("k").cast("string").alias("ACCT")), path, sep=";", header=False, quote_all=True)
    return first_per_key(RD.read_delimited(spark, path, ["CUSTNO", "ACCT"], sequence=RD.SEQ), "CUSTNO", [RD.SEQ]).drop(RD.SEQ)


@query("record_numbers", "SRC-04 WIN-01 SRT-02", sql=f"""
SELECT row_number() OVER (ORDER BY {', '.join(LINE_ORDER)}) AS line_no, l_orderkey, l_linenumber FROM lineitem""")
def record_numbers(spark, sf):
    path = put(table(spark, sf, "lineitem"), LINE_LAYOUT, LINE_ORDER)
    rows = RD.record_numbers(RD.read_fixed_text(spark, path, LINE_LAYOUT, sequence=RD.SEQ))
    return rows.select("line_no", "l_orderkey", F.col("l_linenumber").cast("int"))


# -------------------------------------------- binary, multi-format deposits
# Every ninth account has a second record with another product; which of the two stands
# first in the file changes from account to account. Other record types stand between.
_DEP_SQL = f"""
SELECT d.* REPLACE (d.PRODTYPE + dup AS PRODTYPE), k * 2 + (k + dup) % 2 AS ORD FROM (
  SELECT x.*, x.ACCTNO % 1000000000 AS k FROM ({J.DP_SQL}) x) d, (SELECT unnest([0, 1]) AS dup)
WHERE (dup = 0 OR k % 9 = 0) AND k % 7 <> 0 AND k % 7 <> 6"""
_DEP_CLASSED_SQL = f"""
SELECT {zero_pad_sql('ACCTNO', 11)} AS ACCTNOC, {zero_pad_sql('PRODTYPE', 3)} AS PRODTY, {zero_pad_sql('ACCTBRCH1', 3)} AS ACCTBRCH,
  {J._DP_APPL_SQL} AS APPL_CODE, CASE WHEN COSTCTR > 3000 AND COSTCTR < 3999 THEN 'I' ELSE 'C' END AS BANKINDC,
  CASE WHEN COALESCE(rtrim(OPENIND), '') = '' THEN 'ACTIVE' WHEN rtrim(OPENIND) IN ('B', 'C', 'P') THEN 'CLOSED'
       WHEN rtrim(OPENIND) = 'Z' THEN 'ZERO BALANCE' ELSE '' END AS ACCTSTATUS,
  {J._packed_sql('OPENDATE')} AS DATEOPEN, {J._packed_sql('CLSEDATE')} AS DATECLSE,
  CAST(LEDGERBAL1 / 100 AS DECIMAL(18,2)) AS LEDGERBAL, CURBAL, ORD
FROM ({_DEP_SQL}) d WHERE trim(COALESCE(PURPOSECD, '')) <> ''"""
_DEP_COLS = ["ACCTNOC", "PRODTY", "ACCTBRCH", "APPL_CODE", "BANKINDC", "ACCTSTATUS", "DATEOPEN", "DATECLSE", "LEDGERBAL", "CURBAL"]
_DEP_FIRST_SQL = first_sql(_DEP_CLASSED_SQL, ["ACCTNOC"], ["ORD"], _DEP_COLS)


def put_deposits(spark, sf):
    k = F.col("ACCTNO") % 1000000000
    dp = J.deposit_inputs(spark, sf).withColumn("k", k)
    dp = dp.withColumn("dup", F.explode(F.when(F.col("k") % 9 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    kind = F.col("k") % 7
    dp = dp.withColumns({
        "PRODTYPE": F.col("PRODTYPE") + F.col("dup"), "BANKNO": F.lit(33),
        "REPTNO": F.when(kind == 0, F.lit(1002)).otherwise(F.lit(1001)),
        "FMTCODE": F.when(kind == 6, F.lit(5)).when(kind == 1, F.lit(1)).when(kind == 2, F.lit(10)).otherwise(F.lit(22)),
        "ODLIMIT": F.lit(0), **{c: F.lit("") for c in ("ACCTNAME", "DECEASED1", "DECEASED2", "DECEASED3", "BALHOLD", "CURRCODE", "POSTIND")}})
    return put(dp, RP.DEPOSIT_LAYOUT, ["k * 2 + (k + dup) % 2"], "deposits", is_binary=True)


@query("deposit_file", "SRC-06 SRC-11 FLT-11 DED-01 PIPE-11", sql=_DEP_FIRST_SQL)
def deposit_file(spark, sf):
    return FJ.deposits(spark, put_deposits(spark, sf)).select(*_DEP_COLS)


def _slots_sql(files, key):
    """Files merged by position: (sql, order, columns) each; keys of the first file."""
    count = " UNION ALL ".join(f"SELECT {key}, {i} AS side, count(*) AS n FROM ({s}) _x GROUP BY {key}" for i, (s, _, _) in enumerate(files))
    ns = ", ".join(f"COALESCE(max(n) FILTER (WHERE side = {i}), 0) AS n{i}" for i in range(len(files)))
    cols = ", ".join(f"f{i}.{c} AS {c}" for i, (_, _, cs) in enumerate(files) for c in cs)
    joins = " ".join(f"LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {o}) AS _p FROM ({s}) _y) f{i} "
                     f"ON f{i}.{key} = g.{key} AND f{i}._p = least(g.slot, g.n{i})" for i, (s, o, _) in enumerate(files))
    return f"""SELECT g.{key}, {cols} FROM (
  SELECT *, unnest(range(1, m + 1)) AS slot FROM (SELECT {key}, max(n) AS m, {ns} FROM ({count}) _c GROUP BY {key}) WHERE n0 > 0) g {joins}"""


_STMT_KEYED = f"SELECT {zero_pad_sql('ACCTNO', 11)} AS ACCTNOC, * EXCLUDE (ACCTNO) FROM ({J.STMT_SQL}) _s"
_HOLD_KEYED = f"SELECT {zero_pad_sql('ACCTNO', 11)} AS ACCTNOC, * EXCLUDE (ACCTNO) FROM ({J.HOLD_SQL}) _h"
# The post file holds three records of some accounts.
_POST_KEYED = f"SELECT p.*, n, p.ACCT_PST_REASON || n AS REASON FROM ({J.POST_SQL}) p, (SELECT unnest([0, 1, 2]) AS n) WHERE n = 0 OR right(ACCTNOC, 1) = '4'"


@query("deposit_detail_files", "JON-10 JON-14 SRC-06 SRC-04 PIPE-11", sql=_slots_sql([
    (_DEP_FIRST_SQL, "ACCTNOC", _DEP_COLS[1:]), (_STMT_KEYED, "CURR_CYC_DR DESC", J._CYC + J._CYC_AMT),
    (f"SELECT * REPLACE (REASON AS ACCT_PST_REASON) FROM ({_POST_KEYED}) _p", "n DESC", ["ACCT_PST_IND", "ACCT_PST_REASON"]),
    (_HOLD_KEYED, "TOT_HOLD", J._HOLD_COLS)], "ACCTNOC"))
def deposit_detail_files(spark, sf):
    """Four files merged by position in the order their records stand in."""
    stmt, post, holds = J._report_details(spark, sf)
    stmt = put(stmt.withColumn("ACCTNAME", F.lit("")), RP.STATEMENT_LAYOUT, ["ACCTNO", "CURR_CYC_DR DESC"], "stmt", is_binary=True)
    many = F.explode(F.when(F.col("ACCTNOC").endswith("4"), F.array(*map(F.lit, (0, 1, 2)))).otherwise(F.array(F.lit(0))))
    post = post.withColumn("n", many).withColumn("ACCT_PST_REASON", F.concat("ACCT_PST_REASON", F.col("n").cast("string")))
    post = put(post, RP.POST_LAYOUT, ["n DESC", "ACCTNOC"], "post")
    holds = put(holds, RP.HOLD_LAYOUT, ["ACCTNO"], "holds")
    out = FJ.deposit_details(spark, put_deposits(spark, sf), stmt, post, holds)
    amounts = {*J._CYC_AMT, "AMT_1", "AMT_2", "AMT_3"}
    return out.select(*_DEP_COLS, *[F.col(c).cast(MONEY).alias(c) if c in amounts else c for c in (
        *J._CYC, *J._CYC_AMT, "ACCT_PST_IND", "ACCT_PST_REASON", *J._HOLD_COLS)])


def _edge_sql(flag, i):
    return f"SELECT l_suppkey AS K, l_orderkey AS A{i}, l_linenumber AS B{i} FROM lineitem WHERE l_returnflag = '{flag}'"


@query("merge_files_hot", "JON-10 JON-14", sql=_slots_sql([
    (_edge_sql("N", 1), "A1, B1", ["A1", "B1"]), (_edge_sql("R", 2), "A2 DESC, B2", ["A2", "B2"]),
    (_edge_sql("A", 3), "B3, A3", ["A3", "B3"])], "K"))
def merge_files_hot(spark, sf):
    """Three files merged by position, keys of many rows split over tasks."""
    li = table(spark, sf, "lineitem")
    side = lambda f, i: li.where(F.col("l_returnflag") == f).select(
        F.col("l_suppkey").alias("K"), F.col("l_orderkey").alias(f"A{i}"), F.col("l_linenumber").alias(f"B{i}"),
        (-F.col("l_orderkey")).alias(f"D{i}"))
    merged = merge_files([side("N", 1), side("R", 2), side("A", 3)], "K", [["A1", "B1"], ["D2", "B2"], ["B3", "A3"]], skew_safe=True)
    return merged.select("K", *[f"{c}{i}" for i in (1, 2, 3) for c in "AB"])


# ---------------------------------------------------------- jobs, file to file
_OWNER_LINE = render_sql([("ACCTCODE", 1, 5), ("ACCTNOC", 6, 20), ("RLENCODE", 26, 3), ("CUSTNO", 29, 11), ("CODE1", 40, 3),
                          ("CUSTNO2", 43, 11), ("CODE2", 54, 3)], 150)


@query("owners_files", "PIPE-06 SRC-04 SRC-12 SRT-02 SNK-04 SNK-09 SRC-13", sql=numbered_sql(
    f"SELECT *, {_OWNER_LINE} AS value FROM ({J.OWNERS_SQL}) _o", "ACCTNOC, CUSTNO, CUSTNO2, value"))
def owners_files(spark, sf):
    acct = roles.account_rel(spark, sf).withColumn("ACCTNOR", F.substring("ACCTNOC", 1, 2))
    layout = Layout([f for f in OW.ACCOUNT_REL_LAYOUT.fields if f.name != "ACCTNOR"])
    odd = F.col("ACCTNOC").try_cast("long") % 2 == 1
    accounts = [put(acct.where(odd), layout, ["CUSTNO", "ACCTNOC"]), put(acct.where(~odd), layout, ["ACCTNOC DESC"])]
    # Stored first: its distinct edges are counted, sampled and written.
    relations = put(materialize(roles.cust_rel(spark, sf), "relations"), OW.CUST_REL_LAYOUT, ["CUST2", "CUST1", "CODE1", "CODE2"])
    gen = published(spark, "owners")
    FJ.owners_job(spark, accounts, relations, gen)
    return gen.lines("owners")


# Which of a customer's two names stands first changes from customer to customer.
_NAME_ORD = "CAST(CUSTNO AS BIGINT) * 2 + CASE WHEN (CUSTTYPE = 'X') = (CAST(CUSTNO AS BIGINT) % 2 = 1) THEN 0 ELSE 1 END"
_N_SQL = first_sql(f"SELECT *, {_NAME_ORD} AS ORD FROM ({J.NAMES_SQL}) _n", ["CUSTNO"], ["ORD"], J._NAME_COLS)
_R_SQL = first_sql(J.REMARKS_SQL, ["CUSTNO"], ["EFFDATE DESC"], ["CUSTNO", "LONGNAME"])


@query("names_files", "PIPE-05 DED-01 SRC-04 SRC-08 SRT-02 SNK-04", sql=numbered_sql(
    f"SELECT n.CUSTNO, {J._NAME_LINE} AS value FROM ({_N_SQL}) n LEFT JOIN ({_R_SQL}) r ON n.CUSTNO = r.CUSTNO", "CUSTNO"))
def names_files(spark, sf):
    read = NM.NAME_IN_LAYOUT.fields
    # The name stands in the record twice; the file's first copy is never used.
    layout = Layout([f for i, f in enumerate(read) if f.name != "CUSTNAME" or i > 1])
    name_file = put(J._names(spark, sf), layout, [_NAME_ORD], "names")
    remarks = J._remarks(spark, sf).withColumns({c: F.lit("") for c in (
        "BANKNO", "APPLCODE", "RMKKEYWORD", "RMKOPERATOR", "EXPIREDATE", "LASTMNTDATE")})
    gen = published(spark, "names")
    FJ.names_job(spark, name_file, put(remarks, NM.REMARK_LAYOUT, ["EFFDATE DESC"], "remarks"), gen)
    return gen.lines("names")


_AL = ", ".join(f"ADD_NAME_{i}" for i in range(1, 9))
_TY = [f"NA_LINE_TYP{i}" for i in range(1, 9)]
_OWN_FIRST = first_sql(f"SELECT * FROM ({J.OWN_SQL}) _o WHERE rtrim(O_APPL_CODE) = 'DP' AND ACCTNO > '010000000000'", ["ACCTNO"],
                       ["NA_LINE_TYP1 DESC"], ["ACCTNO", "rtrim(O_APPL_CODE) AS O_APPL_CODE", *_TY])


@query("deposit_address_files", "PIPE-07 DED-01 SRC-06 SRC-04 SRT-02 SNK-04", sql=numbered_sql(f"""
SELECT ACCTNO, {J._DP_LINE} AS value FROM (
  SELECT a.*, {', '.join('o.' + t for t in _TY)}, o.O_APPL_CODE FROM ({J.ADDR_SQL}) a JOIN ({_OWN_FIRST}) o ON a.ACCTNO = o.ACCTNO
  WHERE a.ACCTNO > '010000000000')""", "ACCTNO"))
def deposit_address_files(spark, sf):
    own = J._ownership(spark, sf).withColumns({
        **{c: F.lit(33) for c in ("HOLD_CO_NO", "BANK_NO", "REF_NO", "EFF_DATE", "O_HOLD_CO_NO", "O_BANK_NO", "O_REC_TYPE")},
        **{c: F.lit("") for c in ("PROCESS_TIME", "HIST_IND", "NA_SAME", "NA_FUTUR_IND")}})
    own = put(own, NM.OWNERSHIP_LAYOUT, ["NA_LINE_TYP1 DESC", "ACCTNO"], "own", is_binary=True)
    gen = published(spark, "addresses")
    FJ.deposit_addresses_job(spark, own, put(J._addresses(spark, sf), NM.ADDRESS_LAYOUT, ["ACCTNO DESC"], "addr"), gen)
    return gen.lines("addresses")


# Relationships stand in the file by falling account, aliases too.
_REL_K = J.REL_SQL.replace("SELECT ", "SELECT o_orderkey AS K, ", 1)
_ALIAS_K = J.RALIAS_SQL.replace("SELECT ", "SELECT o_orderkey AS AK, ", 1)


def _both_files_sql():
    side = lambda n: f"SELECT CUSTNO AS CUSTNO{n}, ALIAS AS ALIAS{n}, AK FROM ({_ALIAS_K}) _a"
    rel = (f"SELECT CUSTNO AS CUSTNO1, CUST2 AS CUSTNO2, CODE1, CODE2, EFFDATE, K FROM ({_REL_K}) _r "
           f"WHERE trim(COALESCE(EXPDATE1, '')) = ''")
    one = positional_merge_sql(rel, side(1), "CUSTNO1", ["CODE1", "K DESC"], ["AK DESC"], ["CUSTNO2", "CODE1", "CODE2", "EFFDATE", "K"],
                               ["ALIAS1"], slot=True)
    two = positional_merge_sql(f"SELECT *, slot AS S1 FROM ({one}) _1", side(2), "CUSTNO2", ["CODE2", "CUSTNO1", "CODE1", "K DESC", "S1"],
                               ["AK DESC"], ["CUSTNO1", "CODE1", "CODE2", "EFFDATE", "ALIAS1"], ["ALIAS2"])
    t = lambda c, a: f"COALESCE({c}, '') AS {a}"
    looked = " ".join(f"LEFT JOIN ({J.CODES_SQL}) c{n} ON m.CODE{n} = c{n}.CODE LEFT JOIN ({J.RNAMES_SQL}) n{n} ON m.CUSTNO{n} = n{n}.CUSTNO "
                      f"LEFT JOIN ({J.RCUST_SQL}) u{n} ON m.CUSTNO{n} = u{n}.CUSTNO" for n in (1, 2))
    cols = ", ".join(f"m.CUSTNO{n}, {t(f'n{n}.INDORG', f'INDORG{n}')}, {zero_pad_sql(f'm.CODE{n}', 3)} AS CODE{n}, "
                     f"{t(f'substr(c{n}.CDESC, 1, 15)', f'DESC{n}')}, {t(f'n{n}.CUSTNAME', f'CUSTNAME{n}')}, {t(f'm.ALIAS{n}', f'ALIAS{n}')}, "
                     f"{t(f'u{n}.OLDIC', f'OLDIC{n}')}, {t(f'u{n}.BASICGRPCODE', f'BASICGRPCODE{n}')}" for n in (1, 2))
    return f"SELECT {cols}, CAST(NULL AS DATE) AS EXPDATE, {zero_pad_sql('m.EFFDATE', 8)} AS EFFDATE FROM ({two}) m {looked}"


_BOTH_FILES = _both_files_sql()
_RECS_FILES = f"""
SELECT 1 AS _src, {J._record_sql('b')} AS value FROM ({_BOTH_FILES}) b
UNION ALL SELECT 2 AS _src, {J._record_sql('f')} AS value FROM ({J._flip_sql(_BOTH_FILES)}) f"""


@query("relationship_files", "PIPE-01 PIPE-02 JON-10 SRC-06 SRC-04 SRT-02 SNK-04 SNK-08", sql=f"""
{numbered_sql(f"SELECT value FROM ({_RECS_FILES}) _r WHERE _src = 1", "value", "both")}
UNION ALL {numbered_sql(f'''SELECT value FROM (SELECT value, row_number() OVER (PARTITION BY substr(value, 1, 150) ORDER BY _src, value) AS rn
  FROM ({_RECS_FILES}) _r) WHERE rn = 1''', "value", "search")}
UNION ALL {numbered_sql(f'''SELECT value FROM (SELECT value, count(*) OVER (PARTITION BY substr(value, 1, 150)) AS n FROM ({_RECS_FILES}) _r)
  WHERE n > 1''', "value", "duplicates")}""")
def relationship_files(spark, sf):
    rel, codes, names, aliases, cust = J.rel_inputs(spark, sf)
    gen = published(spark, "relationships")
    FJ.relationships_job(
        spark, put(rel, RL.REL_LAYOUT, ["K DESC"], "rel", is_binary=True),
        put(codes.withColumn("TYPE", F.lit("CC")), RL.CODE_LAYOUT, ["CODE"], "codes"), put(names, RL.NAME_LAYOUT, ["CUSTNO"], "names"),
        put(aliases, RL.ALIAS_LAYOUT, ["K DESC"], "alias"), put(cust, RL.CUSTOMER_LAYOUT, ["CUSTNO"], "cust"), "1997-01-01", gen)
    return outputs(gen, ["both", "search", "duplicates"])


_PARTY_ORDER = "CUSTTYPE <> 'O', CUSTNO, ACCTCODE, ACCTNO, CAST(CUSTNO1 AS BIGINT) DESC"


@query("parties_files", "PIPE-03 SRC-04 SRT-02 SNK-03 SNK-04 SNK-08", sql=f"""
{numbered_sql(f"SELECT *, {J._PARTY_FIXED} AS value FROM ({J._PARTY_ROWS_SQL}) p", _PARTY_ORDER, "fixed")}
UNION ALL {numbered_sql(f"SELECT *, {J._PARTY_QUOTED} AS value FROM ({J._PARTY_ROWS_SQL}) p", _PARTY_ORDER, "quoted")}""")
def parties_files(spark, sf):
    rel, accounts = J._party_inputs(spark, sf)
    gen = published(spark, "parties")
    FJ.parties_job(spark, put(rel, PT.SEARCH_LAYOUT, ["CAST(CUSTNO1 AS BIGINT) DESC"], "search"),
                   put(accounts, PT.ACCOUNT_LAYOUT, ["ACCTNO"], "accounts"), gen)
    return outputs(gen, ["fixed", "quoted"])


_VERIFY = J._address_sql(spec.VERIFY, 350, {"DASH": "'-'", "OLD": "'*OLD*'", "NEW": "'*NEW*'"})
_UPDATE = J._address_sql(spec.UPDATE, 200, {"NEW_CITY": "upper(NEW_CITY)"})


@query("address_files", "PIPE-08 SNK-05 SNK-08 SNK-09 SRT-02", sql=f"""
SELECT 'verify' AS output, line_no + 1 AS line_no, value FROM (
  SELECT 0::BIGINT AS line_no, {J._q(spec.heading(spec.VERIFY_HEADING, 350))} AS value
  UNION ALL {numbered_sql(f"SELECT CUSTNO, ADDREF, {_VERIFY} AS value FROM ({J.REPAIRED_SQL}) r", "CUSTNO, ADDREF, value")})
UNION ALL {numbered_sql(f"SELECT CUSTNO, ADDREF, {_UPDATE} AS value FROM ({J.REPAIRED_SQL}) r", "CUSTNO, ADDREF, value", "update")}""")
def address_files(spark, sf):
    gen = published(spark, "address")
    FJ.address_job(*J._address_inputs(spark, sf), gen)
    return outputs(gen, ["verify", "update"])


# The loan file holds no days in arrears.
_no_arrears = lambda sql: sql.replace("CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey % 120 END AS ARREARDAY",
                                      "CAST(NULL AS BIGINT) AS ARREARDAY")


@query("customer_report_files", "PIPE-11 SRC-04 SRC-06 SRC-09 SRC-11 JON-10 JON-14 SRT-02 SNK-04 SNK-06 SNK-08", sql=f"""
{numbered_sql(_no_arrears(J.RAW_SQL), "SRC, ACCTNOC, value", "raw")}
UNION ALL SELECT 'report' AS output, line_no + 2 AS line_no, value FROM ({_no_arrears(J.REPORT_SQL)}) _report""")
def customer_report_files(spark, sf):
    i = J.report_inputs(spark, sf)
    stmt, post, holds = J._report_details(spark, sf)
    blank = lambda df, layout: df.withColumns({f.name: F.lit(0) if f.kind == "p" else F.lit("")
                                               for f in layout.fields if f.name not in df.columns})
    dp = i["deposits"].withColumns({"REPTNO": F.lit(1001), "FMTCODE": F.lit(19)})
    requests = _fresh(spark, "requests")
    W.write_csv(i["requests"].select("ALIASKEY", "ALIAS"), requests, sep=";", header=False, quote_all=True)
    occupations = i["occupations"].withColumn("TYPE", F.lit("OCCUP"))
    occupations = occupations.unionByName(occupations.withColumns({"TYPE": F.lit("OTHER"), "DEMODESC": F.lit("-")}))
    gen = published(spark, "report")
    FJ.report_job(spark, i["customers"], {
        "requests": requests, "occupations": put(occupations, RP.OCCUPATION_LAYOUT, ["TYPE DESC", "DEMOCODE"]),
        "masco": put(i["masco"], RP.MASCO_LAYOUT, ["MASCO2008"]), "msic": put(i["msic"], RP.MSIC_LAYOUT, ["MSICCODE"]),
        "branches": put(i["branches"], RP.BRANCH_LAYOUT, ["ACCTBRCH"]),
        "deposits": put(blank(dp, RP.DEPOSIT_LAYOUT), RP.DEPOSIT_LAYOUT, ["ACCTNO"], "dp", is_binary=True),
        "loans": put(blank(i["loans"], RP.LOAN_LAYOUT), RP.LOAN_LAYOUT, ["ACCTNO"], "ln", is_binary=True),
        "boxes": put(i["boxes"], RP.BOX_LAYOUT, ["BRANCH_ABBR", "BANKINDC", "ACCTSTATUS", "ACCTNOC"]),
        "unicard": put(i["unicard"], RP.CARD_LAYOUT, ["ACCTNOC"]), "comcard": put(i["comcard"], RP.CARD_LAYOUT, ["ACCTNOC"]),
        "statements": put(blank(stmt, RP.STATEMENT_LAYOUT), RP.STATEMENT_LAYOUT, ["CURR_CYC_DR", "ACCTNO"], "st", is_binary=True),
        "posts": put(post, RP.POST_LAYOUT, ["ACCTNOC DESC"]), "holds": put(holds, RP.HOLD_LAYOUT, ["ACCTNO"])}, gen)
    return outputs(gen, ["raw", "report"])


# ------------------------------------------------------------- generations
@query("generations_published", "SNK-09 SNK-10 SRC-13", sql="""
SELECT 'GDG(' || b || ')' AS generation, row_number() OVER (PARTITION BY b ORDER BY o_orderkey) AS line_no, CAST(o_orderkey AS VARCHAR) AS value
FROM orders, (SELECT unnest([0, -1]) AS b) WHERE (b = 0 AND o_orderstatus = 'P') OR (b = -1 AND o_orderstatus = 'O' AND o_custkey % 2 = 0)""")
def generations_published(spark, sf):
    """Four generations of which two stay; one is written again."""
    gen = published(spark, "gdg", keep=2)
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus", "o_custkey",
                                          F.col("o_orderkey").cast("string").alias("value"))
    for status in ("F", "F", "O", "P"):
        gen.publish({"accounts": (o.where(F.col("o_orderstatus") == status), ["k"])})
    gen.publish({"accounts": (o.where("o_orderstatus = 'O' and o_custkey % 2 = 0"), ["k"])}, generation=3)
    return (gen.lines("accounts").select(F.lit("GDG(0)").alias("generation"), "line_no", "value")
            .unionByName(gen.lines("accounts", back=1).select(F.lit("GDG(-1)").alias("generation"), "line_no", "value")))

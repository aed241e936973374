"""Customer information raw file and report over all products (PIPE-11).

1. requested customers: alias request list x customer-account rows on
   (ALIASKEY, ALIAS);
2. descriptions: occupation / MASCO / MSIC code tables;
3. safe boxes: positional match-merge on the alias (a customer may hold several
   boxes and several accounts); SDBIND YES / NIL, the box branch, and the box's
   own columns, which stay with the customer row; then one row per account;
4. products, each classified by rule tables and given its branch: deposits
   (account ranges, foreign-currency product sets, open indicator, cost centre,
   packed dates, cents), loans (ranges, status precedence, cost centre, packed
   dates), safe boxes and two card systems;
5. each product merged with the customer rows by account (inner, product columns
   win, one row per account), deposits also with their statement cycle, post
   indicator and holds (positional: a row per detail row); stacked in product
   order. The raw file prints the stacked rows, the report cleans the amounts
   (keep positive / non-zero, zeroed outside FD/CA/SA), prints blanks as NIL and
   numbers the lines in (product, account) order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.functions.blanks import default_text, is_blank
from recsmith.functions.dates import packed_mmddyyyy_to_yyyymmdd
from recsmith.functions.numbers import MONEY, cents_to_units, nonzero_or_zero, positive_or_zero, to_number, zero_outside
from recsmith.functions.rules import (bank_indicator, deposit_appl_code, loan_appl_code, loan_status,
                                      open_indicator_status)
from recsmith.functions.strings import zero_pad
from recsmith.operators.dedup import first_per_key, first_record, in_order, seq_of
from recsmith.operators.joins import inner_join, lookup, match_merge, merge_files, overlay_merge
from recsmith.operators.positions import global_row_number
from recsmith.operators.reshape import union_widen
from recsmith.session import materialize
from recsmith.sources.layout import Layout

BALANCE_APPLS = ["FD", "CA", "SA"]
CYCLES = ["CURR_CYC_DR", "CURR_CYC_CR", "PREV_CYC_DR", "PREV_CYC_CR"]
CYCLE_AMOUNTS = ["CURR_AMT_DR", "CURR_AMT_CR", "PREV_AMT_DR", "PREV_AMT_CR"]
HOLD_AMOUNTS = ["AMT_1", "AMT_2", "AMT_3"]
REPORT_TITLE = "LIST OF CUSTOMERS INFORMATION"
REPORT_LRECL = 800

# Report fields (heading, first byte of heading and field, field,
# width, kind, decimals, byte of the separator after it).
REPORT_FIELDS = [
    ("NO", 1, "", 5, "c", 0, 6), ("ID TYPE", 7, "ALIASKEY", 5, "c", 0, 15), ("ID NUMBER", 16, "ALIAS", 20, "c", 0, 37),
    ("CUST NAME", 38, "CUSTNAME", 40, "c", 0, 79), ("CIS NUMBER", 80, "CUSTNO", 11, "c", 0, 92),
    ("OCCUPATION", 93, "DEMODESC", 60, "c", 0, 154), ("MASCO", 155, "MASCODESC", 27, "c", 0, 183),
    ("SIC CODE", 184, "SICCODE", 5, "c", 0, 193), ("MSIC BIS TYPE", 194, "MSICDESC", 27, "c", 0, 222),
    ("ACCT NUMBER", 223, "ACCTNOC", 20, "c", 0, 244), ("ACCT BRANCH", 245, "BRANCH_ABBR", 5, "c", 0, 257),
    ("ACCT STATUS", 258, "ACCTSTATUS", 24, "c", 0, 283), ("DATE ACCT OPEN", 284, "DATEOPEN", 8, "c", 0, 301),
    ("DATE ACCT CLOSED", 302, "DATECLSE", 8, "c", 0, 320), ("SDB(YES/NO)", 321, "SDBIND", 3, "c", 0, 333),
    ("BR SDB MAINTAN", 334, "SDBBRH", 3, "c", 0, 348), ("CURRENT BALANCE", 349, "TEMP_CURBAL", 14, "n", 2, 364),
    ("CURR CYC DR", 365, "TEMP_CURR_CYC_DR", 10, "n", 0, 376), ("CURR AMT DR", 377, "TEMP_CURR_AMT_DR", 16, "n", 2, 394),
    ("CURR CYC CR", 395, "TEMP_CURR_CYC_CR", 10, "n", 0, 406), ("CURR AMT CR", 407, "TEMP_CURR_AMT_CR", 16, "n", 2, 424),
    ("PREV CYC DR", 425, "TEMP_PREV_CYC_DR", 10, "n", 0, 442), ("PREV AMT DR", 443, "TEMP_PREV_AMT_DR", 16, "n", 2, 460),
    ("PREV CYC CR", 461, "TEMP_PREV_CYC_CR", 10, "n", 0, 478), ("PREV AMT CR", 479, "TEMP_PREV_AMT_CR", 16, "n", 2, 496),
    ("POST INDICATOR", 497, "ACCT_PST_IND", 1, "c", 0, 511), ("POST INDICATOR REASON", 512, "ACCT_PST_REASON", 20, "c", 0, 533),
    ("TOTAL OF HOLD", 534, "TOT_HOLD", 2, "c", 0, 547), ("SEQ OF HOLD(1)", 548, "SEQID_1", 2, "c", 0, 562),
    ("AMT OF HOLD(1)", 563, "TEMP_AMT_1", 14, "n", 2, 579), ("DESCRIP OF HOLD(1)", 580, "DESC_1", 20, "c", 0, 600),
    ("SOURCE(1)", 601, "SOURCE_1", 20, "c", 0, 621), ("SEQ OF HOLD(2)", 622, "SEQID_2", 2, "c", 0, 636),
    ("AMT OF HOLD(2)", 637, "TEMP_AMT_2", 14, "n", 2, 653), ("DESCRIP OF HOLD(2)", 654, "DESC_2", 20, "c", 0, 674),
    ("SOURCE(2)", 675, "SOURCE_2", 20, "c", 0, 695), ("SEQ OF HOLD(3)", 696, "SEQID_3", 2, "c", 0, 700),
    ("AMT OF HOLD(3)", 701, "TEMP_AMT_3", 14, "n", 2, 717), ("DESCRIP OF HOLD(3)", 718, "DESC_3", 20, "c", 0, 738),
    ("SOURCE(3)", 739, "SOURCE_3", 20, "c", 0, 759),
]

# Input records of the job. Deposits are a multi-format file: the header says which
# records hold an account.
DEPOSIT_LRECL = 900
DEPOSIT_LAYOUT = Layout.of([
    ("BANKNO", 3, 2, "p"), ("REPTNO", 24, 3, "p"), ("FMTCODE", 27, 2, "p"), ("ACCTBRCH1", 106, 4, "p"), ("ACCTNO", 110, 6, "p"),
    ("ACCTNAME", 116, 15), ("CLSEDATE", 158, 6, "p"), ("OPENDATE", 164, 6, "p"), ("PURPOSECD", 286, 1), ("LEDGERBAL1", 319, 7, "p"),
    ("DECEASED1", 341, 1), ("DECEASED2", 342, 1), ("DECEASED3", 343, 1), ("PRODTYPE", 397, 2, "p"), ("BALHOLD", 403, 1),
    ("CURBAL", 466, 7, "p", 2), ("ODLIMIT", 566, 6, "p"), ("CURRCODE", 588, 3), ("OPENIND", 716, 1), ("COSTCTR", 830, 4, "p"),
    ("POSTIND", 855, 1)], lrecl=DEPOSIT_LRECL)
DEPOSIT_RECORDS = {"REPTNO": [1001], "FMTCODE": [1, 10, 22, 19, 20, 21]}
DEPOSIT_FIELDS = ["ACCTBRCH1", "ACCTNO", "CLSEDATE", "OPENDATE", "PURPOSECD", "LEDGERBAL1", "PRODTYPE", "CURBAL", "OPENIND", "COSTCTR"]
STATEMENT_LAYOUT = Layout.of(
    [("ACCTNO", 1, 10, "n"), ("ACCTNAME", 11, 24)]
    + [f for i, (c, a) in enumerate(zip(CYCLES, CYCLE_AMOUNTS)) for f in ((c, 35 + 13 * i, 5, "p"), (a, 40 + 13 * i, 8, "p", 2))], lrecl=86)
POST_LAYOUT = Layout.of([("ACCTNOC", 1, 11), ("ACCT_PST_IND", 12, 1), ("ACCT_PST_REASON", 13, 20)], lrecl=32)
HOLD_LAYOUT = Layout.of(
    [("ACCTNO", 1, 10, "n")] + [(f"SEQID_{i}", 8 + 4 * i, 3) for i in (1, 2, 3)] + [(f"AMT_{i}", 9 + 15 * i, 14, "n", 2) for i in (1, 2, 3)]
    + [(f"DESC_{i}", 48 + 21 * i, 20) for i in (1, 2, 3)] + [(f"SOURCE_{i}", 111 + 21 * i, 20) for i in (1, 2, 3)] + [("TOT_HOLD", 195, 2)],
    lrecl=196)

LOAN_LAYOUT = Layout.of([
    ("ACCTNO", 1, 6, "p"), ("ACCTNAME", 7, 24), ("ORGTYPE", 42, 1), ("NOTENO", 81, 3, "p"), ("NOTEREV", 84, 1), ("NOTETYPE", 85, 2, "p"),
    ("BRANCHNOTE", 87, 4, "p"), ("ACCTOPENDATE", 95, 6, "p"), ("LASTTRANDATE", 113, 6, "p"), ("NOTECURBAL", 121, 8, "p"),
    ("COSTCENTER", 238, 4, "p"), ("NOTEPAID", 261, 1), ("APPRVLIMIT", 262, 8, "p"), ("NPLINDC", 338, 1), ("AANUMBER", 596, 20)], lrecl=615)
LOAN_FIELDS = ["ACCTNO", "ACCTOPENDATE", "LASTTRANDATE", "NOTECURBAL", "COSTCENTER", "NOTEPAID", "NPLINDC"]
BOX_LAYOUT = Layout.of([("CUSTNO", 8, 11), ("ALIAS", 75, 20), ("BRANCH_ABBR", 192, 7), ("ACCTNOC", 218, 20), ("BANKINDC", 249, 1),
                        ("ACCTSTATUS", 281, 25)], lrecl=414)
CARD_LAYOUT = Layout.of([("BRANCH_ABBR", 192, 5), ("ACCTNOC", 218, 20), ("ACCTSTATUS", 281, 25), ("DATEOPEN", 309, 8),
                         ("DATECLSE", 322, 8)], lrecl=329)
BRANCH_LAYOUT = Layout.of([("ACCTBRCH", 2, 3), ("BRANCH_ABBR", 6, 5)], lrecl=10)
OCCUPATION_LAYOUT = Layout.of([("TYPE", 5, 5), ("DEMOCODE", 10, 3), ("DEMODESC", 40, 60)], lrecl=99)
MASCO_LAYOUT = Layout.of([("MASCO2008", 8, 5), ("MASCODESC", 43, 27)], lrecl=69)
MSIC_LAYOUT = Layout.of([("MSICCODE", 8, 5), ("MSICDESC", 43, 27)], lrecl=69)
REQUEST_COLUMNS, REQUEST_WIDTHS = ["ALIASKEY", "ALIAS"], {"ALIASKEY": 3, "ALIAS": 37}

# The raw record. The one-byte bank indicator stands on the last
# byte of the 13-byte balance, so 12 bytes of the balance are left.
RAW_LAYOUT = Layout.of([
    ("CUSTNO", 1, 11), ("ACCTNOC", 14, 20), ("OCCUP", 36, 3), ("MASCO2008", 42, 5), ("ALIASKEY", 50, 5), ("ALIAS", 56, 20),
    ("CUSTNAME", 78, 40), ("DATEOPEN", 120, 8), ("DATECLSE", 130, 8), ("LEDGERBAL12", 140, 12), ("BANKINDC", 152, 1),
    ("CITIZENSHIP", 154, 2), ("APPL_CODE", 158, 5), ("PRODTY", 164, 3), ("DEMODESC", 169, 60), ("MASCODESC", 231, 27),
    ("JOINTACC", 260, 1), ("MSICCODE", 262, 5), ("ACCTBRCH", 267, 3), ("BRANCH_ABBR", 275, 5), ("ACCTSTATUS", 280, 24),
    ("SICCODE", 304, 5),
], lrecl=400)


def requested_customers(requests: DataFrame, cust: DataFrame) -> DataFrame:
    return inner_join(requests.select("ALIASKEY", "ALIAS").distinct(), cust, ["ALIASKEY", "ALIAS"])


def describe(custs: DataFrame, occup: DataFrame, masco: DataFrame, msic: DataFrame) -> DataFrame:
    """The code tables' texts; customers carry OCCUP, MASCO2008 and MSICCODE."""
    occup = first_record(occup.withColumnRenamed("DEMOCODE", "OCCUP"), "OCCUP", "OCCUP", "DEMODESC")
    out = lookup(custs, occup, "OCCUP")
    out = lookup(out, first_record(masco, "MASCO2008", "MASCO2008", "MASCODESC"), "MASCO2008")
    return lookup(out, first_record(msic, "MSICCODE", "MSICCODE", "MSICDESC"), "MSICCODE")


def with_safe_boxes(custs: DataFrame, boxes: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Customers merged by position with the boxes of their alias, one row per
    account (the first by alias and position). ``aliases``: a frame with the customers' ALIAS
    that takes less to compute than ``custs``, to look for aliases of many rows in."""
    aliases = (custs if aliases is None else aliases).select("ALIAS").union(boxes.select("ALIAS"))
    b = boxes.select("ALIAS", "BRANCH_ABBR", "BANKINDC", "ACCTSTATUS", F.lit(0).cast(MONEY).alias("LEDGERBAL"),
                     F.lit("SDB").alias("APPL_CODE"), *[F.col(c).alias("_bseq") for c in seq_of(boxes)])
    # The customers were sorted by each code in turn, then by alias; the boxes as read.
    m = match_merge(custs, b, "ALIAS", ["MSICCODE", "MASCO2008", "OCCUP", "ALIASKEY", *in_order(custs, "ACCTNOC")],
                    ["_bseq"] if seq_of(boxes) else ["BRANCH_ABBR"], keep="left", histogram=aliases).drop("_bseq")
    m = m.withColumns({
        "SDBIND": F.when(F.col("in_right"), F.lit("YES")).otherwise(F.lit("NIL")),
        "SDBBRH": F.when(F.col("in_right"), F.substring("BRANCH_ABBR", 1, 3)).otherwise(F.lit("NIL")),
    }).drop("in_left", "in_right")
    return first_per_key(m, "ACCTNOC", ["ALIAS", "slot"]).drop("slot")


def with_branch(accounts: DataFrame, branches: DataFrame) -> DataFrame:
    return lookup(accounts, first_record(branches, "ACCTBRCH", "ACCTBRCH", "BRANCH_ABBR"), "ACCTBRCH")


def deposit_accounts(dp: DataFrame) -> DataFrame:
    """``dp``: ACCTNO (number), ACCTBRCH1 (number), PRODTYPE, COSTCTR, OPENIND, PURPOSECD,
    LEDGERBAL1 (cents), CURBAL, OPENDATE / CLSEDATE (packed MMDDYYYY)."""
    # padded keys first, in their own projection: the rules below test them
    # many times and must not rebuild them per test
    keyed = dp.filter(~is_blank("PURPOSECD")).withColumns(
        {"ACCTNOC": zero_pad("ACCTNO", 11), "PRODTY": zero_pad("PRODTYPE", 3)})
    out = keyed.select(
        "ACCTNOC", "PRODTY", zero_pad("ACCTBRCH1", 3).alias("ACCTBRCH"),
        deposit_appl_code("ACCTNOC", "PRODTY").alias("APPL_CODE"),
        bank_indicator("COSTCTR", closed=False).alias("BANKINDC"),
        open_indicator_status("OPENIND").alias("ACCTSTATUS"),
        packed_mmddyyyy_to_yyyymmdd("OPENDATE").alias("DATEOPEN"),
        packed_mmddyyyy_to_yyyymmdd("CLSEDATE").alias("DATECLSE"),
        cents_to_units("LEDGERBAL1").alias("LEDGERBAL"),
        F.col("CURBAL").cast(MONEY).alias("CURBAL"), *seq_of(dp))
    return first_record(out, "ACCTNOC")


def loan_accounts(ln: DataFrame) -> DataFrame:
    """``ln``: ACCTNO, NOTENO, COSTCENTER, NPLINDC, ARREARDAY (optional),
    NOTEPAID, NOTECURBAL (cents), ACCTOPENDATE / LASTTRANDATE (packed)."""
    if "ARREARDAY" not in ln.columns:
        ln = ln.withColumn("ARREARDAY", F.lit(None).cast("long"))
    cc = to_number(F.substring(zero_pad("COSTCENTER", 7), 5, 3))
    out = ln.withColumn("ACCTNOC", zero_pad("ACCTNO", 11)).select(
        "ACCTNOC", loan_appl_code("ACCTNOC").alias("APPL_CODE"),
        bank_indicator("COSTCENTER", closed=True).alias("BANKINDC"),
        loan_status("NPLINDC", "ARREARDAY", "NOTEPAID", "NOTECURBAL").alias("ACCTSTATUS"),
        packed_mmddyyyy_to_yyyymmdd("ACCTOPENDATE").alias("DATEOPEN"),
        packed_mmddyyyy_to_yyyymmdd("LASTTRANDATE").alias("DATECLSE"),
        cents_to_units("NOTECURBAL").alias("LEDGERBAL"),
        zero_pad(cc, 3).alias("ACCTBRCH"), *seq_of(ln))
    return first_record(out, "ACCTNOC")


def box_accounts(boxes: DataFrame) -> DataFrame:
    """Safe boxes as products: their own customer number wins."""
    return first_record(boxes.select("ACCTNOC", "CUSTNO", F.rtrim(F.substring("BRANCH_ABBR", 1, 5)).alias("BRANCH_ABBR"),
                                     "BANKINDC", "ACCTSTATUS", F.lit(0).cast(MONEY).alias("LEDGERBAL"),
                                     F.lit("SDB").alias("APPL_CODE"), *seq_of(boxes)), "ACCTNOC")


def card_accounts(cards: DataFrame) -> DataFrame:
    return first_record(cards, "ACCTNOC", "ACCTNOC", "BRANCH_ABBR", "ACCTSTATUS", "DATEOPEN", "DATECLSE")


def merged_products(custs: DataFrame, products: list[DataFrame]) -> list[DataFrame]:
    """Per product (SRC 1, 2, ...) the customer rows that hold it, product columns
    winning. The customer rows are stored once for all of them."""
    custs = materialize(custs, "report-customers")
    return [overlay_merge(custs, p, "ACCTNOC", how="inner").withColumn("SRC", F.lit(i + 1)) for i, p in enumerate(products)]


def with_details(deposits: DataFrame, stmt: DataFrame, post: DataFrame, holds: DataFrame) -> DataFrame:
    """Statement cycle, post indicator and holds of deposit accounts, merged by position in
    one shuffle: an account may have several rows in any of them."""
    key = zero_pad("ACCTNO", 11).alias("ACCTNOC")
    details = [stmt.select(key, *CYCLES, *CYCLE_AMOUNTS, *[F.col(c).alias("_seq1") for c in seq_of(stmt)]),
               post.select("ACCTNOC", "ACCT_PST_IND", "ACCT_PST_REASON", *[F.col(c).alias("_seq2") for c in seq_of(post)]),
               holds.select(key, "TOT_HOLD", *[f"{c}_{i}" for c in ("SEQID", "AMT", "DESC", "SOURCE") for i in (1, 2, 3)],
                            *[F.col(c).alias("_seq3") for c in seq_of(holds)])]
    orders = [[c for c in d.columns if c.startswith("_seq")] for d in details]
    # Deposits are one row an account: the details alone say which accounts are hot.
    accounts = reduce(DataFrame.union, [d.select("ACCTNOC") for d in details])
    out = merge_files([deposits, *details], "ACCTNOC", [[], *orders], histogram=accounts)
    return out.drop("slot", "_seq1", "_seq2", "_seq3")


def raw_records(products: list[DataFrame]) -> DataFrame:
    """The raw file's 400-byte records of all products."""
    rows = with_absent(union_widen(*products), RAW_LAYOUT.names, skip=["LEDGERBAL12"])
    money = F.coalesce(F.lpad(F.col("LEDGERBAL").cast(MONEY).cast("string"), 13, " "), F.lit(" " * 13))
    rows = rows.withColumn("LEDGERBAL12", F.substring(money, 1, 12))
    return rows.select("SRC", "ACCTNOC", RAW_LAYOUT.render_expr().alias("value"))


def with_absent(rows: DataFrame, names: list[str], skip: list[str] = ()) -> DataFrame:
    """Columns that no product has, as missing text."""
    return rows.withColumns({n: F.lit(None).cast("string") for n in names if n not in rows.columns and n not in skip})


def report_rows(products: list[DataFrame]) -> DataFrame:
    """The stacked products with cleaned amounts and printed defaults."""
    rows = union_widen(*products)
    kept = {"CURBAL": nonzero_or_zero("CURBAL"), **{c: positive_or_zero(c) for c in CYCLES + CYCLE_AMOUNTS}}
    rows = rows.withColumns({f"TEMP_{c}": v for c, v in kept.items()})
    return rows.withColumns({
        **{f"TEMP_{c}": zero_outside(f"TEMP_{c}", "APPL_CODE", BALANCE_APPLS) for c in kept},
        **{f"TEMP_{c}": positive_or_zero(c) for c in HOLD_AMOUNTS},
        **{c: default_text(c) for c in ("DEMODESC", "MASCODESC", "SICCODE", "MSICDESC")},
    })


def report_lines(rows: DataFrame) -> DataFrame:
    """Title (line -1), heading (line 0) and numbered lines in (SRC, ACCTNOC) order.

    The line is rendered before numbering, so only the order keys and one text
    column are written for the row numbers. A number above 99,999 is printed
    whole and moves the rest of its line; no digit is cut."""
    fields = [(name, at, w, kind, dec) for _, at, name, w, kind, dec, _ in REPORT_FIELDS[1:]]
    marks = [(f"_s{at}", at, 1) for *_, at in REPORT_FIELDS]
    # Byte 6 of the line on: what follows the number.
    body = Layout.of([(n, at - 5, *rest) for n, at, *rest in fields + marks], lrecl=REPORT_LRECL - 5)
    text = body.render_expr({n: F.lit(";") for n, _, _ in marks}).alias("_rest")
    rows = with_absent(rows, [n for n, *_ in fields])
    # Written once: the range partitioning samples its input, which would
    # otherwise run the whole join pipeline a second time.
    lines = materialize(rows.select("SRC", "ACCTNOC", text), "report-lines")
    numbered = global_row_number(lines, ["SRC", "ACCTNOC", "_rest"], "NO")
    number = F.col("NO").cast("string")
    body = numbered.select(F.col("NO").alias("line_no"), F.concat(
        F.when(F.length(number) > 5, number).otherwise(F.lpad(number, 5, " ")), F.col("_rest")).alias("value"))
    heads = ""
    for head, at, *_, mark in REPORT_FIELDS:
        heads = (heads.ljust(at - 1) + head)[:mark - 1].ljust(mark - 1) + ";"
    top = rows.sparkSession.createDataFrame([(-1, REPORT_TITLE.ljust(REPORT_LRECL)), (0, heads.ljust(REPORT_LRECL))],
                                            "line_no long, value string")
    return top.unionByName(body)

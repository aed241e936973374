"""Combined customer control file (PIPE-10).

customer daily table -> zero-padded phones / address reference, 20 risk
codes packed into one text, open date decoded -> first row per customer;
individual daily table -> latest update per customer, blank numbers
dropped; code table routed into three lookups (residency, corporate status,
citizenship) in one pass; left merges; run timestamp from the control date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.functions.blanks import is_blank
from recsmith.functions.dates import open_date_text
from recsmith.functions.strings import zero_pad
from recsmith.operators.dedup import first_record, latest_per_key, seq_of
from recsmith.operators.joins import lookup
from recsmith.operators.reshape import route
from recsmith.sources.layout import Layout

HRC_COLUMNS = [f"HRC{i:02d}" for i in range(1, 21)]
PHONES = {"PRIPHONEX": "PRIPHONE", "SECPHONEX": "SECPHONE", "MOBILEPHX": "MOBILEPH",
          "FAXX": "FAX", "ADDREFX": "ADDREF"}
INDV_KEEP = ["IDTYPE", "ID", "CUSTBRANCH", "LAST_UPDATE_DATE", "LAST_UPDATE_TIME",
             "LAST_UPDATE_OPER", "PRCOUNTRY", "EMPLOYMENT_TYPE", "EMPLOYMENT_SECTOR", "EMPLOYMENT_LAST_UPDATE"]
# Customer columns that go to the record as they are.
CUST_KEEP = ["CUSTNAME", "ALIASKEY", "ALIAS", "PROCESSTIME", "CUSTSTAT", "TAXCODE", "TAXID", "CUSTBRCH", "COSTCTR",
             "CUSTMNTDATE", "CUSTLASTOPER", "PRIM_OFF", "SEC_OFF", "PRIM_LN_OFF", "SEC_LN_OFF", "RACE", "RESIDENCY",
             "CITIZENSHIP", "EXPERIENCE", "HOBBIES", "RELIGION", "LANGUAGE", "INST_SEC", "CUST_CODE", "CUSTCONSENT",
             "BASICGRPCODE", "MSICCODE", "MASCO2008", "INCOME", "EDUCATION", "OCCUP", "MARITALSTAT", "OWNRENT", "EMPNAME",
             "DOBDOR", "SICCODE", "CORPSTATUS", "NETWORTH", "BNMID", "LONGNAME", "INDORG"]
# The record (name, first byte, width).
COMBINED_LAYOUT = Layout.of([
    ("RUNTIMESTAMP", 1, 20), ("CUSTNOX", 21, 20), ("ADDREFX", 41, 11), ("CUSTNAME", 52, 40), ("PRIPHONEX", 92, 11),
    ("SECPHONEX", 103, 11), ("MOBILEPHX", 114, 11), ("FAXX", 125, 11), ("ALIASKEY", 136, 3), ("ALIAS", 139, 20),
    ("PROCESSTIME", 159, 8), ("CUSTSTAT", 167, 1), ("TAXCODE", 168, 1), ("TAXID", 169, 9), ("CUSTBRCH", 178, 5),
    ("COSTCTR", 183, 5), ("CUSTMNTDATE", 188, 8), ("CUSTLASTOPER", 196, 8), ("PRIM_OFF", 204, 5), ("SEC_OFF", 209, 5),
    ("PRIM_LN_OFF", 214, 5), ("SEC_LN_OFF", 219, 5), ("RACE", 224, 1), ("RESIDENCY", 225, 3), ("CITIZENSHIP", 228, 2),
    ("OPENDT", 230, 8), ("HRCALL", 241, 60), ("EXPERIENCE", 301, 3), ("HOBBIES", 304, 3), ("RELIGION", 307, 3),
    ("LANGUAGE", 310, 3), ("INST_SEC", 313, 3), ("CUST_CODE", 316, 3), ("CUSTCONSENT", 319, 3), ("BASICGRPCODE", 322, 3),
    ("MSICCODE", 327, 5), ("MASCO2008", 332, 5), ("INCOME", 337, 3), ("EDUCATION", 340, 3), ("OCCUP", 343, 3),
    ("MARITALSTAT", 346, 1), ("OWNRENT", 347, 1), ("EMPNAME", 348, 40), ("DOBDOR", 388, 8), ("SICCODE", 396, 5),
    ("CORPSTATUS", 401, 3), ("NETWORTH", 404, 3), ("LAST_UPDATE_DATE", 407, 10), ("LAST_UPDATE_TIME", 417, 10),
    ("LAST_UPDATE_OPER", 427, 10), ("PRCOUNTRY", 437, 2), ("EMPLOYMENT_TYPE", 439, 10), ("EMPLOYMENT_SECTOR", 449, 10),
    ("EMPLOYMENT_LAST_UPDATE", 459, 10), ("BNMID", 469, 20), ("LONGNAME", 489, 150), ("INDORG", 639, 1),
    ("RESDESC", 640, 20), ("SALDESC", 660, 20), ("CTZDESC", 680, 20),
], lrecl=1000)
# Code table categories and the customer column each one describes.
LOOKUPS = [("RESTR", "RESIDENCY", "RESDESC", 3), ("SALES", "CORPSTATUS", "SALDESC", 3),
           ("CITZN", "CITIZENSHIP", "CTZDESC", 2)]


def customer_part(cust: DataFrame) -> DataFrame:
    # Every code has its three characters: absent or missing codes are 000.
    hrc = [zero_pad(F.coalesce(F.col(c).try_cast("long"), F.lit(0)) if c in cust.columns else F.lit(0), 3)
           for c in HRC_COLUMNS]
    derived = cust.select(
        F.col("CUSTNO").alias("CUSTNOX"), *CUST_KEEP,
        *[zero_pad(src, 11).alias(dst) for dst, src in PHONES.items()],
        F.concat(*hrc).alias("HRCALL"),
        open_date_text("CUSTOPENDATE").alias("OPENDT"), *seq_of(cust))
    return first_record(derived, "CUSTNOX")


def individual_part(indv: DataFrame) -> DataFrame:
    latest = latest_per_key(indv.select("CUSTNO", *INDV_KEEP), "CUSTNO", ["LAST_UPDATE_DATE"])
    return latest.filter(~is_blank("CUSTNO")).withColumnRenamed("CUSTNO", "CUSTNOX")


def code_lookups(codes: DataFrame) -> dict[str, DataFrame]:
    """One pass over the code table, routed by category; code = 3 characters
    (2 for citizenship, the same bytes read shorter); first per code."""
    routed = route(codes, {c: F.col("DEMOCATEGORY") == c for c, *_ in LOOKUPS}, "_cat")
    out = {}
    for cat, col, desc, width in LOOKUPS:
        part = routed.filter(F.col("_cat") == cat).select(
            F.rtrim(F.substring("DEMOCODE", 1, width)).alias(col), F.col("CODEDESC").alias(desc), *seq_of(codes))
        out[cat] = first_record(part, col)
    return out


def combined_file(cust: DataFrame, indv: DataFrame, codes: DataFrame, run_ts: str) -> DataFrame:
    """All fields of the record, one row per customer."""
    c = customer_part(cust)
    out = lookup(c, individual_part(indv), "CUSTNOX")
    tables = code_lookups(codes)
    for cat, col, desc, _ in LOOKUPS:
        out = lookup(out, tables[cat], col)
        out = out.withColumn(desc, F.coalesce(F.col(desc), F.lit("")))
    return out.withColumn("RUNTIMESTAMP", F.lit(run_ts))


def combined_records(combined: DataFrame) -> DataFrame:
    """The 1000-byte records beside their customer number."""
    return combined.select("CUSTNOX", COMBINED_LAYOUT.render_expr().alias("value"))

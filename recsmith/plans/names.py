"""Names with long name (PIPE-05) and deposit address listing (PIPE-07)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.functions.strings import isin_padded
from recsmith.operators.dedup import first_record
from recsmith.operators.joins import inner_join, lookup
from recsmith.sources.layout import Layout

# The name is read twice (@12 and @86); the second read wins and is written
# to both slots of the output record.
NAME_IN_LAYOUT = Layout.of([
    ("CUSTNO", 1, 11), ("CUSTNAME", 12, 40), ("ADREFNO", 52, 11), ("PRIPHONE", 63, 11),
    ("SECPHONE", 74, 11), ("CUSTTYPE", 85, 1), ("CUSTNAME", 86, 40), ("MOBILEPHONE", 126, 11),
])

REMARK_LAYOUT = Layout.of([
    ("BANKNO", 1, 3), ("APPLCODE", 4, 5), ("CUSTNO", 9, 11), ("EFFDATE", 29, 15), ("RMKKEYWORD", 44, 8),
    ("LONGNAME", 52, 150), ("RMKOPERATOR", 352, 8), ("EXPIREDATE", 360, 10), ("LASTMNTDATE", 370, 10),
], lrecl=379)

NAME_OUT_LAYOUT = Layout.of([
    ("CUSTNO", 1, 11), ("CUSTNAME", 12, 40), ("ADREFNO", 52, 11), ("PRIPHONE", 63, 11),
    ("SECPHONE", 74, 11), ("CUSTTYPE", 85, 1), ("CUSTNAME_2", 86, 40), ("MOBILEPHONE", 126, 11),
    ("LONGNAME", 137, 150),
], lrecl=350)

NAME_COLS = ["CUSTNO", "CUSTNAME", "ADREFNO", "PRIPHONE", "SECPHONE", "CUSTTYPE", "MOBILEPHONE"]


def names_with_long_name(names: DataFrame, remarks: DataFrame,
                         name_order=("CUSTNAME",), remark_order=("EFFDATE",)) -> DataFrame:
    """First name record and first remark per customer, left merge."""
    n = first_record(names, "CUSTNO", *NAME_COLS, otherwise=name_order)
    r = first_record(remarks, "CUSTNO", "CUSTNO", "EFFDATE", "LONGNAME", otherwise=remark_order)
    out = lookup(n, r.select("CUSTNO", "LONGNAME"), "CUSTNO")
    return out.select(*NAME_COLS, F.coalesce("LONGNAME", F.lit("")).alias("LONGNAME"))


# ---------------------------------------------------------------- PIPE-07
ACCOUNT_LOW = "010000000000"
LINE_TYPES = [f"NA_LINE_TYP{i}" for i in range(1, 9)]
ADDR_LINES = [f"ADD_NAME_{i}" for i in range(1, 9)]

# Input records of the job: ownership (binary, packed decimals) and address lines.
OWNERSHIP_LAYOUT = Layout.of(
    [("HOLD_CO_NO", 1, 2, "p"), ("BANK_NO", 3, 2, "p"), ("REF_NO", 5, 6, "p"), ("EFF_DATE", 11, 5, "p"), ("O_HOLD_CO_NO", 16, 2, "p"),
     ("O_BANK_NO", 18, 2, "p"), ("O_APPL_CODE", 20, 5), ("ACCTNO", 25, 11), ("O_REC_TYPE", 45, 2, "p"), ("PROCESS_TIME", 47, 8),
     ("HIST_IND", 55, 1), ("NA_SAME", 56, 1)] + [(t, 57 + i, 1) for i, t in enumerate(LINE_TYPES)] + [("NA_FUTUR_IND", 65, 1)], lrecl=65)
ADDRESS_LAYOUT = Layout.of([("ACCTNO", 1, 11)] + [(a, 12 + 40 * i, 40 - (i == 7)) for i, a in enumerate(ADDR_LINES)], lrecl=330)

DEPOSIT_ADDR_LAYOUT = Layout.of(
    [("O_APPL_CODE", 1, 5), ("ACCTNO", 6, 20)]
    + [f for i in range(8) for f in ((LINE_TYPES[i], 26 + 41 * i, 1), (ADDR_LINES[i], 27 + 41 * i, 40))],
    lrecl=400)


def deposit_addresses(ownership: DataFrame, addresses: DataFrame) -> DataFrame:
    """Deposit ownership records (application DP, account above the bound,
    first per account) joined with the address lines (first per account)."""
    own = ownership.filter(isin_padded("O_APPL_CODE", ["DP   "]) & (F.col("ACCTNO") > ACCOUNT_LOW))
    own = first_record(own, "ACCTNO", "ACCTNO", "O_APPL_CODE", *LINE_TYPES)
    adr = addresses.filter(F.col("ACCTNO") > ACCOUNT_LOW)
    adr = first_record(adr, "ACCTNO", "ACCTNO", *ADDR_LINES)
    return inner_join(adr, own, "ACCTNO").select("O_APPL_CODE", "ACCTNO", *[
        c for i in range(8) for c in (LINE_TYPES[i], ADDR_LINES[i])])


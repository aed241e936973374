"""Business rule tables as data, compiled to native CASE expressions (CLS-*).

Rules stay CASE expressions evaluated inside whole-stage codegen: no join,
no Cartesian product, no Python. The tables below are fixed values that
must equal the customer system's rules; they are listed as plain text in
their natural order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recsmith.functions.numbers import first_match, last_match
from recsmith.functions.strings import col

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# CLS-01: two-digit account prefix -> application.
PREFIX_DP = ["01", "03", "04", "05", "06", "07"]
PREFIX_LN = ["02", "08"]

# CLS-02: deposit account-number ranges (exclusive bounds on 11-digit text).
DEPOSIT_RANGES = [
    ("03000000000", "03999999999", "CA"),
    ("06200000000", "06299999999", "CA"),
    ("06710000000", "06719999999", "CA"),
    ("01000000000", "01999999999", "FD"),
    ("07000000000", "07999999999", "FD"),
    ("04000000000", "04999999999", "SA"),
    ("05000000000", "05999999999", "SA"),
    ("06000000000", "06199999999", "SA"),
    ("06300000000", "06709999999", "SA"),
    ("06720000000", "06999999999", "SA"),
]
# CLS-02: loan account-number ranges (exclusive bounds).
LOAN_RANGES = [
    ("02000000000", "02999999999", "LN"),
    ("08000000000", "08999999999", "HP"),
]

# CLS-03: foreign-currency product sets, applied after the ranges.
FCY_FD_PRODUCTS = ["371", "350", "351", "352", "353", "354", "355", "356", "357",
                   "358", "359", "360", "361", "362"]
FCY_CA_PRODUCTS = ["400", "401", "402", "403", "404", "405", "406", "407", "408",
                   "409", "410", "411", "413", "414", "420", "421", "422", "423",
                   "424", "425", "426", "427", "428", "429", "430", "431", "432",
                   "433", "434", "440", "441", "442", "443", "444", "450", "451",
                   "452", "453", "454", "460", "461", "473", "474", "475", "476"]

# CLS-04: zip ranges (inclusive) -> state code.
ZIP_STATE_RANGES = [
    (79000, 86999, "JOH"),
    (5000, 9999, "KED"),
    (15000, 18999, "KEL"),
    (75000, 78999, "MEL"),
    (70000, 73999, "NEG"),
    (25000, 28999, "PAH"),
    (69000, 69000, "PAH"),
    (10000, 14999, "PEN"),
    (30000, 36999, "PRK"),
    (39000, 39999, "PRK"),
    (1000, 2999, "PER"),
    (88000, 91999, "SAB"),
    (93000, 98999, "SAR"),
    (40000, 49999, "SEL"),
    (63000, 64999, "SEL"),
    (68000, 68199, "SEL"),
    (20000, 24999, "TER"),
    (50000, 60999, "W P"),
    (87000, 87999, "LAB"),
    (62000, 62999, "PUT"),
]

# CLS-05: open indicator -> account status (first match).
OPEN_INDICATOR_STATUS = [
    ("", "ACTIVE"),
    ("B", "CLOSED"),
    ("C", "CLOSED"),
    ("P", "CLOSED"),
    ("Z", "ZERO BALANCE"),
]

# CLS-06: loan status texts.
LOAN_NPL, LOAN_ARREARS, LOAN_PAID, LOAN_ACTIVE = (
    "NPL", "ACCOUNT IN ARREARS", "PAID-OFF", "ACTIVE")

# CLS-07: cost-centre bounds of the in-house bank.
COST_CENTRE_LOW, COST_CENTRE_HIGH = 3000, 3999

# CLS-09: loan status code -> text.
LOAN_CODE_TEXT = [("A", "ACTIVE"), ("P", "PAID_OFF"), ("N", "NPL")]
LOAN_CODE_OTHER = "UNKNOWN"


# ---------------------------------------------------------------------------
# Classifiers
# ---------------------------------------------------------------------------

def account_prefix_code(acct) -> Column:
    """CLS-01: first two characters of the account -> DP / LN, else ''."""
    p = F.substring(col(acct), 1, 2)
    return last_match([(p.isin(PREFIX_DP), "DP"), (p.isin(PREFIX_LN), "LN")], "")


def _open_range(acct, ranges) -> list[tuple[Column, str]]:
    a = col(acct)
    return [((a > F.lit(lo)) & (a < F.lit(hi)), code) for lo, hi, code in ranges]


def deposit_appl_code(acct, prodtype=None) -> Column:
    """CLS-02 + CLS-03: range rule, overridden by the product sets (later IFs win)."""
    cases = _open_range(acct, DEPOSIT_RANGES)
    if prodtype is not None:
        p = F.rtrim(col(prodtype))
        cases += [(p.isin(FCY_FD_PRODUCTS), "FCYFD"), (p.isin(FCY_CA_PRODUCTS), "FCYCA")]
    return last_match(cases, "")


def loan_appl_code(acct) -> Column:
    """CLS-02 loans: LN / HP ranges, else ''."""
    return last_match(_open_range(acct, LOAN_RANGES), "")


def zip_state(zip_text) -> Column:
    """CLS-04: zip text -> state; non-numeric zip gives no state ('')."""
    return state_of(F.trim(col(zip_text)).try_cast("int"))


def state_of(z: Column) -> Column:
    """CLS-04 for a zip number. Give it a column of its own: the ranges name it
    many times."""
    return last_match([(z.between(lo, hi), st) for lo, hi, st in ZIP_STATE_RANGES], "")


def open_indicator_status(ind) -> Column:
    """CLS-05: first-match CASE on the open indicator; unknown -> ''."""
    i = F.coalesce(F.rtrim(col(ind)), F.lit(""))
    return first_match([(i == F.lit(k), v) for k, v in OPEN_INDICATOR_STATUS], "")


def loan_status(npl_ind, arrear_days, note_paid, cur_balance) -> Column:
    """CLS-06: sequential rules, last wins (PAID-OFF > ARREARS > NPL), ACTIVE
    only when nothing else applied and the balance is positive."""
    ad = col(arrear_days)
    return last_match([
        (col(cur_balance) > 0, LOAN_ACTIVE),
        ((F.rtrim(col(npl_ind)) == F.lit("3")) | (ad > 92), LOAN_NPL),
        ((ad > 1) & (ad < 92), LOAN_ARREARS),
        (F.rtrim(col(note_paid)) == F.lit("P"), LOAN_PAID),
    ], "")


def bank_indicator(cost_centre, closed: bool) -> Column:
    """CLS-07: 'I' for the 3000s cost centres, else 'C'. Deposits use open
    bounds, loans closed bounds."""
    c = col(cost_centre)
    inside = (c.between(COST_CENTRE_LOW, COST_CENTRE_HIGH) if closed
              else (c > COST_CENTRE_LOW) & (c < COST_CENTRE_HIGH))
    return F.when(inside, F.lit("I")).otherwise(F.lit("C"))


def match_id(new_found, old_found) -> Column:
    """CLS-08: watch-list flags -> struct(hold_ind, match_id)."""
    n, o = col(new_found), col(old_found)
    return F.when(n & o, F.struct(F.lit("Y").alias("hold_ind"), F.lit("B").alias("match_id"))) \
        .when(n, F.struct(F.lit("Y").alias("hold_ind"), F.lit("N").alias("match_id"))) \
        .when(o, F.struct(F.lit("Y").alias("hold_ind"), F.lit("O").alias("match_id"))) \
        .otherwise(F.struct(F.lit("N").alias("hold_ind"), F.lit("X").alias("match_id")))


def loan_code_text(code) -> Column:
    """CLS-09: A / P / N -> text, else UNKNOWN."""
    c = col(code)
    return first_match([(c == F.lit(k), v) for k, v in LOAN_CODE_TEXT], LOAN_CODE_OTHER)

"""Parties with personal accounts (PIPE-03).

The relationship search file is split on the *second* party's type (byte 55:
O organisation, I individual) in one pass; organisation rows are joined to
the personal accounts of that party (all pairs of equal keys); the result is
stacked with the individual rows and written in two layouts (fixed-width and
all-quoted with a literal trailer) from one computed frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith.operators.dedup import seq_of
from recsmith.operators.reshape import route
from recsmith.session import materialize
from recsmith.sinks.writers import quoted_line
from recsmith.sources.layout import Layout

REL_COLUMNS = ["CUSTNO1", "CUSTTYPE1", "RLENCODE1", "DESC1", "CUSTNO", "CUSTTYPE", "RLENCODE",
               "DESC", "CUSTNAME1", "ALIAS1", "CUSTNAME", "ALIAS"]

PARTY_LAYOUT = Layout.of([
    ("CUSTNO1", 1, 11), ("CUSTTYPE1", 15, 1), ("RLENCODE1", 20, 3), ("DESC1", 25, 15),
    ("CUSTNO", 40, 11), ("CUSTTYPE", 55, 1), ("RLENCODE", 60, 3), ("DESC", 65, 15),
    ("ACCTCODE", 80, 5), ("ACCTNO", 85, 20), ("CUSTNAME1", 105, 40), ("ALIAS1", 145, 20),
    ("CUSTNAME", 165, 40), ("ALIAS", 205, 20),
], lrecl=300)

# Input records of the job: the search file's records and the personal accounts.
SEARCH_LAYOUT = Layout.of([
    ("CUSTNO1", 1, 11), ("CUSTTYPE1", 15, 1), ("RLENCODE1", 20, 3), ("DESC1", 25, 15), ("CUSTNO", 40, 11), ("CUSTTYPE", 55, 1),
    ("RLENCODE", 60, 3), ("DESC", 65, 15), ("CUSTNAME1", 95, 40), ("ALIAS1", 135, 20), ("CUSTNAME", 155, 40), ("ALIAS", 195, 20),
], lrecl=300)
ACCOUNT_LAYOUT = Layout.of([("ACCTNO", 5, 20), ("ACCTCODE", 25, 5), ("CUSTNO", 46, 11)], lrecl=56)

# The writer's separator overwrites the eleventh byte of the first field, so the
# quoted record holds ten characters of CUSTNO1.
QUOTED_WIDTHS = [("CUSTNO1", 10), ("CUSTTYPE1", 1), ("RLENCODE1", 3), ("DESC1", 15), ("CUSTNO", 11),
                 ("CUSTTYPE", 1), ("RLENCODE", 3), ("DESC", 15), ("ACCTCODE", 5), ("ACCTNO", 20),
                 ("CUSTNAME1", 40), ("ALIAS1", 20), ("CUSTNAME", 40), ("ALIAS", 20)]
TRAILER = ", \\N"


def parties_with_accounts(rel: DataFrame, accounts: DataFrame) -> DataFrame:
    """``rel``: the relationship columns; ``accounts``: ACCTNO, ACCTCODE, CUSTNO.

    One pass over ``rel``: rows are tagged with their route, only organisation
    rows look accounts up (all pairs of equal keys), and organisation rows
    without an account go."""
    routed = route(rel.select(*REL_COLUMNS, *seq_of(rel)), {"ORG": F.col("CUSTTYPE") == "O",
                                              "IND": F.col("CUSTTYPE") == "I"}, "_route")
    acc = accounts.select(F.col("CUSTNO").alias("_custno"), "ACCTNO", "ACCTCODE", F.lit(True).alias("_found"))
    org = F.col("_route") == "ORG"
    out = routed.join(acc, (F.col("CUSTNO") == F.col("_custno")) & org, "left").where(~org | F.col("_found"))
    return out.select(*REL_COLUMNS, F.coalesce("ACCTCODE", F.lit("")).alias("ACCTCODE"),
                      F.coalesce("ACCTNO", F.lit("")).alias("ACCTNO"), *seq_of(rel))


def party_order(rows: DataFrame) -> list:
    """The files' order: organisations by customer and account, then individuals by
    customer; equal ones as read."""
    org = F.col("CUSTTYPE") == "O"
    return [(~org).cast("int"), F.col("CUSTNO"), F.col("ACCTCODE"), F.col("ACCTNO"), *[F.col(c) for c in seq_of(rows)]]


def party_files(rel: DataFrame, accounts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both layouts, from one computed and stored frame."""
    rows = materialize(parties_with_accounts(rel, accounts), "parties")
    return fixed_layout(rows), quoted_layout(rows)


def fixed_layout(df: DataFrame) -> DataFrame:
    return df.select(PARTY_LAYOUT.render_expr().alias("value"))


def quoted_layout(df: DataFrame) -> DataFrame:
    """Every field padded to its width and quoted; literal ``, \\N`` trailer."""
    return df.select(quoted_record().alias("value"))


def quoted_record() -> Column:
    cols = [F.rpad(F.coalesce(F.col(c), F.lit("")), w, " ") for c, w in QUOTED_WIDTHS]
    return quoted_line(cols, ",", TRAILER)

"""Business-account owners (PIPE-06).

account relationships (several files, one input) -> application code from
the account prefix -> keep primary owners (PRISEC 901) -> match with the
customer-to-customer relationships read as stored *and* flipped -> unique
owner records (first 150 bytes of the rendered record, first kept).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith.functions.rules import account_prefix_code
from recsmith.functions.strings import eq_padded
from recsmith.operators.reshape import symmetrise
from recsmith.sources.layout import Layout

# Output record of the owner file (150 bytes).
OWNER_LAYOUT = Layout.of([
    ("ACCTCODE", 1, 5), ("ACCTNOC", 6, 20), ("RLENCODE", 26, 3), ("CUSTNO", 29, 11),
    ("CODE1", 40, 3), ("CUSTNO2", 43, 11), ("CODE2", 54, 3),
], lrecl=150)

# Input record of the account-relationship files.
ACCOUNT_REL_LAYOUT = Layout.of([
    ("ACCTNOC", 1, 11), ("ACCTNOR", 1, 2), ("CUSTNO", 13, 11), ("RLENCODE", 25, 3),
    ("PRISEC", 28, 3),
])

# Input record of the customer-to-customer relationship file.
CUST_REL_LAYOUT = Layout.of([("CUST1", 1, 11), ("CODE1", 21, 3), ("CUST2", 24, 11),
                             ("CODE2", 44, 3)])


def primary_accounts(acct_rel: DataFrame) -> DataFrame:
    """Accounts with their application code, primary owners only."""
    return (acct_rel.filter(eq_padded("PRISEC", "901"))
            .select(account_prefix_code("ACCTNOC").alias("ACCTCODE"),
                    F.substring("ACCTNOC", 1, 20).alias("ACCTNOC"),
                    F.substring("CUSTNO", 1, 11).alias("CUSTNO"),
                    F.substring("RLENCODE", 1, 3).alias("RLENCODE")))


def distinct_edges(cust_rel: DataFrame) -> DataFrame:
    """Customer relationships as rendered, one per pair of sides whichever way it was
    stored: the side that sorts first stands first. ``JOINS1``, ``JOINS2``: can that side's
    customer meet an account? A missing number and one that is longer than its field cannot, though
    both are rendered as the second customer.

    Read both ways, an edge and its flipped copy are the same two rows, so the dedup is
    done on the edges and their two directions are formed after it."""
    def side(n: int) -> Column:
        key, field = F.rtrim(f"CUST{n}"), F.rtrim(F.substring(F.coalesce(f"CUST{n}", F.lit("")), 1, 11))
        code = F.rtrim(F.substring(F.coalesce(f"CODE{n}", F.lit("")), 1, 3))
        return F.struct(field.alias("CUST"), code.alias("CODE"), (F.coalesce(key, F.lit("-")) == field).alias("JOINS"))

    sides = cust_rel.select(F.sort_array(F.array(side(1), side(2))).alias("_s"))
    one, two = F.col("_s")[0], F.col("_s")[1]
    edges = sides.select(one["CUST"].alias("CUST1"), one["CODE"].alias("CODE1"), two["CUST"].alias("CUST2"), two["CODE"].alias("CODE2"),
                         one["JOINS"].alias("JOINS1"), two["JOINS"].alias("JOINS2"))
    # Dealt out before the dedup: a stored edge rarely repeats, and the tables of what a task has seen
    # stay as small as the number of shuffle partitions makes them.
    sides = ["CUST1", "CODE1", "CUST2", "CODE2"]
    parts = int(cust_rel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return edges.repartition(parts, *sides).groupBy(*sides).agg(F.max("JOINS1").alias("JOINS1"), F.max("JOINS2").alias("JOINS2"))


def both_directions(edges: DataFrame) -> DataFrame:
    """Edges as stored plus flipped (V11: both are read), from the sides that can meet an account; an
    edge that is its own flipped copy stands once."""
    same = (F.col("CUST1") == F.col("CUST2")) & (F.col("CODE1") == F.col("CODE2"))
    edges = edges.withColumns({"JOINS1": F.col("JOINS1") | (same & F.col("JOINS2")), "JOINS2": F.col("JOINS2") & ~same})
    sym = symmetrise(edges, [("CUST1", "CUST2"), ("CODE1", "CODE2"), ("JOINS1", "JOINS2")])
    return sym.where("JOINS1").select(F.col("CUST1").alias("CUSTNO"), "CODE1", F.col("CUST2").alias("CUSTNO2"), "CODE2")


def account_owners(acct_rel: DataFrame, cust_rel: DataFrame, with_record: bool = False
                   ) -> DataFrame:
    """Owner records, one per distinct rendered record.

    The match is an equi-join on CUSTNO (all pairs of equal keys, as the
    relational join it is). Every output field lies inside the 150-byte dedup
    window, so "first record per 150-byte key" is a distinct over the rendered
    values. The record holds every rendered column of both sides and the key
    as rendered on the account side, so distinct rows of the join are exactly
    the pairs of distinct rendered rows of each side: the dedup runs on the
    inputs, and the join output (which fans out) is never aggregated. Keys
    compare blank-padded (right-trimmed), as fixed-width fields do; a missing
    key matches nothing.
    """
    acct_side = ["ACCTCODE", "ACCTNOC", "RLENCODE", "CUSTNO"]
    acc = primary_accounts(acct_rel).filter(F.col("CUSTNO").isNotNull())
    acc = acc.select(*OWNER_LAYOUT.rendered_values(150, acct_side)).distinct()
    rel = both_directions(distinct_edges(cust_rel))
    # Each side is deduplicated on all its columns (an even shuffle); the join
    # then has its own exchange on CUSTNO, where AQE can split a hot customer.
    out = acc.join(rel, "CUSTNO").select(*OWNER_LAYOUT.names)
    if with_record:
        out = out.withColumn("record", OWNER_LAYOUT.render_expr())
    return out

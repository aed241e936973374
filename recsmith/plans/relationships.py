"""Customer-to-customer relationships (PIPE-01, PIPE-02).

PIPE-01 enriches every relationship on both sides: code description, party
type and name, alias (positional match-merge: aliases are not unique per
customer), old id and group code. PIPE-02 builds the search file: the
both-sides records plus their flipped copies, expired ones dropped, first
record per 150-byte key kept, and every record of a duplicated key listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.functions.blanks import is_blank
from recsmith.functions.dates import format_date
from recsmith.functions.strings import zero_pad
from recsmith.operators.dedup import all_duplicates, first_per_key, first_record, seq_of
from recsmith.operators.filters import not_expired
from recsmith.operators.joins import lookup, match_merge
from recsmith.session import materialize
from recsmith.sources.layout import Layout
from recsmith.sources.readers import SEQ

# Both-sides / search record (300 bytes).
BOTH_LAYOUT = Layout.of([
    ("CUSTNO1", 1, 11), ("INDORG1", 15, 1), ("CODE1", 20, 3), ("DESC1", 25, 15),
    ("CUSTNO2", 40, 11), ("INDORG2", 55, 1), ("CODE2", 60, 3), ("DESC2", 65, 15),
    ("EXPDATE", 80, 10, "d"), ("CUSTNAME1", 95, 40), ("ALIAS1", 135, 20),
    ("CUSTNAME2", 155, 40), ("ALIAS2", 195, 20), ("OLDIC1", 215, 9),
    ("BASICGRPCODE1", 225, 3), ("OLDIC2", 228, 9), ("BASICGRPCODE2", 238, 3),
    ("EFFDATE", 242, 8),
], lrecl=300)

# Input records of the job: relationships (binary, packed decimals), and the text files it looks up.
REL_LAYOUT = Layout.of([("CUSTNO", 5, 11), ("EFFDATE", 32, 5, "p"), ("CUST2", 46, 11), ("CODE1", 66, 2, "p"),
                        ("CODE2", 68, 2, "p"), ("EXPDATE1", 81, 10)], lrecl=90)
CODE_LAYOUT = Layout.of([("TYPE", 5, 2), ("CODE", 10, 3, "n"), ("DESC", 40, 15)], lrecl=54)
CUSTOMER_LAYOUT = Layout.of([("CUSTNO", 5, 11), ("OLDIC", 36, 9), ("BASICGRPCODE", 242, 3)], lrecl=244)
NAME_LAYOUT = Layout.of([("CUSTNO", 5, 11), ("INDORG", 52, 1), ("CUSTNAME", 89, 40)], lrecl=128)
ALIAS_LAYOUT = Layout.of([("CUSTNO", 5, 11), ("ALIAS", 89, 20)], lrecl=108)

SIDE_PAIRS = [("CUSTNO1", "CUSTNO2"), ("INDORG1", "INDORG2"), ("CODE1", "CODE2"),
              ("DESC1", "DESC2"), ("CUSTNAME1", "CUSTNAME2"), ("ALIAS1", "ALIAS2"),
              ("OLDIC1", "OLDIC2"), ("BASICGRPCODE1", "BASICGRPCODE2")]

KEY_WIDTH = 150


def _merge_aliases(rel: DataFrame, aliases: DataFrame, party: str, side: str,
                   order: list[str], histogram: DataFrame) -> DataFrame:
    """Alias file by position (aliases are not unique per customer), in its input order.
    ``ALIASNO<side>``: the position, if the relationships carry their input order."""
    a = aliases.select(F.col("CUSTNO").alias(party), F.col("ALIAS").alias("ALIAS" + side),
                       *[F.col(c).alias("_aseq" + side) for c in seq_of(aliases)])
    parties = histogram.select(party).union(a.select(party))
    merged = match_merge(rel, a, party, order, ["_aseq" + side] if seq_of(aliases) else ["ALIAS" + side], keep="left",
                         histogram=parties)
    merged = merged.withColumnRenamed("slot", "ALIASNO" + side) if seq_of(rel) else merged.drop("slot")
    return merged.drop("in_left", "in_right", "_aseq" + side)


def _lookup_side(rel: DataFrame, party: str, code: str, side: str, codes: DataFrame,
                 names: DataFrame, customers: DataFrame) -> DataFrame:
    """One side: code table, name file, customer file (each unique per key)."""
    c = codes.select(F.col("CODE").alias(code), F.col("DESC").alias("DESC" + side))
    out = lookup(rel, c, code)
    n = names.select(F.col("CUSTNO").alias(party), F.col("INDORG").alias("INDORG" + side),
                     F.col("CUSTNAME").alias("CUSTNAME" + side))
    out = lookup(out, n, party)
    cu = customers.select(F.col("CUSTNO").alias(party), F.col("OLDIC").alias("OLDIC" + side),
                          F.col("BASICGRPCODE").alias("BASICGRPCODE" + side))
    return lookup(out, cu, party)


def enrich_both_sides(rel: DataFrame, codes: DataFrame, names: DataFrame, aliases: DataFrame,
                      customers: DataFrame) -> DataFrame:
    """PIPE-01. ``rel``: CUSTNO, CUST2, CODE1, CODE2 (numbers), EFFDATE (number),
    EXPDATE1 (text). Rows with a non-blank expiry are dropped on read, so
    EXPDATE is always missing afterwards (the specification's behaviour).

    Each side is enriched with its code description, party type and name,
    alias (positional match-merge), old id and group code. The side-2 merge
    runs in the order (CODE2, CUSTNO1, CODE1, EFFDATE, DESC1, INDORG1,
    CUSTNAME1, ALIAS1, OLDIC1, BASICGRPCODE1). The code, name and customer
    lookups are made unique per key, so DESC1 follows from CODE1 and the
    others from CUSTNO1: they never break a tie, and the order is (CODE2,
    CUSTNO1, CODE1, EFFDATE, ALIAS1). Both positional merges therefore run
    on the narrow relationship rows, and the left lookups (which keep every
    row) are added afterwards. Frames read from record files with their
    sequence are ordered by it where the specification keeps input order."""
    rel = rel.filter(is_blank("EXPDATE1")).select(
        F.col("CUSTNO").alias("CUSTNO1"), F.col("CUST2").alias("CUSTNO2"), "CODE1", "CODE2", "EFFDATE", *seq_of(rel))
    codes_u = first_record(codes, "CODE", "CODE", "DESC")
    names_u = first_record(names, "CUSTNO", "CUSTNO", "INDORG", "CUSTNAME")
    cust_u = first_record(customers, "CUSTNO", "CUSTNO", "OLDIC", "BASICGRPCODE")
    # Records are sorted by code, then by customer, each sort keeping what stood before: within
    # a customer by code, then as read; on the second side by its code, then in the
    # order the first side was written in.
    first, second = ["CODE1", "CUSTNO2", "CODE2", "EFFDATE"], ["CODE2", "CUSTNO1", "CODE1", "EFFDATE", "ALIAS1"]
    if seq_of(rel):
        first, second = ["CODE1", SEQ], ["CODE2", "CUSTNO1", "CODE1", SEQ, "ALIASNO1"]
    merged = _merge_aliases(rel, aliases, "CUSTNO1", "1", first, rel)
    merged = _merge_aliases(merged, aliases, "CUSTNO2", "2", second, rel)
    both = _lookup_side(merged, "CUSTNO1", "CODE1", "1", codes_u, names_u, cust_u)
    both = _lookup_side(both, "CUSTNO2", "CODE2", "2", codes_u, names_u, cust_u)
    text = {c: F.coalesce(F.col(c), F.lit("")) for c in
            ["INDORG1", "DESC1", "CUSTNAME1", "ALIAS1", "OLDIC1", "BASICGRPCODE1",
             "INDORG2", "DESC2", "CUSTNAME2", "ALIAS2", "OLDIC2", "BASICGRPCODE2"]}
    return both.select(
        "CUSTNO1", text["INDORG1"].alias("INDORG1"), zero_pad("CODE1", 3).alias("CODE1"),
        text["DESC1"].alias("DESC1"), "CUSTNO2", text["INDORG2"].alias("INDORG2"),
        zero_pad("CODE2", 3).alias("CODE2"), text["DESC2"].alias("DESC2"),
        F.lit(None).cast("date").alias("EXPDATE"),
        *[text[c].alias(c) for c in ["CUSTNAME1", "ALIAS1", "CUSTNAME2", "ALIAS2", "OLDIC1",
                                     "BASICGRPCODE1", "OLDIC2", "BASICGRPCODE2"]],
        zero_pad("EFFDATE", 8).alias("EFFDATE"))


def _searchable(both: DataFrame, run_date: str) -> DataFrame:
    """Stored and flipped records (source 1 and 2), expired ones dropped.
    One pass: each both-sides row is exploded into its two records, so the
    enrichment upstream is computed once, not once per union branch."""
    both = both.filter(not_expired("EXPDATE", run_date))
    swap = {}
    for a, b in SIDE_PAIRS:
        swap[a], swap[b] = b, a
    cols = both.columns
    stored = F.struct(F.lit(1).alias("_src"), *[F.col(c).alias(c) for c in cols])
    flipped = F.struct(F.lit(2).alias("_src"), *[F.col(swap.get(c, c)).alias(c) for c in cols])
    recs = both.select(F.explode(F.array(stored, flipped)).alias("_r")).select("_r.*")
    return recs.withColumn("record", BOTH_LAYOUT.render_expr()) \
        .withColumn("_key", F.substring("record", 1, KEY_WIDTH))


def search_file(both: DataFrame, run_date: str) -> DataFrame:
    """PIPE-02 search file: first record per 150-byte key (stored rows before
    flipped rows, then record text)."""
    recs = _searchable(both, run_date)
    first = first_per_key(recs.select("_key", "_src", "record"), "_key", ["_src", "record"])
    return first.select("record")


def duplicate_file(both: DataFrame, run_date: str) -> DataFrame:
    """PIPE-02 duplicate list: every record whose 150-byte key repeats. The records
    are read twice (counts, then rows), so they are computed and stored once."""
    recs = materialize(_searchable(both, run_date).select("_key", "record"), "search-records")
    return all_duplicates(recs, ["_key"]).select("record")

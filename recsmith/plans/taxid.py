"""Tax-id watch-list match (PIPE-09).

Watch-list ids (two columns per record) are stacked into one distinct list.
Each customer's old id records are merged by position with the new id records
(left; a customer may have several of either, and every new id is tested), the
business registration is copied for organisations, and two existence flags
are set: new id (characters 4-23) on the list, old id on the list. The flag
pair becomes the hold indicator and the match type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.functions.numbers import copy_when
from recsmith.functions.rules import match_id
from recsmith.operators.dedup import seq_of, union_distinct
from recsmith.operators.joins import flag_join, match_merge
from recsmith.sources.layout import Layout

TAX_LAYOUT = Layout.of([("CUSTNO", 1, 11), ("OLDIC", 12, 20), ("NEWIC", 32, 23), ("BUSREG", 55, 23),
                        ("CUSTBRCH", 78, 5), ("RHOLD_IND", 83, 1), ("MATCHID", 84, 1)], lrecl=133)


def watch_ids(watch: DataFrame) -> DataFrame:
    """ID1 and ID2 stacked, blanks dropped, distinct (DED-07)."""
    return union_distinct(watch, ["ID1", "ID2"], "ALIAS")


def tax_matches(old: DataFrame, new: DataFrame, watch: DataFrame) -> DataFrame:
    """``old``: CUSTNO, INDORG, OLDIC, CUSTBRCH; ``new``: CUSTNO, NEWIC;
    ``watch``: ID1, ID2."""
    ids = watch_ids(watch)
    old = old.select("CUSTNO", "INDORG", "OLDIC", "CUSTBRCH", *[F.col(c).alias("_oseq") for c in seq_of(old)])
    new = new.select("CUSTNO", "NEWIC", *[F.col(c).alias("_nseq") for c in seq_of(new)])
    tax = match_merge(old, new, "CUSTNO", ["_oseq"] if "_oseq" in old.columns else ["INDORG", "OLDIC", "CUSTBRCH"],
                      ["_nseq"] if "_nseq" in new.columns else ["NEWIC"], keep="left").drop("slot", "in_left", "in_right")
    tax = tax.withColumns({
        "NEWIC": F.coalesce("NEWIC", F.lit("")),
        "BUSREG": F.coalesce(copy_when(F.col("INDORG") == "O", "NEWIC"), F.lit("")),
        "NEWIC1": F.rtrim(F.substring(F.coalesce("NEWIC", F.lit("")), 4, 20)),
    })
    tax = flag_join(tax, ids, ["NEWIC1"], ["ALIAS"], flag="C")
    tax = flag_join(tax, ids, ["OLDIC"], ["ALIAS"], flag="F")
    m = match_id("C", "F")
    return tax.select("CUSTNO", "OLDIC", "NEWIC", "BUSREG", "CUSTBRCH",
                      m["hold_ind"].alias("RHOLD_IND"), m["match_id"].alias("MATCHID"))

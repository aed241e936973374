"""Daily individual and organisation masters (PIPE-04).

main file split on GENDER (individuals: everything except 'O', blank kept;
organisations: 'O') -> detail file left-merged with the account links on
(CUSTNO, IDTYPE, ID) -> inner merge with the main record on CUSTNO, the
detail's same-named fields (e.g. BRANCH) overwriting the main's. The result
is laid out for keyed lookup as a bucketed, sorted table (SNK-11) instead of
a secondary index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.operators.joins import lookup, overlay_merge
from recsmith.operators.reshape import split
from recsmith.sinks.writers import write_bucketed

DETAIL_KEYS = ["CUSTNO", "IDTYPE", "ID"]


def split_main(main: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(individuals, organisations); the parts always add up to the input."""
    orgs, indvs = split(main, F.col("GENDER") == "O")
    return indvs, orgs


def daily_master(main_part: DataFrame, detail: DataFrame, links: DataFrame) -> DataFrame:
    info = lookup(detail, links, DETAIL_KEYS)
    return overlay_merge(main_part, info, "CUSTNO", how="inner")


def daily_masters(main: DataFrame, indv: DataFrame, org: DataFrame, links: DataFrame
                  ) -> tuple[DataFrame, DataFrame]:
    indvs, orgs = split_main(main)
    return daily_master(indvs, indv, links), daily_master(orgs, org, links)


def write_masters(indvs: DataFrame, orgs: DataFrame, indv_table: str, org_table: str, buckets: int,
                  paths: tuple[str, str] | None = None) -> None:
    """Both masters as tables laid out for lookup: the individuals' by customer,
    id type and id, the organisations' by customer. Joins on CUSTNO with a table
    of the same bucketing need no shuffle."""
    for df, name, keys, path in zip((indvs, orgs), (indv_table, org_table), (["CUSTNO", "IDTYPE", "ID"], ["CUSTNO"]),
                                    paths or (None, None)):
        write_bucketed(df, name, ["CUSTNO"], buckets, keys, path=path)

"""Keyed point lookups (SNK-11, SRC-15): a table bucketed and sorted by its key, with a
Parquet bloom filter on the key columns, so that reading a few keys touches the buckets and the row
groups that can hold them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Keys that are looked up by pruning; more are joined.
MAX_KEYS = 1000


def write_keyed(df: DataFrame, table: str, key: str, buckets: int, sort: Sequence[str] = (), blooms: Sequence[str] = (),
                path: str | None = None, row_group: int | None = None) -> None:
    """Write ``df`` as ``table``, bucketed by ``key`` and sorted by it and ``sort`` in each bucket. ``blooms``:
    further columns with a bloom filter (the key always has one). A bucket is one file, however
    many tasks there are."""
    rows = df.repartition(buckets, key)
    w = rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *[c for c in sort if c != key])
    for c in dict.fromkeys([key, *blooms]):
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if row_group:
        w = w.option("parquet.block.size", str(row_group)).option("parquet.page.size", str(max(row_group // 8, 1024)))
    if path:
        w = w.option("path", path)
    w.format("parquet").saveAsTable(table)


def lookup_rows(spark: SparkSession, table: str, key: str, wanted: DataFrame, max_keys: int = MAX_KEYS) -> DataFrame:
    """Rows of ``table`` whose ``key`` is in ``wanted`` (its column of that name). Up to ``max_keys`` keys become a
    filter, which prunes buckets, row groups and bloom filters; more are a semi join, which
    does not shuffle the table. Missing keys match nothing."""
    keys = [r[0] for r in wanted.select(key).where(F.col(key).isNotNull()).distinct().limit(max_keys + 1).collect()]
    rows = spark.table(table)
    if len(keys) <= max_keys:
        return rows.where(F.col(key).isin(keys)) if keys else rows.limit(0)
    return rows.join(wanted.select(key).distinct(), key, "left_semi")

"""Query catalogue: every operator / job run over the given test tables, each
with a DuckDB SQL twin used as the correctness oracle.

A query is ``fn(spark, sf_dir) -> DataFrame``; its twin is plain SQL over the
views ``region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations``. Column names
and types are aligned on both sides (counts and row numbers are ``bigint``,
money ``decimal(18,2)``).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}
COVERS: dict[str, str] = {}


def query(name: str, covers: str = "", sql: str | None = None):
    """Register a catalogue query; ``sql`` is the DuckDB twin (None when the
    operation has no SQL form, e.g. writes)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        COVERS[name] = covers
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

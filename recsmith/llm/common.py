"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

import recsmith
from recsmith.session import materialize

# Rows and bytes of one Arrow batch handed to Python: documents can be very
# long, so the bytes bound the memory of a Python worker.
ARROW_ROWS = 4096
ARROW_BYTES = 4 << 20


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows and bytes of one Arrow batch for the Python stages of this session,
    and send this package to the executors once per application."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    sc = spark.sparkContext
    if not getattr(sc, "_recsmith_sent", False):
        home = os.path.dirname(os.path.abspath(recsmith.__file__))
        to = os.path.join(tempfile.mkdtemp(prefix="recsmith-"), "recsmith")
        sc.addPyFile(shutil.make_archive(to, "zip", os.path.dirname(home), os.path.basename(home)))
        sc._recsmith_sent = True


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: cuts
    the lineage there, so a lost executor costs at most one stage again."""
    return materialize(df, name)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
                schema: str, rows: int = ARROW_ROWS) -> DataFrame:
    """``mapInArrow`` for a function of one batch; batches without rows are skipped."""
    small_batches(df.sparkSession, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                out = fn(b)
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(col) -> F.Column:
    """64-bit key of a nullable text, null and empty apart."""
    return F.xxhash64(F.coalesce(col, F.lit("\0null")))

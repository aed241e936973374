"""Readers (SRC-*). All return lazy DataFrames; nothing is collected except the
one-row control date.

Record sequence: readers of files take ``sequence=<column>`` and then carry where each
record stands in the input, as a struct that sorts in input order: number of the
path as given, file name, first byte of the split, place inside the split. Splits
are read in parallel and in any order; the struct says which record came first."""

from __future__ import annotations

import json
import os
import re
from typing import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recsmith.session import materialize
from recsmith.sources.layout import Layout
from recsmith.sources.recordfile import LONG_BYTES, SEQUENCE, RecordFiles

# The sequence column of frames that readers and plans pass on.
SEQ = "_seq"


class Catalog:
    """SRC-02: logical dataset name -> storage path (or a table name).

    ``load(name)`` reads Parquet; ``columns`` prunes the scan (SRC-03)."""

    def __init__(self, spark: SparkSession, paths: dict[str, str] | None = None,
                 root: str | None = None):
        self.spark = spark
        self.paths = dict(paths or {})
        self.root = root

    def path(self, name: str) -> str:
        if name in self.paths:
            return self.paths[name]
        if self.root is None:
            raise KeyError(name)
        return os.path.join(self.root, f"{name}.parquet")

    def load(self, name: str, columns: Sequence[str] | None = None) -> DataFrame:
        df = self.spark.read.parquet(self.path(name))
        return df.select(*columns) if columns else df


def read_parquet(spark: SparkSession, path: str | Sequence[str],
                 columns: Sequence[str] | None = None) -> DataFrame:
    """SRC-01/03/12: one or several Parquet paths read as one input."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC-15: a persisted (catalogued) table."""
    return spark.table(name)


def latest_generation(df: DataFrame, gen_col: str = "generation") -> DataFrame:
    """SRC-13: rows of the newest generation only (``GDG(0)``).

    For a ``generation=`` partitioned layout the newest value comes from the
    folder listing (no data is read) and the literal filter prunes all other
    folders; otherwise from one aggregate. Without rows the result is empty."""
    kind = df.schema[gen_col].dataType.simpleString()
    names = [re.search(rf"/{re.escape(gen_col)}=([^/]*)/", f) for f in df.inputFiles()]
    if names and all(names):
        values = [unquote(m[1]) for m in names if m[1] != "__HIVE_DEFAULT_PARTITION__"]
        newest = max(values, key=int if kind in ("int", "bigint", "smallint", "tinyint") else str, default=None)
    else:
        newest = df.agg(F.max(gen_col)).first()[0]
    return df.filter(F.col(gen_col) == F.lit(newest).cast(kind))


def control_date(df: DataFrame, y: str = "YY", m: str = "MM", d: str = "DD") -> str:
    """SRC-14: the run date from a one-record control file, as ``yyyy-MM-dd``.

    This is the only driver-side read: one row, bounded by construction."""
    row = df.select(F.format_string("%04d-%02d-%02d", F.col(y).cast("int"),
                                    F.col(m).cast("int"), F.col(d).cast("int"))
                    .alias("d")).limit(1).collect()
    if not row:
        raise ValueError("control file is empty")
    return row[0]["d"]


def _located(scan: DataFrame, number: int, columns: Sequence[str], sequence: str) -> DataFrame:
    """A file scan with its record sequence. The generated id grows along a split, as
    a split is read by one task from its first record to its last."""
    return scan.select(*columns, F.struct(
        F.lit(number).alias("input"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias(sequence))


def _each_path(path: str | Sequence[str], scan, columns: Sequence[str], sequence: str | None) -> DataFrame:
    """One scan of all paths, or one per path where the sequence must tell them apart."""
    paths = [path] if isinstance(path, str) else list(path)
    if sequence is None:
        return scan(paths)
    return union_inputs(_located(scan([p]), i, columns, sequence) for i, p in enumerate(paths))


def read_lines(spark: SparkSession, path: str | Sequence[str], sequence: str | None = None) -> DataFrame:
    """Text lines as ``value``, with their sequence."""
    return _each_path(path, spark.read.text, ["value"], sequence)


def record_numbers(df: DataFrame, sequence: str = SEQ, name: str = "line_no") -> DataFrame:
    """1-based record number in input order of a frame that a reader gave with its
    sequence and of which no row was dropped. Records are numbered inside their split;
    one row per split is summed up and broadcast. Nothing is sorted or shuffled. The frame is
    stored once, so that both passes see the same ids."""
    rows = materialize(df, "records")
    s = F.col(sequence)
    splits = rows.groupBy(s["input"].alias("_i"), s["file"].alias("_f"), s["block"].alias("_b")).agg(
        F.min(s["row"]).alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_i", "_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("_i", "_f", "_b", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    here = (s["input"] == F.col("_i")) & (s["file"] == F.col("_f")) & (s["block"] == F.col("_b"))
    out = rows.join(F.broadcast(splits), here)
    return out.select(*df.columns, (F.col("_off") + s["row"] - F.col("_first") + 1).alias(name))


def read_fixed_text(spark: SparkSession, path: str | Sequence[str], layout: Layout,
                    sequence: str | None = None) -> DataFrame:
    """SRC-04/05/07/08/10: fixed-width text records decoded by a Layout.
    Text files split on line boundaries, so the scan is fully parallel."""
    return layout.decode(read_lines(spark, path, sequence), keep=[sequence] if sequence else [])


def read_fixed_binary(spark: SparkSession, path: str | Sequence[str], lrecl: int, layout: Layout,
                      columns: Sequence[str] | None = None, where: dict[str, Sequence] | None = None,
                      sequence: str | None = None, split: int | None = None) -> DataFrame:
    """SRC-06/11: fixed-length binary records (packed decimals).

    The reader splits files on record boundaries and decodes only ``columns``.
    ``where`` is the record-type test: accepted values per header field (packed numbers
    unscaled); the other fields of records that fail it are not decoded. ``split``: bytes of a split."""
    wanted = [n for n in layout.names if columns is None or n in columns]
    # Of a name declared twice the later field counts.
    last = {f.name: f for f in layout.fields}
    raw = {n: "string" if last[n].kind != "p" or last[n].width > LONG_BYTES else "long" for n in wanted}
    schema = ", ".join([f"`{n}` {t}" for n, t in raw.items()] + [f"`{sequence}` struct<{SEQUENCE}>"] * bool(sequence))
    paths = [path] if isinstance(path, str) else list(path)
    spark.dataSource.register(RecordFiles)
    scan = (spark.read.format("records").schema(schema).option("paths", json.dumps([qualified(spark, p) for p in paths]))
            .option("lrecl", lrecl).option("fields", json.dumps([(f.name, f.start, f.width, f.kind) for f in last.values()]))
            .option("where", json.dumps({k: list(v) for k, v in (where or {}).items()})))
    if split:
        scan = scan.option("split", split)
    return scan.load().select(*[layout.raw_expr(last[n], F.col(n)).alias(n) for n in wanted], *([sequence] if sequence else []))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def decode_when(df: DataFrame, header: Layout, predicate, body: Layout,
                record: str = "value") -> DataFrame:
    """SRC-11: multi-format records. Header fields are decoded first, rows of
    other record types are filtered out, then the body is decoded (the filter
    runs before the body substrings in the same generated stage)."""
    heads = header.decode(df, record=record, keep=[record])
    kept = heads.filter(predicate)
    body_cols = [body.field_expr(f, F.col(record)).alias(f.name) for f in body.fields]
    return kept.select(*header.names, *body_cols)


def read_delimited(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str],
                   sep: str = ";", max_width: dict[str, int] | None = None,
                   quote: str = '"', sequence: str | None = None) -> DataFrame:
    """SRC-09/10: delimited, quoted text; short rows give missing trailing
    fields (PERMISSIVE); values are cut to their declared width."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    df = _each_path(path, spark.read.schema(schema).option("sep", sep).option("quote", quote)
                    .option("mode", "PERMISSIVE").csv, columns, sequence)
    widths = max_width or {}
    return df.select(*[F.coalesce(F.rtrim(F.substring(F.col(c), 1, widths[c]) if c in widths
                                           else F.col(c)), F.lit("")).alias(c)
                       for c in columns], *([sequence] if sequence else []))


def union_inputs(dfs: Iterable[DataFrame]) -> DataFrame:
    """SRC-12: concatenated inputs read as one stream of records."""
    out = None
    for d in dfs:
        out = d if out is None else out.unionByName(d)
    return out

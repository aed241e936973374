"""Writers (SNK-*). Text outputs are built as one string column by native
expressions and written with ``write.text``: no Python row loop."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith.sources.layout import Layout
from recsmith.sources.readers import qualified
from recsmith.sources.recordfile import RecordFiles
from recsmith.operators.positions import global_row_number


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> None:
    """SNK-01/10 (overwrite replaces the previous output on rerun)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True,
              quote_all: bool = False, mode: str = "overwrite") -> None:
    """SNK-02 / SNK-03 (all fields quoted) / SNK-07 (``sep=';'``; money is
    carried as decimal(18,2) so two decimals print without float text)."""
    (df.write.mode(mode).option("sep", sep).option("header", header)
     .option("quoteAll", quote_all).option("escape", '"').csv(path))


def quoted_line(cols: Sequence, sep: str = ",", trailer: str = "") -> Column:
    """SNK-03 with a literal trailer: ``"a","b",...<trailer>`` as one string."""
    q = [F.concat(F.lit('"'), F.coalesce(c if isinstance(c, Column) else F.col(c).cast("string"),
                                         F.lit("")), F.lit('"')) for c in cols]
    return F.concat(F.concat_ws(sep, *q), F.lit(trailer))


def fixed_lines(df: DataFrame, layout: Layout, name: str = "value") -> DataFrame:
    """SNK-04: one fixed-width line per row."""
    return df.select(layout.render_expr().alias(name))


def write_lines(df: DataFrame, path: str, col: str = "value", mode: str = "overwrite", compression: str = "none") -> None:
    df.select(col).write.mode(mode).option("compression", compression).text(path)


def write_records(df: DataFrame, path: str, col: str = "value", compressed: bool = False) -> None:
    """Binary records, one after the other, as parts in partition order; the parts of
    this run replace those of an earlier one when it is committed. ``compressed``: each part is packed, and
    read by one task."""
    spark = df.sparkSession
    spark.dataSource.register(RecordFiles)
    df.select(F.col(col).alias("value")).write.format("records").mode("append").option(
        "compressed", str(compressed).lower()).option("path", qualified(spark, path)).save()


def with_header(body: DataFrame, header_line: str, order: Sequence, name: str = "value",
                line_col: str = "line_no") -> DataFrame:
    """SNK-05/06, WIN-02: a header line followed by the body in ``order``.

    The body is numbered with the range-partitioned global row number (no
    single-task window); the header takes number 0. Writing
    ``orderBy(line_no)`` then yields the file in order, spread over sorted
    part files."""
    numbered = global_row_number(body, order, line_col)
    head = body.sparkSession.range(1).select(
        F.lit(0).cast("long").alias(line_col), F.lit(header_line).alias(name))
    return head.unionByName(numbered.select(line_col, name))


def report_line(cols: Sequence[Column], widths: Sequence[int], sep: str = ";") -> Column:
    """SNK-06: column-aligned, separator-joined report body line."""
    return F.concat_ws(sep, *[F.rpad(F.coalesce(c.cast("string"), F.lit("")), w, " ")
                              for c, w in zip(cols, widths)])


def write_generation(df: DataFrame, base: str, generation: int, fmt: str = "parquet") -> str:
    """SNK-09: write the next generation as its own ``generation=N`` folder
    (dynamic partition overwrite touches only that folder)."""
    path = f"{base}/generation={generation}"
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int,
                   sort_keys: Sequence[str] | None = None, path: str | None = None) -> None:
    """SNK-11: the keyed-lookup layout as a bucketed, sorted table, so later
    joins on ``keys`` need no shuffle."""
    w = df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*(sort_keys or keys))
    if path:
        w = w.option("path", path)
    w.format("parquet").saveAsTable(table)

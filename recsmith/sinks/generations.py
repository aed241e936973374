"""Published generations of ordered files (SNK-08/09/10, SRT-02 with SNK-04, SRC-13).

A generation is one small manifest file that lists, for every output of a run, its
part files in record order with their record counts and their first and last records. Outputs are
written to a folder of their run first; the manifest is then moved into place in one step. Readers
go by manifests only, so they see the generation before or the one after, never part of one, and
all outputs of a run appear together or not at all. What a failed run or a repeated task leaves
behind is in no manifest. Publishing under an existing number replaces that
generation; with ``keep`` older ones roll off.

An output is written in order by range-partitioning and sorting its lines; part ``n`` holds the
``n``-th range, so the parts, one after the other, are the sorted file. The order should be total.
Lines that are rendered from narrower columns may be given as those columns and the rendering: then the
columns are dealt out and sorted, and lines exist only as they are written. Parts are plain text, or
compressed where the caller says so: records are mostly blanks.
All file operations go through the storage that Spark itself reaches."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recsmith.session import materialize
from recsmith.sources.readers import SEQ, record_numbers
from recsmith.sources.recordfile import SEQUENCE

# An output: its lines (column ``value``) and the columns that order them; or rows, the columns that
# order them, and the rendering of a row as a line.
Output = tuple[DataFrame, Sequence] | tuple[DataFrame, Sequence, Column]


def place() -> list[Column]:
    """Where a line stands: its part file, the first byte of its split, its place among the lines of a task."""
    return [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row")]


def padded_number(name) -> Column:
    """Number of a part file, as text that sorts like it."""
    return F.lpad(F.regexp_extract(name, r"part-(\d+)", 1), 10, "0")


class Generations:
    """The generations under one folder. ``keep``: how many stay (None: all). ``compression``: of
    the parts, as Spark's text writer names it ("gzip"); readers tell by the file names."""

    def __init__(self, spark: SparkSession, base: str, keep: int | None = None, compression: str | None = None):
        if keep is not None and keep < 1:
            raise ValueError("at least one generation stays")
        self.spark, self.base, self.keep, self.compression = spark, base.rstrip("/"), keep, compression or "none"
        self._conf, self._hadoop = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs

    # ------------------------------------------------------------- write
    def publish(self, outputs: dict[str, Output], generation: int | None = None) -> int:
        """Write all outputs, then publish them together; returns the number."""
        run = uuid.uuid4().hex
        try:
            parts = {name: self._write(f"{self.base}/data/{run}/{name}", *output) for name, output in outputs.items()}
            number = generation if generation is not None else max(self.numbers(), default=0) + 1
            old = self._manifest(number) if generation is not None and number in self.numbers() else None
            text = json.dumps({"generation": number, "run": run, "outputs": parts})
            self._put(f"{self.base}/generations/{number:010d}.json", text, replace=generation is not None)
        except BaseException:
            self._delete(f"{self.base}/data/{run}")
            raise
        gone = [old] if old else []
        for n in self.numbers()[:-self.keep] if self.keep else []:
            gone.append(self._manifest(n))
            self._delete(self._path(n))
        for m in gone:
            self._delete(f"{self.base}/data/{m['run']}")
        return number

    def publish_from(self, frame: DataFrame, outputs: dict[str, Callable[[DataFrame], Output]],
                     generation: int | None = None) -> int:
        """Outputs that are made of one frame: it is computed and stored once."""
        stored = materialize(frame, "outputs")
        return self.publish({name: make(stored) for name, make in outputs.items()}, generation)

    def _write(self, path: str, lines: DataFrame, order: Sequence, value: Column | None = None) -> list[dict]:
        lines = lines.repartitionByRange(*order).sortWithinPartitions(*order) if order else lines
        lines = lines.select("value" if value is None else value.alias("value"))
        lines.write.mode("error").option("compression", self.compression).text(path)
        # With a set among them the aggregates are kept in a hash table of a row per file; without, Spark
        # sorts all lines by file, as texts have no fixed length.
        written = self.spark.read.text(path).select("value", *place())
        here = F.struct("_block", "_row")
        written = written.groupBy(F.col("_file").alias("file")).agg(
            F.count(F.lit(1)).alias("n"), F.min_by("value", here).alias("first"), F.max_by("value", here).alias("last"),
            F.collect_set(F.lit(1)).alias("_hashed"))
        # One row per part file.
        parts = [{"file": r.file, "records": r.n, "first": r["first"], "last": r["last"]} for r in written.collect()]
        return [{"path": path, **p} for p in sorted(parts, key=lambda p: part_number(p["file"]))]

    # -------------------------------------------------------------- read
    def numbers(self) -> list[int]:
        """Published generations, oldest first."""
        folder = self._hadoop.Path(f"{self.base}/generations")
        fs = folder.getFileSystem(self._conf)
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n[:-5]) for n in names if re.fullmatch(r"\d+\.json", n))

    def manifest(self, back: int = 0) -> dict:
        """Manifest of the newest generation, or of the one ``back`` before it."""
        numbers = self.numbers()
        if back >= len(numbers):
            raise LookupError(f"{self.base} has no generation ({-back})")
        return self._manifest(numbers[-1 - back])

    def read(self, name: str, back: int = 0) -> DataFrame:
        """Lines of an output (``value``) with their record sequence: sorting by it gives
        the file's order, whatever the number of splits."""
        parts = self.manifest(back)["outputs"][name]
        if not parts:
            return self.spark.createDataFrame([], f"value string, {SEQ} struct<{SEQUENCE}>")
        scan = self.spark.read.text([f"{p['path']}/{p['file']}" for p in parts])
        file_name = F.col("_metadata.file_name")
        return scan.select("value", F.struct(
            F.lit(0).alias("input"), F.concat_ws("/", padded_number(file_name), file_name).alias("file"),
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias(SEQ))

    def lines(self, name: str, back: int = 0) -> DataFrame:
        """``line_no`` (from 1) and ``value`` of an output. As ``record_numbers`` of ``read``; the order
        of the parts is made of one row per split, not of every line."""
        parts = self.manifest(back)["outputs"][name]
        if not parts:
            return record_numbers(self.read(name, back)).select("line_no", "value")
        scan = self.spark.read.text([f"{p['path']}/{p['file']}" for p in parts])
        rows = materialize(scan.select("value", *place()), "records")
        splits = rows.groupBy(F.col("_file").alias("_f"), F.col("_block").alias("_b")).agg(
            F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
        before = Window.orderBy(padded_number("_f"), "_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
        splits = splits.select("_f", "_b", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_off"))
        out = rows.join(F.broadcast(splits), (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
        return out.select((F.col("_off") + F.col("_row") + 1).alias("line_no"), "value")

    # ------------------------------------------------------------- files
    def _path(self, number: int) -> str:
        return f"{self.base}/generations/{number:010d}.json"

    def _manifest(self, number: int) -> dict:
        path = self._hadoop.Path(self._path(number))
        stream = path.getFileSystem(self._conf).open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, path: str, text: str, replace: bool) -> None:
        """Write beside ``path``, then move there in one step; without ``replace`` an
        existing file is an error."""
        to = self._hadoop.Path(path)
        new = self._hadoop.Path(to.getParent(), f".{uuid.uuid4().hex}.tmp")
        stream = to.getFileSystem(self._conf).create(new, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        options = getattr(self._hadoop, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(options, 1)
        how[0] = options.OVERWRITE if replace else options.NONE
        context = self._hadoop.FileContext.getFileContext(to.getFileSystem(self._conf).getUri(), self._conf)
        context.rename(new, to, how)

    def _delete(self, path: str) -> None:
        p = self._hadoop.Path(path)
        p.getFileSystem(self._conf).delete(p, True)


def part_number(file: str) -> int:
    return int(re.match(r"part-(\d+)", file)[1])

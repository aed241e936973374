"""Fixed-length binary record files as a Spark data source (SRC-06, SRC-11).

``spark.read.format("records")`` splits files on record boundaries and decodes a record
layout inside the reader, Arrow batch by Arrow batch: only the fields that are asked for, and
after a record-type test only the records that pass it (the header fields of the
others are all that is looked at). ``df.write.format("records")`` writes a ``binary`` column as
such files: every task writes a part under a name of its own, and the commit lists the parts
of successful tasks, in partition order, in ``_manifest.json``. Readers go by that list, so
what a lost or repeated task left behind is never read. Parts may be compressed (zstd): records are mostly
blanks. Such a part is one split, read from its start to its end batch by batch.

Raw values come out of the source: text fields as they stand, packed decimals (``p``) as
unscaled ``long`` (``string`` above 18 digits; missing where the bytes are no packed number).
``readers.read_fixed_binary`` puts scales, trimming and dates on top.

The classes run in Spark's Python workers and use nothing else of this package; they are sent by
value, so a cluster needs no copy of it for them.
"""

from __future__ import annotations

import json
import re
import sys
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MANIFEST = "_manifest.json"
SPLIT_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
# Widest packed decimal whose digits (two a byte, less the sign) fit a long.
LONG_BYTES = 9
# Name's end of a compressed part; its size in the manifest is that of its records.
PACKED_PART = ".zst"
SEQUENCE = "input int, file string, block long, row long"


def open_path(path: str):
    """File system and path inside it; paths without a scheme are local."""
    from pyarrow import fs

    path = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def files_of(path: str) -> list[tuple[str, int]]:
    """Record files of a path (a file or a folder) in order, with their sizes."""
    from pyarrow import fs

    system, base = open_path(path)
    info = system.get_file_info(base)
    if info.type == fs.FileType.File:
        return [(base, info.size)]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    manifest = system.get_file_info(f"{base}/{MANIFEST}")
    if manifest.type == fs.FileType.File:
        with system.open_input_stream(manifest.path) as f:
            return [(f"{base}/{p['file']}", p["bytes"]) for p in json.loads(f.read())["parts"]]
    inside = [f for f in system.get_file_info(fs.FileSelector(base)) if f.type == fs.FileType.File
              and not f.base_name.startswith(("_", "."))]
    return sorted((f.path, f.size) for f in inside)


class Split(InputPartition):
    def __init__(self, number: int, base: str, file: str, start: int, end: int):
        self.number, self.base, self.file, self.start, self.end = number, base, file, start, end


class RecordReader(DataSourceReader):
    def __init__(self, options: dict, names: list[str]):
        self.paths, self.lrecl = json.loads(options["paths"]), int(options["lrecl"])
        self.fields = [tuple(f) for f in json.loads(options["fields"])]
        self.where = json.loads(options.get("where", "{}"))
        self.split = max(self.lrecl, int(options.get("split", SPLIT_BYTES)) // self.lrecl * self.lrecl)
        self.names = names

    def partitions(self) -> list[Split]:
        out = []
        for number, path in enumerate(self.paths):
            for file, size in files_of(path):
                if size % self.lrecl:
                    raise ValueError(f"{file}: {size} bytes are no whole records of {self.lrecl}")
                split = max(size, 1) if file.endswith(PACKED_PART) else self.split
                out += [Split(number, path, file, at, min(at + split, size)) for at in range(0, size, split)]
        # Spark wants a partition even where there are no records.
        return out or [Split(0, self.paths[0], "", 0, 0)]

    def read(self, part: Split):
        if part.start == part.end:
            return
        system, _ = open_path(part.base)
        step = max(1, BATCH_BYTES // self.lrecl) * self.lrecl
        packed_part = part.file.endswith(PACKED_PART)
        # A stream unpacks by the name's end.
        with system.open_input_stream(part.file) if packed_part else system.open_input_file(part.file) as f:
            for at in range(part.start, part.end, step):
                size = min(step, part.end - at)
                data = f.read(size) if packed_part else f.read_at(size, at)
                if len(data) != size:
                    raise OSError(f"{part.file}: cut short at byte {at + len(data)}")
                batch = self.decode(np.frombuffer(data, np.uint8).reshape(-1, self.lrecl), part, at)
                if batch.num_rows:
                    yield batch

    def decode(self, records: np.ndarray, part: Split, at: int) -> pa.RecordBatch:
        fields = {f[0]: f for f in self.fields}
        number = np.arange(len(records)) + at // self.lrecl
        if self.where:
            keep = np.ones(len(records), bool)
            for name, values in self.where.items():
                raw = field_values(records, *fields[name][1:4])
                keep &= pa.compute.is_in(raw, pa.array(values, raw.type)).to_numpy(zero_copy_only=False)
            records, number = records[keep], number[keep]
        cols = []
        for name in self.names:
            if name in fields:
                cols.append(field_values(records, *fields[name][1:4]))
            else:
                n = len(records)
                cols.append(pa.StructArray.from_arrays(
                    [pa.array(np.full(n, part.number, np.int32)), pa.array([part.file] * n, pa.string()),
                     pa.array(np.zeros(n, np.int64)), pa.array(number)], ["input", "file", "block", "row"]))
        return pa.RecordBatch.from_arrays(cols, self.names)


def field_values(records: np.ndarray, start: int, width: int, kind: str) -> pa.Array:
    """One field of all records; bytes beyond the record are absent."""
    raw = records[:, start - 1:start - 1 + width]
    if kind == "p":
        return packed(raw) if raw.shape[1] == width else pa.nulls(len(raw), pa.int64() if width <= LONG_BYTES else pa.string())
    if not raw.shape[1]:
        return pa.array([""] * len(raw), pa.string())
    cells = pa.FixedSizeBinaryArray.from_buffers(pa.binary(raw.shape[1]), len(raw), [None, pa.py_buffer(raw.tobytes())])
    try:
        return cells.cast(pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([v.decode("utf-8", "replace") for v in cells.to_pylist()], pa.string())


def packed(raw: np.ndarray) -> pa.Array:
    """Packed decimals: all half bytes but the last are digits, the last is the
    sign (D negative; C, F positive). Anything else is missing."""
    half = np.stack([raw >> 4, raw & 15], axis=2).reshape(len(raw), 2 * raw.shape[1])
    digits, sign = half[:, :-1], half[:, -1]
    good = (digits <= 9).all(axis=1) & np.isin(sign, [12, 13, 15])
    if raw.shape[1] <= LONG_BYTES:
        value = np.zeros(len(raw), np.int64)
        for d in np.where(good[:, None], digits, 0).T:
            value = value * 10 + d
        return pa.array(np.where(sign == 13, -value, value), mask=~good)
    text = ["".join(map(str, d)) if g else None for d, g in zip(digits.tolist(), good.tolist())]
    return pa.array([t and ("-" if s == 13 else "") + t for t, s in zip(text, sign.tolist())], pa.string())


class Part(WriterCommitMessage):
    def __init__(self, number: int, file: str, size: int):
        self.number, self.file, self.size = number, file, size


class RecordWriter(DataSourceArrowWriter):
    def __init__(self, path: str, compressed: bool = False):
        self.path, self.run, self.end = path, uuid.uuid4().hex[:12], PACKED_PART if compressed else ""

    def write(self, iterator) -> Part:
        context = TaskContext.get()
        number = context.partitionId()
        file = f"part-{number:05d}-{self.run}-{context.taskAttemptId()}{self.end}"
        system, base = open_path(self.path)
        system.create_dir(base, recursive=True)
        size = 0
        with system.open_output_stream(f"{base}/{file}") as f:
            for batch in iterator:
                # Values stand one after the other in the column's buffer; of missing ones nothing does.
                values = batch.column(0).drop_null().cast(pa.large_binary())
                if len(values):
                    ends = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
                    data = values.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0]))
                    size += len(data)
                    f.write(data)
        return Part(number, file, size)

    def commit(self, messages) -> None:
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.number)
        system, base = open_path(self.path)
        system.create_dir(base, recursive=True)
        text = json.dumps({"parts": [{"file": m.file, "bytes": m.size} for m in parts]})
        with system.open_output_stream(f"{base}/{self.run}.tmp") as f:
            f.write(text.encode())
        system.move(f"{base}/{self.run}.tmp", f"{base}/{MANIFEST}")

    def abort(self, messages) -> None:
        system, base = open_path(self.path)
        for m in messages:
            if m is not None:
                system.delete_file(f"{base}/{m.file}")


class RecordFiles(DataSource):
    """Options of a read: ``paths`` (JSON list, in input order), ``lrecl``, ``fields`` (JSON list of
    name, start, width, kind), ``where`` (JSON: field -> accepted raw values), ``split`` (bytes), and the
    schema: the fields wanted, and optionally a struct column for the record sequence. Option of
    a write: ``path``, ``compressed`` ("true": parts are packed by zstd)."""

    @classmethod
    def name(cls) -> str:
        return "records"

    def reader(self, schema) -> RecordReader:
        return RecordReader(self.options, schema.names)

    def writer(self, schema, overwrite: bool) -> RecordWriter:
        return RecordWriter(self.options["path"], self.options.get("compressed", "") == "true")

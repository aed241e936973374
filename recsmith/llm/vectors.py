"""Vectors as DataFrame rows: which take part, and blocks of them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from recsmith.llm.common import map_batches


def usable(df: DataFrame, id_col: str, vec: str) -> DataFrame:
    """``id``, ``v`` of the rows whose vector takes part: not null, not zero, every
    component finite, an id. Vectors are compared with those of their own length."""
    v = F.col(vec)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return df.select(F.col(id_col).cast("long").alias("id"), v.cast("array<float>").alias("v")).where(
        F.col(id_col).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))


def by_length(batch: pa.RecordBatch, name: str = "v") -> list[tuple[np.ndarray, np.ndarray]]:
    """Per length, the places of the batch's vectors and their float32 matrix."""
    col = batch.column(batch.schema.get_field_index(name))
    sizes = pc.list_value_length(col).to_numpy(zero_copy_only=False)
    out = []
    for d in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == d)
        flat = col.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        out.append((rows, flat.astype(np.float32, copy=False).reshape(len(rows), d)))
    return out


def blocks(rows: DataFrame, size: int, pack: Callable[[np.ndarray, np.ndarray], dict[str, bytes]],
           columns: list[str]) -> DataFrame:
    """One row per ``size`` vectors of one length at most: ``d`` (the length), ``n``, ``ids``, ``vectors``
    and what ``pack(ids, matrix)`` makes of them, all packed binary."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        every = b.column(0).to_numpy(zero_copy_only=False).astype("<i8")
        made = []
        for at, x in by_length(b):
            cols = {"ids": every[at].tobytes(), "vectors": x.astype("<f4").tobytes()} | pack(every[at], x)
            made.append([x.shape[1], len(x), *(cols[c] for c in ["ids", "vectors", *columns])])
        kinds = [pa.int32(), pa.int32()] + [pa.binary()] * (2 + len(columns))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)],
                                          ["d", "n", "ids", "vectors", *columns])

    schema = "d int, n int, ids binary, vectors binary" + "".join(f", {c} binary" for c in columns)
    return map_batches(rows.select("id", "v"), run, schema, size)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise cosine of two float64 matrices."""
    norm = lambda m: np.sqrt((m * m).sum(axis=1))
    return (x * y).sum(axis=1) / (norm(x) * norm(y))

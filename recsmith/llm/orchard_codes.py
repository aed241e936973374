"""Product codes of vectors, with nearest codebook entries found by Orchard search.

Vectors become integers (``floor(scale * x)``) and are cut into equal consecutive
parts; every part position has a codebook. For each entry of a codebook a list of all
its entries sorted by distance from it is kept. The search for a part starts at some
entry and goes down that entry's list. As soon as an entry is better than the current
one, it becomes the current one and its list is gone down instead; entries met before
are marked and skipped. It stops at an entry further from the current one than twice
the current distance: by the triangle inequality that one and all after it are
further from the part than the current one. All distances are squared integers
(stop beyond four times), so the entry found is exactly the nearest, ties going to
the lower index. A batch searches all its parts at once, a step of every search at a time;
it starts at the best of a few entries tried first.

``learn`` runs rounds of assignment and componentwise ``floor(sum / count)``; a task
adds up its sums per entry before the shuffle, and codebooks (a fixed number of integers,
whatever the table's size) are all that the driver sees. ``encode`` makes one pass.

Defined cases: rows whose vector is null or holds a null or non-finite component are
left out. Vectors of each length have codebooks of their own; a length that the number
of parts does not divide gives some parts one component more; tables of more than
``MAX_LENGTHS`` lengths are refused. Empty
vectors have empty parts (index 0, error 0). First entries are the vectors of the smallest ids,
in the order of id, then vector; null ids come last; fewer rows give fewer entries.
Repeated ids are rows of their own. An empty table gives no codebooks and no rows.
Components beyond ``MAX_SIZE`` after scaling are refused with an error, as squared sums
would not be exact. Other columns are carried on request only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from recsmith.llm.common import map_batches

# Largest size of a scaled component: squared distances of up to 2^15 of them fit 64 bits.
MAX_SIZE = 1 << 23
ROWS = 2048
# Vector lengths of one table; each has codebooks that go to every task.
MAX_LENGTHS = 64
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256


def usable(df: DataFrame, id_col: str, vec: str, keep: Sequence[str] = ()) -> DataFrame:
    """``id``, ``v``, ``d`` (length) and the columns ``keep`` of the rows that take part."""
    v = F.col(vec)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.where(v.isNotNull() & finite)
    return rows.select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"),
                       F.size(v).alias("d"), *[F.col(c).alias(f"keep_{c}") for c in keep])


def scaled(x: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * x)`` as integers."""
    y = np.floor(x * scale)
    if y.size and np.abs(y).max() > MAX_SIZE:
        raise ValueError(f"vector components beyond {MAX_SIZE} after scaling")
    return y.astype(np.int64)


def matrix(batch: pa.RecordBatch, rows: np.ndarray, length: int) -> np.ndarray:
    """The vectors of the rows ``rows``, all of one length."""
    col = batch.column(batch.schema.get_field_index("v")).take(pa.array(rows))
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), length)


class Books:
    """Codebooks of vectors of one length: ``entries[part]`` is [entries, components of
    the part]. ``near[part, e]``: entries by distance from ``e`` (itself first), and
    ``far[part, e]`` those squared distances."""

    def __init__(self, entries: list[np.ndarray]):
        self.entries, self.k = entries, len(entries[0])
        self.edges = np.cumsum([0] + [e.shape[1] for e in entries])
        width = max(e.shape[1] for e in entries)
        # Parts padded to one width: equal components add nothing to a distance.
        self.table = np.zeros((len(entries), self.k, width), np.int64)
        for p, e in enumerate(entries):
            self.table[p, :, :e.shape[1]] = e
        gap = self.table[:, :, None, :] - self.table[:, None, :, :]
        dist = (gap * gap).sum(axis=3)
        # An entry comes first in its own list, also before equal ones.
        itself = np.where(np.eye(self.k, dtype=bool), -1, dist)
        self.near = np.argsort(itself, axis=2, kind="stable")
        self.far = np.take_along_axis(dist, self.near, axis=2)

    def parts(self, x: np.ndarray) -> np.ndarray:
        """[rows, parts, width] of a matrix of whole vectors."""
        out = np.zeros((len(x), len(self.entries), self.table.shape[2]), np.int64)
        for p, (a, z) in enumerate(zip(self.edges[:-1], self.edges[1:])):
            out[:, p, :z - a] = x[:, a:z]
        return out

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of every part of every row, and the squared distance."""
        n, m = len(x), len(self.entries)
        query = self.parts(x).reshape(n * m, -1)
        part = np.tile(np.arange(m), n)
        measure = lambda q, e: ((query[q] - self.table[part[q], e]) ** 2).sum(axis=1)
        every = np.arange(n * m)
        now = self.first_guess(query, part)
        best = measure(every, now)
        met = np.zeros((n * m, self.k), bool)
        met[every, now] = True
        q, at = every, np.ones(n * m, np.int64)
        while True:
            # The next entry of the current one's list; the search ends with the list,
            # or beyond twice the distance.
            live = at < self.k
            q, at = q[live], at[live]
            here = now[q]
            live = self.far[part[q], here, at] <= 4 * best[q]
            q, at, here = q[live], at[live], here[live]
            if not len(q):
                break
            e = self.near[part[q], here, at]
            new = np.flatnonzero(~met[q, e])
            at += 1
            if not len(new):
                continue
            qn, en = q[new], e[new]
            met[qn, en] = True
            d = measure(qn, en)
            jump = (d < best[qn]) | (d == best[qn]) & (en < now[qn])
            qn = qn[jump]
            now[qn], best[qn], at[new[jump]] = en[jump], d[jump], 1
        return now.reshape(n, m), best.reshape(n, m)

    def first_guess(self, query: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Where searches start: the better of a few entries spread over the codebook."""
        tried = np.unique(np.linspace(0, self.k - 1, min(self.k, 6)).astype(np.int64))
        dist = np.stack([((query - self.table[part, e]) ** 2).sum(axis=1) for e in tried])
        return tried[dist.argmin(axis=0)]

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and place."""
        return hashlib.sha256(",".join(str(x) for e in self.entries for x in e.ravel().tolist()).encode()).hexdigest()

    def decode(self, code: bytes) -> np.ndarray:
        """The scaled vector that a code stands for."""
        return np.concatenate([e[c] for e, c in zip(self.entries, code)])


def part_sizes(length: int, parts: int) -> list[int]:
    return [(p + 1) * length // parts - p * length // parts for p in range(parts)]


def first_books(rows: DataFrame, parts: int, entries: int, scale: float) -> dict[int, Books]:
    """Codebooks made of the vectors of the smallest ids, per length."""
    order = Window.partitionBy("d").orderBy(F.col("id").asc_nulls_last(), F.col("v"))
    # Spark keeps the first of each length in every task before the shuffle.
    first = rows.select("id", "v", "d", F.row_number().over(order).alias("n")).where(F.col("n") <= entries)
    made: dict[int, list] = {}
    for r in first.orderBy("d", "n").select("d", "v").toLocalIterator():
        made.setdefault(r.d, []).append(r.v)
        if len(made) > MAX_LENGTHS:
            raise ValueError(f"vectors of more than {MAX_LENGTHS} lengths")
    books = {}
    for d, vectors in made.items():
        x = scaled(np.array(vectors, np.float64).reshape(len(vectors), d), scale)
        books[d] = Books(np.split(x, np.cumsum(part_sizes(d, parts))[:-1], axis=1))
    return books


def each_length(batch: pa.RecordBatch, books: dict[int, Books], scale: float):
    """Rows of the batch by length, with their codebooks, indexes and distances."""
    lengths = batch.column(batch.schema.get_field_index("d")).to_numpy(zero_copy_only=False)
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        x = scaled(matrix(batch, rows, d), scale)
        yield d, rows, x, *books[d].search(x)


def improve(rows: DataFrame, books: dict[int, Books], scale: float) -> dict[int, Books]:
    """One round: every entry becomes the componentwise floor of its parts' mean."""
    sent = rows.sparkSession.sparkContext.broadcast(books)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        cols: list[list] = [[], [], [], [], []]
        for d, _, x, code, _ in each_length(b, sent.value, scale):
            made = sent.value[d]
            cut = made.parts(x)
            for p in range(len(made.entries)):
                order = np.argsort(code[:, p], kind="stable")
                used, at = np.unique(code[order, p], return_index=True)
                total = np.add.reduceat(cut[order, p], at, axis=0)[:, :made.entries[p].shape[1]]
                for c, v in zip(cols, ([d] * len(used), [p] * len(used), used.tolist(),
                                       np.diff(np.append(at, len(x))).tolist(), total.tolist())):
                    c.extend(v)
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["d", "p", "e", "n", "total"])

    sums = map_batches(rows.select("v", "d"), run, "d int, p int, e int, n long, total array<long>", ROWS)
    # A row per component, so that sums combine map-side; entries without
    # components (parts of short vectors) have nothing to improve.
    sums = (sums.select("d", "p", "e", "n", F.posexplode("total").alias("i", "s"))
            .groupBy("d", "p", "e", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
    found: dict[int, list] = {}
    for r in sums.toLocalIterator():
        found.setdefault(r.d, []).append((r.p, r.e, r.i, r.s // r.n))
    made = {}
    for d, old in books.items():
        entries = [e.copy() for e in old.entries]
        for p, e, i, mean in found.get(d, []):
            entries[p][e, i] = mean
        made[d] = Books(entries)
    return made


def learn(df: DataFrame, id_col: str = "vec_id", vec: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
          rounds: int = ROUNDS, scale: float = SCALE) -> dict[int, Books]:
    """Codebooks per vector length. A code's index is one byte: at most 256 entries."""
    if not 1 <= entries <= 256:
        raise ValueError("1 to 256 entries")
    rows = usable(df, id_col, vec)
    books = first_books(rows, parts, entries, scale)
    for _ in range(rounds if books else 0):
        books = improve(rows, books, scale)
    return books


def encode(df: DataFrame, books: dict[int, Books], id_col: str = "vec_id", vec: str = "embedding",
           keep: Sequence[str] = (), scale: float = SCALE) -> DataFrame:
    """``id``, ``code`` (one byte a part), ``error`` (squared distance of the scaled vector
    from what the code stands for), ``length`` of every vector that takes part and whose length
    has codebooks, and the columns ``keep`` as ``keep_<name>``."""
    rows = usable(df, id_col, vec, keep)
    rows = rows.where(F.col("d").isin(list(books)) if books else F.lit(False))
    sent = rows.sparkSession.sparkContext.broadcast(books)
    kept = [c for c in rows.columns if c.startswith("keep_")]

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        code, error = np.empty(b.num_rows, object), np.zeros(b.num_rows, np.int64)
        for _, at, _, found, dist in each_length(b, sent.value, scale):
            code[at] = [c.tobytes() for c in found.astype(np.uint8)]
            error[at] = dist.sum(axis=1)
        cols = [b.column(b.schema.get_field_index(c)) for c in ("id", "d", *kept)]
        return pa.RecordBatch.from_arrays([cols[0], pa.array(code, pa.binary()), pa.array(error), *cols[1:]],
                                          ["id", "code", "error", "length", *kept])

    kinds = "".join(f", `{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return map_batches(rows, run, f"id long, code binary, error long, length int{kinds}", ROWS)


def digests(spark: SparkSession, books: dict[int, Books]) -> DataFrame:
    """``length``, ``codebooks_sha256``: one row per length that has codebooks."""
    return spark.createDataFrame([(d, b.digest()) for d, b in books.items()], "length int, codebooks_sha256 string")

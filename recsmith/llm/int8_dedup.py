"""Embedding near-duplicates by int8 tile products with rigorous bounds.

A unit vector ``u`` is stored as int8 ``q`` and scale ``s``; ``r`` is the norm of
what that lost, ``u - s q``. For any two vectors |<u, v> - s t <q, p>| is at
most (1 + r_u) r_v + r_u, so the integer product of two tiles shows which
pairs may reach the threshold; only those are computed again, in double
precision on the original vectors. No pair at or above the threshold is lost.

Spark side: tiles of bounded size are dealt to the cells of a triangular grid,
so every pair of tiles meets in one task and no key is hot. A task folds the
links of all its pairs of tiles into link counts per id and one spanning forest, so a large
group of copies never becomes a list of all its pairs. Components of the
forests give the groups.

Defined cases: vectors that take no part (``vectors.usable``) have no links and
are their own component; vectors of different lengths do not link; a repeated id is
one vertex: it links with every other id that one of its rows links with, each counted
once; null ids are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from recsmith.llm.common import shuffle_partitions, small_batches, store
from recsmith.llm.components import connected_components, star_forest
from recsmith.llm.vectors import by_length, cosines, usable

TILE = 2048
# Ids and edges that a task folds before it hands them on.
HELD = 1 << 20
# More components than this times 127^2 would not be exact in float32.
EXACT_F32 = 1000
# Pairs computed again at once.
RECHECK = 1 << 16
# Beyond every rounding of the double and single precision steps.
SLACK = 1e-5


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, scales and norms of the remainder of the unit rows of ``x``."""
    u = x.astype(np.float64)
    u /= np.sqrt((u * u).sum(axis=1, keepdims=True))
    scale = np.abs(u).max(axis=1) / 127
    q = np.rint(u / scale[:, None]).astype(np.int8)
    lost = u - scale[:, None] * q
    return q, scale, np.sqrt((lost * lost).sum(axis=1))


def possible(qa, sa, ra, qb, sb, rb, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose cosine may be at least ``threshold``."""
    kind = np.float32 if qa.shape[1] <= EXACT_F32 else np.float64
    product = qa.astype(kind) @ qb.astype(kind).T
    product *= sa.astype(kind)[:, None]
    product *= sb.astype(kind)[None, :]
    product += np.outer(1 + ra, rb).astype(kind)
    return np.nonzero(product >= (threshold - ra - SLACK).astype(kind)[:, None])


def linked(xa, xb, i, j, threshold: float) -> np.ndarray:
    """Which of the pairs reach the threshold in double precision."""
    out = np.zeros(len(i), bool)
    for at in range(0, len(i), RECHECK):
        s = slice(at, at + RECHECK)
        out[s] = cosines(xa[i[s]].astype(np.float64), xb[j[s]].astype(np.float64)) >= threshold
    return out


def tile_links(a: list[dict], b: list[dict], same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the two ends of every link between two tiles, once for each pair of ids."""
    ends = []
    for x in a:
        for y in b:
            if x["d"] != y["d"]:
                continue
            ia, xa, *qa = opened(x)
            ib, xb, *qb = opened(y)
            i, j = possible(*qa, *qb, threshold)
            other = ia[i] != ib[j]
            if same:
                other &= i < j
            i, j = i[other], j[other]
            hit = linked(xa, xb, i, j, threshold)
            ends.append((ia[i[hit]], ib[j[hit]]))
    if not ends:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    v, w = (np.concatenate(e) for e in zip(*ends))
    if not (repeated(a) or repeated(b)):
        return v, w
    low, high = np.minimum(v, w), np.maximum(v, w)
    # Rows of one id are links of that id: a pair of ids counts once.
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    first = np.ones(len(low), bool)
    first[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    return low[first], high[first]


def repeated(parts: list[dict]) -> bool:
    """Has an id of the tile several rows?"""
    ids = np.concatenate([np.frombuffer(p["ids"], "<i8") for p in parts])
    return len(np.unique(ids)) < len(ids)


def opened(part: dict) -> tuple:
    """Ids, vectors, int8 rows, scales and remainders of a tile's vectors of one length."""
    ids = np.frombuffer(part["ids"], "<i8")
    n = len(ids)
    return (ids, np.frombuffer(part["vectors"], "<f4").reshape(n, -1), np.frombuffer(part["q"], np.int8).reshape(n, -1),
            np.frombuffer(part["scale"], "<f8"), np.frombuffer(part["lost"], "<f8"))


PART = "struct<d:int,ids:binary,vectors:binary,q:binary,scale:binary,lost:binary>"


def make_tiles(rows: DataFrame, size: int) -> DataFrame:
    """Tiles of about ``size`` rows in the order of ids: ``tile`` (a number), ``first``, ``last`` (ids),
    ``parts`` (the rows by length). All rows of an id are in one tile, but for ids of more
    rows than a tile and those that a range boundary cuts."""
    order = ["id", F.xxhash64("v")]
    dealt = rows.select("id", "v").repartitionByRange(*order).sortWithinPartitions(*order)

    def tile(number: int, ids: np.ndarray, v: list[pa.Array]) -> pa.RecordBatch:
        parts = []
        for at, x in by_length(pa.RecordBatch.from_arrays([pa.concat_arrays(v)], ["v"])):
            q, scale, lost = quantise(x)
            parts.append({"d": x.shape[1], "ids": ids[at].astype("<i8").tobytes(), "vectors": x.astype("<f4").tobytes(),
                          "q": q.tobytes(), "scale": scale.astype("<f8").tobytes(), "lost": lost.astype("<f8").tobytes()})
        kind = pa.list_(pa.struct([("d", pa.int32())] + [(c, pa.binary()) for c in ("ids", "vectors", "q", "scale", "lost")]))
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([int(ids[0])], pa.int64()),
                                           pa.array([int(ids[-1])], pa.int64()), pa.array([parts], kind)],
                                          ["tile", "first", "last", "parts"])

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        ids, held = np.empty(0, np.int64), []
        for b in batches:
            ids = np.concatenate([ids, b.column(0).to_numpy()])
            held.append(b.column(1))
            while len(ids) > size:
                # The last row within the size after which another id begins.
                ends = np.flatnonzero(ids[1:size + 1] != ids[:size])
                cut = int(ends[-1]) + 1 if len(ends) else size
                v = pa.concat_arrays(held)
                yield tile(number, ids[:cut], [v.slice(0, cut)])
                ids, held, number = ids[cut:], [v.slice(cut)], number + 1
        if len(ids):
            yield tile(number, ids, held)

    small_batches(rows.sparkSession, size)
    return dealt.mapInArrow(run, f"tile long, first long, last long, parts array<{PART}>")


def links(rows: DataFrame, threshold: float, tile: int = TILE) -> DataFrame:
    """(v, m, n) of links between ids: n > 0: n links of v; n = 0: an edge of a spanning forest of
    links; n < 0: the link v, m itself, perhaps several times, where one end is an id with rows in
    several tiles. ``rows``: distinct (``id``, ``v``)."""
    side = math.ceil(math.sqrt(2 * shuffle_partitions(rows.sparkSession)))
    tiles = store(make_tiles(rows, tile), "tiles")
    # Ids in several tiles are the last of one and the first of the next.
    ends = tiles.select("tile", F.explode(F.array_distinct(F.array("first", "last"))).alias("id"))
    cut = ends.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    cut = store(ends.join(cut, "id").groupBy("tile").agg(F.collect_list("id").alias("cut")), "cut_ids")
    tiles = tiles.drop("first", "last").join(cut, "tile", "left").withColumn("grp", F.pmod(F.xxhash64("tile"), F.lit(side)).cast("int"))
    cols = ["tile", "parts", "cut"]
    named = lambda k: [F.col(c).alias(f"{k}_{c}") for c in cols]
    # Cell (a, b), a <= b, gets the tiles of group a on one side, of b on the other.
    left = tiles.select(*named("a"), F.col("grp").alias("ga"),
                        F.explode(F.sequence("grp", F.lit(side - 1))).alias("gb"))
    right = tiles.select(*named("b"), F.col("grp").alias("gb"),
                         F.explode(F.sequence(F.lit(0), F.col("grp"))).alias("ga"))
    pairs = left.join(right, ["ga", "gb"]).where("ga < gb or a_tile <= b_tile").drop("ga", "gb")

    def run(batches):
        found = Found()
        for b in batches:
            for k in range(b.num_rows):
                row = b.slice(k, 1).to_pylist()[0]
                found.add(*tile_links(row["a_parts"], row["b_parts"], row["a_tile"] == row["b_tile"], threshold),
                          np.array((row["a_cut"] or []) + (row["b_cut"] or []), np.int64))
                if found.size > HELD:
                    yield found.batch()
                    found = Found()
        if found.size:
            yield found.batch()

    small_batches(rows.sparkSession)
    return pairs.mapInArrow(run, "v long, m long, n long")


class Found:
    """Links of many pairs of tiles, folded: counts per id, a spanning forest, and links of cut ids."""

    def __init__(self):
        empty = np.empty(0, np.int64)
        self.ids, self.n, self.forest, self.single = empty, empty, (empty, empty), (empty, empty)

    @property
    def size(self) -> int:
        return len(self.ids) + len(self.forest[0]) + len(self.single[0])

    def add(self, x: np.ndarray, y: np.ndarray, cut: np.ndarray) -> None:
        if not len(x):
            return
        self.forest = star_forest(np.concatenate([self.forest[0], x]), np.concatenate([self.forest[1], y]))
        apart = np.isin(x, cut) | np.isin(y, cut)
        if apart.any():
            pairs = np.stack([np.concatenate([self.single[k], e[apart]]) for k, e in enumerate((x, y))], axis=1)
            self.single = tuple(np.unique(pairs, axis=0).T)
        ids, n = np.unique(np.concatenate([x[~apart], y[~apart]]), return_counts=True)
        self.ids, at = np.unique(np.concatenate([self.ids, ids]), return_inverse=True)
        total = np.zeros(len(self.ids), np.int64)
        np.add.at(total, at, np.concatenate([self.n, n]))
        self.n = total

    def batch(self) -> pa.RecordBatch:
        v = np.concatenate([self.ids, self.forest[0], self.single[0]])
        m = np.concatenate([np.zeros(len(self.ids), np.int64), self.forest[1], self.single[1]])
        n = np.concatenate([self.n, np.zeros(len(self.forest[0]), np.int64), np.full(len(self.single[0]), -1)])
        return pa.RecordBatch.from_arrays([pa.array(v.astype("i8")), pa.array(m.astype("i8"), mask=n > 0), pa.array(n.astype("i8"))],
                                          ["v", "m", "n"])


def near_duplicates(df: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vec: str = "embedding",
                    tile: int = TILE) -> DataFrame:
    """One row per id: ``id``, ``n_links`` (other ids linked), ``component_id``, ``kept``."""
    ids = df.select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct()
    rows = usable(df, id_col, vec).distinct()
    found = store(links(rows, threshold, tile), "links")
    counts = found.where("n > 0").select(F.col("v").alias("id"), F.col("n").alias("n_links"))
    single = found.where("n < 0").select("v", "m").distinct()
    counts = counts.union(single.select("v", F.lit(1).cast("long"))).union(single.select("m", F.lit(1).cast("long")))
    counts = counts.groupBy("id").agg(F.sum("n_links").alias("n_links"))
    groups = connected_components(found.where("n = 0"), "v", "m")
    return (ids.join(counts, "id", "left").join(groups, "id", "left")
            .select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.col("id") == F.col("component_id")))

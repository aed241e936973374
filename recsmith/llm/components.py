"""Connected components of a distributed edge list.

Alternating large-star / small-star rounds: every round is two narrow
aggregations (minimum neighbour per node, combined map-side) and two joins on
the node; the edge list is written to the shared checkpoint folder after each
round, so neither lineage nor driver memory grows. Rounds end when the edge
list no longer changes (a count and an order-free hash sum are compared).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recsmith.llm.common import map_batches, store

# Edges that are reduced to a forest at once.
FOREST_ROWS = 1 << 16


def star_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest reachable node) with the same components as the
    edges ``a``-``b``; at most one per node. Hooking plus pointer jumping."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a):]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        hi, lo = np.maximum(rx, ry), np.minimum(rx, ry)
        live = hi != lo
        if not live.any():
            break
        np.minimum.at(root, hi[live], lo[live])
        while True:
            nxt = root[root]
            if np.array_equal(nxt, root):
                break
            root = nxt
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _local_forest(batch: pa.RecordBatch) -> pa.RecordBatch:
    v, m = star_forest(batch.column(0).to_numpy(zero_copy_only=False),
                       batch.column(1).to_numpy(zero_copy_only=False))
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()), pa.array(m, pa.int64())], ["v", "m"])


def _min_neighbour(edges: DataFrame) -> DataFrame:
    """(v, m) edges with each node's smallest neighbour or itself joined on."""
    low = edges.groupBy("v").agg(F.min("m").alias("lo"))
    return edges.join(low.select("v", F.least("v", "lo").alias("lo")), "v")


def _round(edges: DataFrame) -> DataFrame:
    both = edges.select("v", "m").union(edges.select(F.col("m").alias("v"), F.col("v").alias("m")))
    large = (_min_neighbour(both).where("m > v")
             .select(F.col("m").alias("v"), F.col("lo").alias("m")).where("v != m"))
    down = large.select(F.greatest("v", "m").alias("v"), F.least("v", "m").alias("m")).distinct()
    small = _min_neighbour(down)
    return (small.select(F.col("m").alias("v"), F.col("lo").alias("m"))
            .union(small.select("v", F.col("lo").alias("m")))
            .where("v != m").distinct())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row per node that has an edge to another node: ``id``, ``component``
    (smallest node reachable). Nulls and self-loops are ignored; repeated edges
    and either direction are fine; no edges give no rows."""
    e = edges.select(F.col(a).cast("long").alias("v"), F.col(b).cast("long").alias("m"))
    e = e.where("v is not null and m is not null and v != m")
    e = store(map_batches(e, _local_forest, "v long, m long", FOREST_ROWS).distinct(), "edges")
    mark = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
        if tuple(now) == mark or not now[0]:
            break
        mark = tuple(now)
        e = store(_round(e), "edges")
    return (e.select(F.col("v").alias("id"), F.col("m").alias("component"))
            .union(e.select("m", "m")).distinct())

"""Prefix trie of conversations, with subtree sums by centroid decomposition.

Conversations that begin with the same turns share nodes. A turn is reduced to a digest
and its length, so texts are read once and never shuffled. The identity of a prefix
is its length and two 64-bit sums (exclusive or) of hashes of its (place, turn digest)
pairs: it needs no chain along a conversation, only running sums, which are taken within
blocks of a conversation and offset by the blocks before.

Sums over subtrees (``rollup``) come from a centroid decomposition of the parent-edge forest.
Every node knows how many rows (conversation, depth) its subtree holds, which a
plain aggregate gives. In each component the nodes with more than half of the
component's rows are a path from its top down; the last one is the centroid. The centroid
leaves, its children's subtrees and the rest become components of at most half the rows, and
the total of the centroid's subtree is added to every node of the path, all of which are its
ancestors. A node's sum is complete when it has been a centroid itself. So there are at most
log2(rows) levels, however deep or wide the trie is. Large components are split by
joins and aggregates, all in one round per level; components of a bounded number of
nodes are finished inside tasks, level by level in the same way.

Defined cases: rows without a conversation id are left out; null role or text is empty;
turns are ordered by turn (null first), equal ones by role, then by the digest of role and
text; repeated rows are turns of their own; a conversation without turns is a member of
the root only; an empty table has no nodes, not even the root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from recsmith.llm.common import small_batches, store
from recsmith.operators.positions import group_positions

# Places of a conversation that are summed in one window group.
BLOCK = 4096
# Nodes of a component that is finished inside a task.
LOCAL_NODES = 1 << 17
KEY = ["depth", "z1", "z2"]
TOP = ["top_depth", "t1", "t2"]


def turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``pos`` (from 1), ``digest`` (of role and text), ``chars`` (code points of
    the text) of every turn."""
    who, said = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.unhex(F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, said).cast("binary")))
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), who.alias("role"), digest.alias("digest"),
        F.length(said).cast("long").alias("chars"))
    numbered = group_positions(rows, ["conv"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")],
                               skew_safe=True)
    return store(numbered.select("conv", "pos", "digest", "chars"), "turns")


def rebuild(rows: DataFrame, head: Column, group: int = 100) -> tuple[DataFrame, DataFrame]:
    """Every conversation ``c`` with the first ``head`` (an expression on ``conv``, below ``group``) turns
    of conversation ``c - c % group`` in place of its own first ``head``. Returns the
    rows (``conv``, ``pos``, ``len``, ``digest``, ``chars``) and the conversations (``conv``, ``len``),
    those left without turns included."""
    size = rows.groupBy("conv").agg(F.max("pos").alias("n"))
    convs = size.select("conv", "n", head.cast("long").alias("h"), (F.col("conv") - F.col("conv") % group).alias("base"))
    of_base = size.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(of_base, "base", "left").withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = store(convs.select("conv", "base", "h", "m", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")),
                  "rebuilt")
    own = rows.join(convs, "conv").where("pos > h").withColumn("pos", F.col("pos") - F.col("h") + F.col("m"))
    # Few turns of every group-th conversation, each asked for by its group only.
    heads = rows.where((F.col("conv") % group == 0) & (F.col("pos") < group)).withColumnRenamed("conv", "base")
    lent = convs.where("m > 0").join(heads, "base").where("pos <= m")
    cols = ["conv", "pos", "len", "digest", "chars"]
    return own.select(*cols).union(lent.select(*cols)), convs.select("conv", "len")


def whole(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations as they are, in the form of ``rebuild``."""
    convs = rows.groupBy("conv").agg(F.max("pos").alias("len"))
    return rows.join(convs, "conv").select("conv", "pos", "len", "digest", "chars"), convs


def paths(rows: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The node of every conversation at every depth: ``conv``, ``depth``, ``len``, ``chars``,
    ``z1``, ``z2`` (with the depth the node's key) and ``p1``, ``p2`` (its parent's)."""
    own = rows.select("*", F.xxhash64("pos", "digest").alias("a"), F.xxhash64(F.lit("second"), "digest", "pos").alias("b"),
                      F.floor((F.col("pos") - 1) / block).alias("block"))
    # Sums of the blocks before, for conversations of several blocks.
    total = own.where(F.col("len") > block).groupBy("conv", "block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    total = total.select("conv", "block", F.bit_xor("a").over(before).alias("o1"), F.bit_xor("b").over(before).alias("o2"))
    inside = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    run = own.select("*", F.bit_xor("a").over(inside).alias("r1"), F.bit_xor("b").over(inside).alias("r2"))
    run = run.join(total, ["conv", "block"], "left")
    for k in ("1", "2"):
        run = run.withColumn(f"z{k}", F.col(f"r{k}").bitwiseXOR(F.coalesce(f"o{k}", F.lit(0))))
    turns_ = run.select("conv", F.col("pos").alias("depth"), "len", "chars", "z1", "z2",
                        F.col("z1").bitwiseXOR(F.col("a")).alias("p1"), F.col("z2").bitwiseXOR(F.col("b")).alias("p2"))
    zero = F.lit(0).cast("long")
    root = convs.select("conv", zero.alias("depth"), "len", zero.alias("chars"), zero.alias("z1"), zero.alias("z2"),
                        F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"))
    return store(turns_.union(root), "paths")


def nodes(rows: DataFrame) -> DataFrame:
    """One row per node of ``paths``: its key (``depth``, ``z1``, ``z2``), its parent's ``p1``,
    ``p2``, ``first_conv`` (smallest member), ``parent_conv`` (the parent's), ``n_convs``, ``n_children``,
    ``chars`` and ``rows`` (rows of ``paths`` in its subtree)."""
    each = store(rows.groupBy(*KEY).agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("conv").alias("first_conv"), F.count("*").alias("n_convs"),
        F.max("chars").alias("chars"), F.sum(F.col("len") - F.col("depth") + 1).alias("rows")), "nodes")
    children = each.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("z1"), F.col("p2").alias("z2")).agg(
        F.count("*").alias("n_children"))
    parent = each.select((F.col("depth") + 1).alias("depth"), F.col("z1").alias("p1"), F.col("z2").alias("p2"),
                         F.col("first_conv").alias("parent_conv"))
    return (each.join(parent, ["depth", "p1", "p2"], "left").join(children, KEY, "left")
            .select(*KEY, "p1", "p2", "first_conv", "parent_conv", "n_convs",
                    F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "chars", "rows"))


def rollup(each: DataFrame, rows: DataFrame, sums: Sequence[str], local_nodes: int = LOCAL_NODES) -> DataFrame:
    """Key of every node of ``each`` (as ``nodes`` gives it) and the sums of the long columns
    ``sums`` over its subtree, under the same names. ``rows``: the ``paths`` it was made of."""
    state = [*KEY, "p1", "p2", "first_conv", "rows", *sums, *TOP, *[f"f_{s}" for s in sums]]
    live = store(each.select(*KEY, "p1", "p2", "first_conv", "rows", *sums, *[F.lit(0).cast("long").alias(c) for c in TOP],
                             *[F.lit(0).cast("long").alias(f"f_{s}") for s in sums]), "components")
    looked = rows.where("depth > 0").select(F.col("conv").alias("first_conv"), F.col("depth").alias("look"), F.col("z1").alias("k1"),
                                            F.col("z2").alias("k2"), F.col("p1").alias("l1"), F.col("p2").alias("l2"))
    small, done = [], []
    while True:
        comps = live.groupBy(*TOP).agg(F.count("*").alias("n"), F.max("rows").alias("m"))
        big = store(comps.where(F.col("n") > local_nodes).drop("n"), "large")
        if big.isEmpty():
            small.append(live)
            break
        small.append(live.join(big, TOP, "left_anti").select(*state))
        now = live.join(big, TOP)
        heavy = 2 * F.col("rows") > F.col("m")
        # The heavy nodes of a component are a path: the deepest is the centroid.
        centre = now.where(heavy).groupBy(*TOP).agg(F.max(F.struct("depth", "z1", "z2", "rows")).alias("x"))
        now = now.join(store(centre, "centroids"), TOP).select("*", F.when(F.col("depth") > F.col("x.depth"), F.col("x.depth") + 1).alias("look"))
        # The ancestor just below the centroid's depth, read off the node's first conversation.
        now = now.join(looked, ["first_conv", "look"], "left")
        is_x = (F.col("depth") == F.col("x.depth")) & (F.col("z1") == F.col("x.z1")) & (F.col("z2") == F.col("x.z2"))
        below = F.coalesce((F.col("l1") == F.col("x.z1")) & (F.col("l2") == F.col("x.z2")), F.lit(False))
        now = store(now.select(*state, "x", "look", "k1", "k2", is_x.alias("is_x"), below.alias("below"),
                               (heavy & ~is_x).alias("above")), "split")
        total = now.where("is_x or below").groupBy(*TOP).agg(*[F.sum(s).alias(f"total_{s}") for s in sums])
        now = now.join(total, TOP)
        on_path = F.col("is_x") | F.col("above")
        found = [F.when(on_path, F.col(f"f_{s}") + F.col(f"total_{s}")).otherwise(F.col(f"f_{s}")).alias(f"f_{s}") for s in sums]
        fewer = F.when(F.col("above"), F.col("rows") - F.col("x.rows")).otherwise(F.col("rows")).alias("rows")
        top = [F.when(F.col("below"), F.col(k)).otherwise(F.col(t)).alias(t) for t, k in zip(TOP, ("look", "k1", "k2"))]
        done.append(now.where("is_x").select(*KEY, *found))
        live = store(now.where("not is_x").select(*KEY, "p1", "p2", "first_conv", fewer, *sums, *top, *found), "components")
    rest = small[0]
    for s in small[1:]:
        rest = rest.union(s)
    out = finish(rest, sums)
    for d in done:
        out = out.union(d)
    return out.select(*KEY, *[F.col(f"f_{s}").alias(s) for s in sums])


def finish(rest: DataFrame, sums: Sequence[str]) -> DataFrame:
    """Components of bounded size, streamed through tasks in whole components."""
    names = [f"f_{s}" for s in sums]
    dealt = (rest.select(*TOP, *KEY, "p1", "p2", "rows", *sums, *names).repartition(*TOP).sortWithinPartitions(*TOP))

    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        col = {c: t.column(c).to_numpy() for c in t.column_names if c not in ("p1", "p2")}
        up = [t.column(c).combine_chunks().fill_null(0).to_numpy() for c in ("p1", "p2")]
        top = (col["depth"] == col["top_depth"]) & (col["z1"] == col["t1"]) & (col["z2"] == col["t2"])
        parent = parents(np.stack([col["z1"], col["z2"]]), np.stack(up), top)
        found = subtree_sums(parent, col["rows"], np.stack([col[s] for s in sums], axis=1))
        found += np.stack([col[f] for f in names], axis=1)
        return pa.RecordBatch.from_arrays([pa.array(col[c]) for c in KEY] + [pa.array(f) for f in found.T], [*KEY, *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            if size >= 1 << 15:
                # Everything before the last component that began in this batch is whole.
                tops = np.stack([b.column(k).to_numpy() for k in range(3)])
                last = held[-1]
                first = np.array([last.column(k)[last.num_rows - 1].as_py() for k in range(3)])
                new = np.flatnonzero((tops != np.column_stack([first, tops[:, :-1]])).any(axis=0))
                if len(new):
                    at = int(new[-1])
                    yield solve(held + [b.slice(0, at)] if at else held)
                    held, size, b = [], 0, b.slice(at)
            held.append(b)
            size += b.num_rows
        if held:
            yield solve(held)

    small_batches(rest.sparkSession)
    return dealt.mapInArrow(run, ", ".join(f"{c} long" for c in [*KEY, *names]))


def parents(key: np.ndarray, up: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Index of every node's parent; -1 for tops. ``key``, ``up``: [2, nodes]."""
    n = len(top)
    both = np.concatenate([key, up], axis=1)
    asks = np.arange(2 * n) >= n
    order = np.lexsort((asks, both[1], both[0]))
    # In order, a node stands before those that ask for it.
    at = np.maximum.accumulate(np.where(asks[order], -1, np.arange(2 * n)))
    parent = np.full(n, -1)
    parent[order[asks[order]] - n] = order[at[asks[order]]]
    parent[top] = -1
    return parent


def subtree_sums(parent: np.ndarray, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` ([nodes, sums]) over every subtree of a forest, by centroid
    decomposition. ``rows``: positive weights of the subtrees, each the weight of its
    top node plus its children's subtrees."""
    n, weight, found = len(parent), rows.copy(), np.zeros_like(values)
    comp = link_up(np.where(parent < 0, np.arange(n), parent), np.arange(n))
    live, total = np.arange(n), np.zeros_like(values)
    centroid, inner = np.full(n, -1), np.zeros(n, bool)
    link = np.empty(n, np.int64)
    while len(live):
        path = live[2 * weight[live] > weight[comp[live]]]
        # The last of the path has no child on it.
        under = path[comp[path] != path]
        inner[parent[under]] = True
        x = path[~inner[path]]
        inner[parent[under]] = False
        centroid[comp[x]] = x
        # New components: the centroid, its children's subtrees, the rest.
        mid = centroid[comp[live]]
        up = parent[live]
        own = (comp[live] == live) | (live == mid) | (up == mid)
        link[live] = np.where(own, live, up)
        new = link_up(link, live)[live]
        under = (new == mid) | (parent[new] == mid)
        total[x] = 0
        np.add.at(total, mid[under], values[live[under]])
        mid_path = centroid[comp[path]]
        found[path] += total[mid_path]
        weight[path] -= np.where(path == mid_path, 0, weight[mid_path])
        comp[live] = new
        live = live[live != mid]
    return found


def link_up(link: np.ndarray, live: np.ndarray) -> np.ndarray:
    """``link`` with every live node's pointer followed to its end."""
    while True:
        further = link[link[live]]
        if np.array_equal(further, link[live]):
            return link
        link[live] = further


def end_digests(rows: DataFrame, most: int = 4096) -> DataFrame:
    """Per node at which conversations end: its key and ``ends_sha256``, the SHA-256 of their ids
    in decimal, ascending, joined by commas. Ids are sorted over ranges of (node, id) and
    joined there in stretches; a node's stretches then go through one hash in order, a batch at a time."""
    ends = rows.where("len = depth").select(*KEY, "conv")
    ends = ends.repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            key = np.stack([b.column(k).to_numpy() for k in range(3)])
            at = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)]))
            ids = list(map(str, b.column(3).to_pylist()))
            texts = [",".join(ids[a:z]) for a, z in zip(at, np.append(at[1:], len(ids)))]
            yield pa.RecordBatch.from_arrays([b.column(k).take(pa.array(at)) for k in range(4)] + [pa.array(texts, pa.string())],
                                             [*KEY, "conv", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for b in batches:
            out = []
            for key, ids in zip(zip(*(b.column(k).to_pylist() for k in range(3))), b.column(4).to_pylist()):
                if key == now:
                    sha.update(b"," + ids.encode())
                    continue
                if now is not None:
                    out.append((*now, sha.hexdigest()))
                now, sha = key, hashlib.sha256(ids.encode())
            yield pack(out)
        if now is not None:
            yield pack([(*now, sha.hexdigest())])

    def pack(out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:3]] + [pa.array(cols[3], pa.string())],
                                          [*KEY, "ends_sha256"])

    small_batches(rows.sparkSession, most)
    key = ", ".join(f"{c} long" for c in KEY)
    texts = ends.mapInArrow(joined, f"{key}, conv long, ids string")
    dealt = texts.repartition(*KEY).sortWithinPartitions(*KEY, "conv")
    return dealt.mapInArrow(hashed, f"{key}, ends_sha256 string")


def trie(rows: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """All nodes of ``paths``, with ``n_leaves`` (childless nodes in the subtree) and
    ``saved_chars`` (what sharing saves in the subtree: a node's last text times the members but
    one) beside the columns of ``nodes``."""
    each = store(nodes(rows).select("*", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                                    ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_chars")), "trie")
    total = rollup(each, rows, ["n_leaves", "saved_chars"], local_nodes)
    return each.drop("n_leaves", "saved_chars", "p1", "p2", "rows").join(total, KEY)

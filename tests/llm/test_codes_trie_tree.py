"""Vector codes by Orchard search, the conversation trie, BPE by a segment tree."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recsmith.llm import bpe_tree, orchard_codes, prefix_trie
from recsmith.llm import queries as q

from tests.llm.conftest import odd_conversations, odd_documents, odd_embeddings


def rows_of(rows):
    return sorted(map(tuple, rows), key=repr)


# ------------------------------------------------------------------ vector codes
@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 40), st.integers(1, 20), st.integers(1, 9))
def test_orchard_is_nearest(seed, rows, entries, length):
    """Small whole numbers, so that many distances tie."""
    rng = np.random.default_rng(seed)
    sizes = orchard_codes.part_sizes(length, 3)
    books = orchard_codes.Books([rng.integers(-3, 4, (entries, s)) for s in sizes])
    x = rng.integers(-4, 5, (rows, length))
    code, dist = books.search(x)
    for p, part in enumerate(np.split(x, np.cumsum(sizes)[:-1], axis=1)):
        every = ((part[:, None, :] - books.entries[p][None]) ** 2).sum(axis=2)
        assert (code[:, p] == every.argmin(axis=1)).all() and (dist[:, p] == every.min(axis=1)).all()


def test_orchard_skips_most_entries(monkeypatch):
    """The stopping rule and the marks keep most entries of a clustered book unmeasured."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-4000, 4000, (64, 2))
    books = orchard_codes.Books([centres])
    x = centres[rng.integers(0, 64, 500)] + rng.integers(-40, 41, (500, 2))
    seen = []
    real = np.flatnonzero
    monkeypatch.setattr(orchard_codes.np, "flatnonzero", lambda a: seen.append(int(np.sum(a))) or real(a))
    books.search(x)
    assert sum(seen) < 500 * 25


def coded(rows, labels):
    """Contract of op11 by plain loops."""
    kept = [(k, i, v) for k, (i, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for d in {len(v) for _, _, v in kept}:
        same = sorted(((k, i, np.asarray(v, np.float32).astype(float)) for k, i, v in kept if len(v) == d),
                      key=lambda r: (r[1] is None, r[1] or 0, list(r[2])))
        x = np.floor(256 * np.array([v for *_, v in same]).reshape(len(same), d)).astype(int)
        parts = [x[:, p * d // 16:(p + 1) * d // 16] for p in range(16)]
        books = [p[:64].copy() for p in parts]
        for last in (False, False, True):
            code, error = np.zeros((len(same), 16), int), np.zeros(len(same), int)
            for p, (part, book) in enumerate(zip(parts, books)):
                every = ((part[:, None] - book[None]) ** 2).sum(axis=2)
                code[:, p], error = every.argmin(axis=1), error + every.min(axis=1)
                if not last:
                    for e in set(code[:, p]):
                        mine = part[code[:, p] == e]
                        book[e] = mine.sum(axis=0) // len(mine)
        sha = hashlib.sha256(",".join(str(c) for b in books for c in b.ravel()).encode()).hexdigest()
        for (k, i, _), c, e in zip(same, code, error):
            out[k] = (i, "".join(f"{a:02x}" for a in c), int(e), sha)
    total = {}
    for k, r in out.items():
        total[labels[k]] = total.get(labels[k], 0) + r[2]
    return [(i, c, e, total[labels[k]], s) for k, (i, c, e, s) in out.items()]


def test_op11_codes(spark, odd_dir):
    rows = odd_embeddings()
    labels = [None if k % 5 == 0 else k % 3 for k in range(len(rows))]
    got = q.QUERIES["op11_orchard"](spark, odd_dir).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert rows_of(got.collect()) == sorted(coded(rows, labels), key=repr)


def test_codes_stand_for_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=20).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    books = orchard_codes.learn(df, parts=5, entries=30, rounds=3, scale=1000)
    for r in orchard_codes.encode(df, books, scale=1000).collect():
        x = np.floor(1000 * np.array(rows[r.id][1]))
        assert ((x - books[20].decode(r.code)) ** 2).sum() == r.error
    first = orchard_codes.learn(df, parts=5, entries=30, rounds=0, scale=1000)
    error = lambda b: orchard_codes.encode(df, b, scale=1000).agg(F.sum("error")).first()[0]
    assert error(books) < error(first)


def test_too_large_components_are_refused(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        orchard_codes.learn(df, parts=2)


# -------------------------------------------------------------- conversation trie
def rebuilt(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, role, key, text))
    convs = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def tries(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for n in nodes:
        if n:
            children.setdefault(n[:-1], []).append(n)
    order = sorted(nodes, key=len, reverse=True)
    leaves, saved = {}, {}
    for n in order:
        mine = children.get(n, [])
        leaves[n] = sum(leaves[c] for c in mine) if mine else 1
        saved[n] = (len(nodes[n]) - 1) * (len(n[-1][1]) if n else 0) + sum(saved[c] for c in mine)
    out = []
    for n, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(n))
        out.append((min(members), len(n), min(nodes[n[:-1]]) if n else None, len(members), len(children.get(n, [])), leaves[n],
                    saved[n], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("local, block", [(1 << 17, 4096), (20, 7)])
def test_op12_nodes(spark, odd_dir, monkeypatch, local, block):
    """Both with components finished in tasks and split by joins, and with conversations in blocks."""
    trie, paths = prefix_trie.trie, prefix_trie.paths
    monkeypatch.setattr(q.prefix_trie, "trie", lambda rows: trie(rows, local))
    monkeypatch.setattr(q.prefix_trie, "paths", lambda rows, convs: paths(rows, convs, block))
    got = q.QUERIES["op12_prefix_trie"](spark, odd_dir).select(*COLUMNS)
    assert rows_of(got.collect()) == tries(rebuilt(odd_conversations()))


def test_trie_of_whole_conversations(spark):
    rows = [(c, t, "u", f"{t * (c % 3 if t > 2 else 1)}") for c in range(60) for t in range(c % 7 + 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    paths = prefix_trie.paths(*prefix_trie.whole(prefix_trie.turns(df)))
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((r, x))
    want = [r[:7] for r in tries(convs)]
    got = prefix_trie.trie(paths, 5).select("first_conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved_chars")
    assert rows_of(got.collect()) == sorted(want, key=repr)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 120), st.sampled_from(["wide", "deep", "any"]))
def test_subtree_sums(seed, n, shape):
    rng = random.Random(seed)
    pick = {"wide": lambda k: rng.choice([-1, 0]), "deep": lambda k: k - 1, "any": lambda k: rng.randrange(-1, k)}[shape]
    parent = np.array([-1] + [min(pick(k), k - 1) for k in range(1, n)])
    values = np.array([[rng.randrange(9), rng.randrange(-5, 5)] for _ in range(n)])
    own = np.array([rng.randrange(1, 5) for _ in range(n)])
    weight, want = own.copy(), values.copy()
    for k in range(n - 1, 0, -1):
        if parent[k] >= 0:
            weight[parent[k]] += weight[k]
            want[parent[k]] += want[k]
    shuffled = np.array(rng.sample(range(n), n))
    place = np.argsort(shuffled)
    moved = np.where(parent[shuffled] < 0, -1, place[parent[shuffled]])
    assert (prefix_trie.subtree_sums(moved, weight[shuffled], values[shuffled]) == want[shuffled]).all()


def test_components_halve():
    """A path of 4096 nodes is done in 13 levels, not in 4096."""
    n = 4096
    parent = np.arange(n) - 1
    rounds = []
    real = prefix_trie.link_up
    prefix_trie.link_up = lambda *a: rounds.append(1) or real(*a)
    try:
        found = prefix_trie.subtree_sums(parent, np.arange(n, 0, -1), np.ones((n, 1), np.int64))
    finally:
        prefix_trie.link_up = real
    assert (found[:, 0] == np.arange(n, 0, -1)).all() and len(rounds) <= 14


def test_end_digests_over_batches(spark):
    """A node at which thousands end, spread over tasks and batches."""
    rows = spark.range(5000).select(F.col("id").alias("conv"), F.lit(1).cast("long").alias("depth"), F.lit(1).cast("long").alias("len"),
                                    F.lit(5).cast("long").alias("z1"), F.floor(F.col("id") % 1000 / 999).alias("z2")).repartition(6)
    got = {r.z2: r.ends_sha256 for r in prefix_trie.end_digests(rows, 64).collect()}
    for z in (0, 1):
        ids = ",".join(str(i) for i in range(5000) if i % 1000 // 999 == z)
        assert got[z] == hashlib.sha256(ids.encode()).hexdigest()


# ------------------------------------------------------------------ segment tree
@pytest.fixture(scope="module")
def encoder():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        return bpe_tree.TextEncoder(f.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdeé \n\t's'll12ñ½\x1c\x85\xa0世😀_!AB", max_size=80), st.sampled_from(["", "<|endoftext|>", "<|endoftext"]))
def test_tree_as_library(encoder, library, text, extra):
    text = text[:9] + extra + text[9:]
    ids = np.frombuffer(encoder.encode([text])[0], "<i4").tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=40), min_size=1, max_size=60))
def test_trees_side_by_side(encoder, pieces):
    """Many trees at once give what one at a time gives, and what rescanning for the best pair gives."""
    merges = encoder.merges
    together = [x.tolist() for x in bpe_tree.merge_many(merges, pieces * 25)]
    assert together[:len(pieces)] * 25 == together
    for piece, ids in zip(pieces, together):
        plain = merges.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        assert bpe_tree.PairTree(merges, plain).ids() == ids
        while True:
            ranked = [(merges.rank.get(a << 32 | b, 1 << 62), i) for i, (a, b) in enumerate(zip(plain, plain[1:]))]
            rank, i = min(ranked, default=(1 << 62, 0))
            if rank == 1 << 62:
                break
            plain[i:i + 2] = [int(merges.made[rank])]
        assert plain == ids


def test_long_pieces(encoder, library):
    for text in ("B" * 30_000, "abcé" * 8_000, "x" * 2, "漢" * 9_000):
        assert np.frombuffer(encoder.encode([text])[0], "<i4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_decode_of_any_ids(encoder, library):
    rng = random.Random(3)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(12))]
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_op13_ids(spark, odd_dir, library):
    want = []
    for r in odd_documents():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert rows_of(q.QUERIES["op13_bpe_tree"](spark, odd_dir).collect()) == sorted(want, key=repr)


def test_other_tokenizers_are_refused(spark):
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        raw = f.read()
    with pytest.raises(ValueError):
        bpe_tree.TextEncoder(raw, public_tokenizers.PATTERN)

"""Byte-level BPE encoding by a segment tree over the ranks of neighbouring pairs.

A text is cut at the tokenizer's added tokens and split by its pattern. The
symbols of a piece are its bytes; leaf ``p`` of the piece's segment tree holds the
rank of the pair that starts at symbol ``p`` together with ``p``, or nothing where no
merge fits. Every inner node holds the smaller of its children, so the root is the
lowest-ranked pair, the leftmost of equal ones. Merging it changes three leaves (the
pair itself, the one before, the one that vanishes) and their paths to the root: a
number of steps logarithmic in the piece. It ends when the root is empty.

``PairTree`` is that tree for one piece. ``merge_many`` keeps the trees of many short
pieces as the rows of one array and merges the roots of all of them at a time.

Spark runs ``encode_documents`` per Arrow batch, with the tokenizer (a fixed-size
file, checked) broadcast once; no shuffle.

Defined cases: null text is encoded as empty; an empty text has no ids and decodes to
an empty text; an added token in a text is its one id, as the library gives by
default; repeated rows and null ids stay as they are; other columns are not read.
Tokenizers with other parts than byte-level splitting, plain BPE merges and plain added tokens
are refused.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recsmith.llm.bpe_prefix import CACHED_PIECE, MAX_VOCAB_BYTES, Splitter
from recsmith.llm.common import map_batches

# Encoded pieces a worker remembers before it starts afresh.
CACHE = 600_000
# Leaves of all trees that are merged together, and trees below which each goes alone.
LOCKSTEP_LEAVES = 1 << 17
LOCKSTEP_ROWS = 24
EMPTY = np.iinfo(np.int64).max


def byte_characters() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: printable Latin-1 bytes stand for
    themselves, the others are numbered from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """The merges of a tokenizer file as sorted arrays (many pairs at once) and as
    a dictionary (one pair)."""

    def __init__(self, spec: dict):
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        extra = [spec.get("normalizer"), spec.get("post_processor"), model.get("dropout"), model.get("unk_token"),
                 model.get("continuing_subword_prefix"), model.get("end_of_word_suffix"), model.get("byte_fallback"),
                 model.get("ignore_merges"), before.get("add_prefix_space")]
        if model.get("type") != "BPE" or before.get("type") != "ByteLevel" or not before.get("use_regex") or any(extra):
            raise ValueError("not a plain byte-level BPE tokenizer")
        if (spec["decoder"] or {}).get("type") != "ByteLevel":
            raise ValueError("not a byte-level decoder")
        vocab, alphabet = model["vocab"], byte_characters()
        self.byte_id = np.zeros(256, np.int64)
        for c, b in alphabet.items():
            self.byte_id[b] = vocab[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        # Of a pair that is listed twice the later rank holds, as in the library.
        self.rank = dict(zip(keys.tolist(), range(len(keys))))
        self.keys = np.array(sorted(self.rank), np.int64)
        self.ranks = np.array([self.rank[k] for k in self.keys.tolist()], np.int64)
        self.token = {i: bytes(alphabet[c] for c in t) for t, i in vocab.items()}

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair, EMPTY where none merges."""
        key = left << 32 | right
        if not len(self.keys):
            return np.full(key.shape, EMPTY)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], EMPTY)


class PairTree:
    """Segment tree over the pairs of one piece's symbols."""

    def __init__(self, merges: Merges, symbols: list[int]):
        self.rank, self.made = merges.rank, merges.made
        n = len(symbols)
        self.sym, self.next, self.prev = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
        self.leaves = 1 << max(n - 2, 0).bit_length()
        self.tree = [EMPTY] * (2 * self.leaves)
        for p in range(n - 1):
            self.tree[self.leaves + p] = self.key(p)
        for i in range(self.leaves - 1, 0, -1):
            self.tree[i] = min(self.tree[2 * i], self.tree[2 * i + 1])

    def key(self, p: int) -> int:
        """Rank and place of the pair that starts at symbol ``p``."""
        q = self.next[p]
        if q == len(self.sym):
            return EMPTY
        rank = self.rank.get(self.sym[p] << 32 | self.sym[q])
        return EMPTY if rank is None else rank << 32 | p

    def update(self, p: int, key: int) -> None:
        """Set a leaf; its path changes as far up as the smallest key does."""
        tree, i = self.tree, self.leaves + p
        tree[i] = key
        while i > 1:
            i >>= 1
            low = min(tree[2 * i], tree[2 * i + 1])
            if tree[i] == low:
                break
            tree[i] = low

    def merge(self) -> bool:
        """Merge the pair at the root; False if there is none."""
        if self.tree[1] == EMPTY:
            return False
        p, rank = self.tree[1] & 0xFFFFFFFF, self.tree[1] >> 32
        q = self.next[p]
        after, before = self.next[q], self.prev[p]
        self.sym[p], self.sym[q], self.next[p] = int(self.made[rank]), -1, after
        if after < len(self.sym):
            self.prev[after] = p
        if q < self.leaves:
            self.update(q, EMPTY)
        self.update(p, self.key(p))
        if before >= 0:
            self.update(before, self.key(before))
        return True

    def ids(self) -> list[int]:
        while self.merge():
            pass
        return [s for s in self.sym if s >= 0]


def merge_rows(merges: Merges, sym: np.ndarray) -> np.ndarray:
    """Symbols after all merges of every row of ``sym`` ([pieces, leaves + 1], filled
    up with -1); places merged away are -1. The trees are the rows of one array,
    and a step merges the root of every row that has one."""
    n, width = sym.shape
    leaves = width - 1
    done, rows = sym.copy(), np.arange(n)
    place = np.arange(width)
    after = np.broadcast_to(place + 1, sym.shape).copy()
    before = np.broadcast_to(place - 1, sym.shape).copy()
    tree = np.full((n, 2 * leaves), EMPTY)
    rank = merges.ranks_of(sym[:, :-1], sym[:, 1:])
    tree[:, leaves:] = np.where(rank < EMPTY, rank << 32 | place[:-1], EMPTY)
    low = leaves
    while low > 1:
        tree[:, low // 2:low] = np.minimum(tree[:, low:2 * low:2], tree[:, low + 1:2 * low:2])
        low //= 2
    while True:
        live = tree[:, 1] < EMPTY
        if not live.all():
            done[rows[~live]] = sym[~live]
            rows, sym, after, before, tree = rows[live], sym[live], after[live], before[live], tree[live]
            if not len(rows):
                return done
        r, root = np.arange(len(rows)), tree[:, 1]
        p, new = root & 0xFFFFFFFF, merges.made[root >> 32]
        q = after[r, p]
        end, start = after[r, q], before[r, p]
        sym[r, p], sym[r, q], after[r, p] = new, -1, end
        inner = np.flatnonzero(end < width)
        before[inner, end[inner]] = p[inner]
        # The symbol after the merged one, -1 past the row's end: no pair has it.
        right = np.where(end < width, sym[r, np.minimum(end, leaves)], -1)
        rank = merges.ranks_of(np.concatenate([new, sym[r, np.maximum(start, 0)]]), np.concatenate([right, new]))
        first = start >= 0
        rank = np.where(rank < EMPTY, rank << 32 | np.concatenate([p, np.maximum(start, 0)]), EMPTY)
        gone = q < leaves
        at_row = np.concatenate([r[gone], r, r[first]])
        at = leaves + np.concatenate([q[gone], p, start[first]])
        tree[at_row, at] = np.concatenate([np.full(int(gone.sum()), EMPTY), rank[:len(r)], rank[len(r):][first]])
        step = leaves
        while step > 1:
            at >>= 1
            tree[at_row, at] = np.minimum(tree[at_row, 2 * at], tree[at_row, 2 * at + 1])
            step >>= 1


def merge_many(merges: Merges, pieces: list[bytes]) -> list[np.ndarray]:
    """Ids of every piece. Pieces whose trees have equally many leaves are merged
    together; where there are few, each has a tree of its own."""
    out: list[np.ndarray | None] = [None] * len(pieces)
    size = np.array([len(p) for p in pieces], np.int64)
    leaves = np.array([0 if n < 2 else 1 << (n - 2).bit_length() for n in size.tolist()], np.int64)
    for k in np.unique(leaves).tolist():
        group = np.flatnonzero(leaves == k)
        if k == 0:
            for g in group.tolist():
                out[g] = merges.byte_id[np.frombuffer(pieces[g], np.uint8)]
            continue
        step = max(1, LOCKSTEP_LEAVES // k)
        for at in range(0, len(group), step):
            some = group[at:at + step]
            if len(some) < LOCKSTEP_ROWS:
                for g in some.tolist():
                    symbols = merges.byte_id[np.frombuffer(pieces[g], np.uint8)].tolist()
                    out[g] = np.array(PairTree(merges, symbols).ids(), np.int64)
                continue
            sym = np.full((len(some), k + 1), -1, np.int64)
            filled = np.arange(k + 1) < size[some][:, None]
            sym[filled] = merges.byte_id[np.frombuffer(b"".join(pieces[g] for g in some.tolist()), np.uint8)]
            sym = merge_rows(merges, sym)
            kept = sym >= 0
            for g, ids in zip(some.tolist(), np.split(sym[kept], np.cumsum(kept.sum(axis=1))[:-1])):
                out[g] = ids
    return out


class TextEncoder(dict):
    """Texts to ids and back; as a dict it remembers the encoded pieces as
    little-endian 32-bit ids."""

    def __init__(self, raw: bytes, pattern: str):
        super().__init__()
        spec = json.loads(raw.decode("utf-8"))
        self.merges, self.splitter = Merges(spec), Splitter(pattern)
        added = spec.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens that take in what is around them are not supported")
        self.added = {t["content"]: np.array([t["id"]], "<i4").tobytes() for t in added}
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if added else None
        self.token = dict(self.merges.token)
        self.token.update((t["id"], t["content"].encode("utf-8")) for t in added)
        self.update(self.added)

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text; an added token is one."""
        if not any(t in text for t in self.added):
            return self.splitter.split(text)
        return [p for k, part in enumerate(self.cut.split(text))
                for p in ([part] if k % 2 else self.splitter.split(part))]

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.pieces(t) for t in texts]
        fresh = set().union(*split).difference(self)
        if len(self) + len(fresh) > CACHE:
            self.clear()
            self.update(self.added)
            fresh = set().union(*split).difference(self)
        new = list(fresh)
        self.update(zip(new, (ids.astype("<i4").tobytes() for ids in
                              merge_many(self.merges, [p.encode("utf-8") for p in new]))))
        out = [b"".join(map(self.__getitem__, pieces)) for pieces in split]
        for p in new:
            if len(p) > CACHED_PIECE:
                del self[p]
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters and
        ids that stand for nothing are left out, as in the library."""
        return b"".join(self.token.get(i, b"") for i in ids).decode("utf-8", "replace")


_ENCODERS: dict[str, TextEncoder] = {}


def _encoder(key: str, raw, pattern: str) -> TextEncoder:
    """This worker's encoder for a tokenizer, kept between tasks."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = TextEncoder(raw.value, pattern)
    return _ENCODERS[key]


class TokenizerFile:
    """A tokenizer file and its split pattern, broadcast to the executors."""

    def __init__(self, spark, path: str, pattern: str):
        with open(path, "rb") as f:
            raw = f.read(MAX_VOCAB_BYTES + 1)
        if len(raw) > MAX_VOCAB_BYTES:
            raise ValueError(f"tokenizer file over {MAX_VOCAB_BYTES} bytes")
        self.key = hashlib.sha256(raw + pattern.encode()).hexdigest()
        self.raw, self.pattern = spark.sparkContext.broadcast(raw), pattern


def encode_documents(df: DataFrame, tokenizer: TokenizerFile, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``ids`` (array of int) of every row, and ``decoded``, the text that the
    ids stand for."""
    key, raw, pattern = tokenizer.key, tokenizer.raw, tokenizer.pattern

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = _encoder(key, raw, pattern)
        ids = enc.encode([t or "" for t in b.column(1).to_pylist()])
        ends = np.cumsum([0] + [len(x) // 4 for x in ids])
        flat = np.frombuffer(b"".join(ids), "<i4")
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
        texts = [enc.decode(flat[a:z].tolist()) for a, z in zip(ends[:-1].tolist(), ends[1:].tolist())]
        return pa.RecordBatch.from_arrays([b.column(0), lists, pa.array(texts, pa.string())], ["id", "ids", "decoded"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>, decoded string")

"""Byte-level BPE encoding by prefix dynamic programming.

A text is split by the vocabulary's pattern and every piece is encoded on its
own. Inside a piece the encoder keeps, for each byte prefix, the last token of
that prefix's encoding. It is unique: a token ``t`` that ends at ``i`` and
starts at ``j`` is the one exactly if it may stand after the stored last token
of the prefix that ends at ``j`` (the two tokens' joined bytes encode to just
those two, so no merge crosses their boundary). Walking back through the
stored tokens gives the encoding, appending bytes only extends the table, and
after an edit only the positions up to where the table agrees again are redone.

Spark runs ``encode_documents`` / ``decode_documents`` per Arrow batch, with the
vocabulary (a fixed-size file, checked) broadcast once; no shuffle.

Defined cases: null text is encoded as empty; an empty text has no ids;
repeated rows and null ids stay as they are; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from recsmith.llm.common import map_batches

# A vocabulary file is broadcast; anything larger than this is refused.
MAX_VOCAB_BYTES = 64 << 20
# Encoded pieces and token pairs a worker remembers before it starts afresh.
CACHE = 200_000
# Longer pieces are not remembered.
CACHED_PIECE = 64


def load_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes -> id of a rank file (base64 token, id per line)."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}


class PrefixBPE:
    """Encoder of single pieces (bytes) for a rank vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = [b""] * (max(ranks.values()) + 1)
        self.automaton = ahocorasick.Automaton()
        for tok, i in ranks.items():
            self.token[i] = tok
            self.automaton.add_word(tok.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.size = [len(t) for t in self.token]
        self.longest = max(self.size)
        self._fits: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """Encoding by repeated merging of the lowest-ranked pair, for the few
        bytes of one or two tokens."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(parts[i] + parts[i + 1], 1 << 62), i) for i in range(len(parts) - 1)]
            rank, i = min(ranked)
            if rank == 1 << 62:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def whole(self, t: int) -> bool:
        """Does the token's own text encode to that token?"""
        known = self._whole.get(t)
        if known is None:
            known = self._whole[t] = self.merge(self.token[t]) == [t]
        return known

    def fits(self, a: int, b: int) -> bool:
        """May token ``b`` stand directly after token ``a``?"""
        pair = a << 32 | b
        known = self._fits.get(pair)
        if known is None:
            if len(self._fits) >= CACHE:
                self._fits.clear()
            known = self._fits[pair] = self.merge(self.token[a] + self.token[b]) == [a, b]
        return known

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Complete ``last`` (last tokens of the first prefixes of ``data``) in place."""
        have = len(last)
        base = max(0, have - self.longest + 1)
        for end, t in self.automaton.iter(data[base:].decode("latin-1")):
            end += base
            if end < len(last):
                continue
            start = end + 1 - self.size[t]
            if start < base:
                continue
            if self.fits(last[start - 1], t) if start else self.whole(t):
                last.append(t)
        return last

    def walk(self, last: list[int]) -> list[int]:
        """Token ids from the table of last tokens."""
        out, at = [], len(last)
        while at:
            t = last[at - 1]
            out.append(t)
            at -= self.size[t]
        return out[::-1]

    def encode(self, data: bytes) -> list[int]:
        return self.walk(self.extend(data, []))


class PieceEncoding:
    """An editable encoded piece: ``ids`` after appends and edits."""

    def __init__(self, bpe: PrefixBPE, data: bytes = b""):
        self.bpe, self.data = bpe, data
        self.last = bpe.extend(data, [])

    @property
    def ids(self) -> list[int]:
        return self.bpe.walk(self.last)

    def append(self, more: bytes) -> None:
        self.data += more
        self.bpe.extend(self.data, self.last)

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace bytes ``start`` to ``end``; returns the positions redone. The
        table agrees with the old one for good once as many positions in a row
        agree as the longest token has bytes."""
        tail, old = self.data[end:], self.last[end:]
        self.data = self.data[:start] + new + tail
        del self.last[start:]
        self.bpe.extend(self.data[:start + len(new)], self.last)
        redone, same, step = len(new), 0, self.bpe.longest
        for at in range(0, len(tail), step):
            self.bpe.extend(self.data[:start + len(new) + min(at + step, len(tail))], self.last)
            for k in range(at, min(at + step, len(tail))):
                same = same + 1 if self.last[start + len(new) + k] == old[k] else 0
                redone += 1
            if same >= step:
                self.last.extend(old[at + step:])
                break
        return redone


class Splitter:
    """``findall`` of the pattern; texts within Latin-1 take an equivalent
    pattern for the standard engine, made of the same character classes."""

    def __init__(self, pattern: str):
        self.full = regex.compile(pattern)
        chars = [chr(i) for i in range(256)]
        pick = lambda ok: "".join(re.escape(c) for c in chars if ok(c))
        letter = pick(lambda c: unicodedata.category(c)[0] == "L")
        number = pick(lambda c: unicodedata.category(c)[0] == "N")
        space = pick(lambda c: regex.match(r"\s", c))
        self.fast = None
        if pattern == r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""":
            self.fast = re.compile(f" ?[{letter}]+|'(?:[stmd]|re|ve|ll)| ?[{number}]+"
                                   f"| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")

    def split(self, text: str) -> list[str]:
        if self.fast is not None:
            try:
                text.encode("latin-1")
                return self.fast.findall(text)
            except UnicodeEncodeError:
                pass
        return self.full.findall(text)


class TextEncoder(dict):
    """Texts to ids as little-endian unsigned 32-bit integers; as a dict it
    remembers the encoded pieces."""

    def __init__(self, raw: bytes, pattern: str):
        super().__init__()
        self.bpe, self.splitter = PrefixBPE(load_ranks(raw)), Splitter(pattern)

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.bpe.encode(piece.encode("utf-8")), "<u4").tobytes()
        if len(piece) <= CACHED_PIECE:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.splitter.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return decode(ids, self.bpe.token)


def decode(ids: bytes, token: list[bytes]) -> bytes:
    """The bytes that ids (little-endian unsigned 32-bit) stand for."""
    return b"".join(map(token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_ENCODERS: dict[str, TextEncoder] = {}


def _encoder(key: str, raw, pattern: str) -> TextEncoder:
    """This worker's encoder for a vocabulary, kept between tasks."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = TextEncoder(raw.value, pattern)
    return _ENCODERS[key]


class Vocabulary:
    """A rank file and its split pattern, broadcast to the executors."""

    def __init__(self, spark, path: str, pattern: str):
        with open(path, "rb") as f:
            raw = f.read(MAX_VOCAB_BYTES + 1)
        if len(raw) > MAX_VOCAB_BYTES:
            raise ValueError(f"vocabulary over {MAX_VOCAB_BYTES} bytes")
        self.key = hashlib.sha256(raw + pattern.encode()).hexdigest()
        self.raw, self.pattern = spark.sparkContext.broadcast(raw), pattern


def encode_documents(df: DataFrame, vocab: Vocabulary, id_col: str = "doc_id", text: str = "text",
                     decoded: bool = False) -> DataFrame:
    """``id``, ``ids`` (little-endian unsigned 32-bit integers) of every row; with
    ``decoded`` also the bytes the ids stand for, by the same worker, so that a
    task needs one Python process only."""
    key, raw, pattern = vocab.key, vocab.raw, vocab.pattern

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = _encoder(key, raw, pattern)
        ids = [enc.encode(t) if t else b"" for t in b.column(1).to_pylist()]
        cols, names = [b.column(0), pa.array(ids, pa.binary())], ["id", "ids"]
        if decoded:
            cols.append(pa.array([enc.decode(x) for x in ids], pa.binary()))
            names.append("decoded")
        return pa.RecordBatch.from_arrays(cols, names)

    rows = df.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, ids binary"
                       + ", decoded binary" * decoded)


def decode_documents(encoded: DataFrame, vocab: Vocabulary, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that ``ids`` stand for as binary column ``name``."""
    raw = vocab.raw
    token: list[bytes] = []

    @F.pandas_udf("binary")
    def decoded(col: pd.Series) -> pd.Series:
        if not token:
            ranks = load_ranks(raw.value)
            token.extend([b""] * (max(ranks.values()) + 1))
            for t, i in ranks.items():
                token[i] = t
        return pd.Series([decode(bytes(x), token) for x in col], dtype=object)

    return encoded.withColumn(name, decoded(F.col(ids)))

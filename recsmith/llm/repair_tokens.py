"""Token ids in binary shards compressed by Re-Pair grammars.

Every document is encoded, ended with an end id, and written in id order. A
shard holds a bounded number of ids of consecutive documents. Its grammar is
grown by rounds: count the neighbouring id pairs, turn the most frequent ones
into nonterminals, replace their occurrences (where two overlap, the more
frequent pair, then the left one, wins), until no pair is frequent. A pair that was
rare once can only get rarer unless it holds a new symbol, so later rounds count
frequent pairs and the neighbours of replaced places only. A pair becomes a nonterminal
only if it is replaced twice at least (others wait for a later round), and a rule that is
left with one use in the end is written out there, so every stored rule is used at least
twice. Rules and the length each nonterminal expands to are stored with the shortened
sequence, so any range of ids is decoded from the few symbols that cover it; all
numbers are packed into as many bits as the largest needs.

A shard is one row of a Parquet table (``SHARD``), written through Spark to any
storage it reaches. Documents are dealt to ranges of ids and sorted there, and
shards are cut while a task streams through its range: no group is collected.
Global starts come from a running sum over one small row per shard.

Defined cases: null text is empty (only its end id); an added token of
the tokenizer in a text is its one id, as the library does; null ids come first;
repeated ids keep all their rows, in the order of their texts' keys; an empty
table gives no shard; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from recsmith.llm.bpe_prefix import CACHED_PIECE, MAX_VOCAB_BYTES, Splitter
from recsmith.llm.common import shuffle_partitions, small_batches, store, text_key

# Ids of a shard, new symbols of a round, and the count below which a pair stays.
SHARD_IDS = 1 << 20
ROUND_RULES = 3500
MIN_COUNT = 4
TABLE_BITS = 16
FILTER_BITS = 20

# Pieces a worker remembers, and pieces encoded as one text.
TOKEN_CACHE = 900_000
ROW_PIECES = 2000

SHARD = ("part int, block int, n_docs long, n_ids long, doc_ids binary, nulls binary, doc_sizes binary, "
         "base long, n_rules long, n_symbols long, width int, rules binary, size_width int, rule_sizes binary, "
         "length_width int, lengths binary, sequence binary")


# ---- grammar -------------------------------------------------------------

def pair_keys(left: np.ndarray, right: np.ndarray, wide: bool) -> np.ndarray:
    """Neighbouring symbols as one number; half as wide if the symbols allow."""
    if not wide:
        return left << np.uint32(16) | right
    return left.astype(np.uint64) << np.uint64(32) | right


def slots(keys: np.ndarray, bits: int) -> np.ndarray:
    """Hash-table places of pair keys."""
    wide = keys.dtype.itemsize * 8
    return (keys * keys.dtype.type(0x9E3779B97F4A7C15 >> (64 - wide))) >> keys.dtype.type(wide - bits)


def frequent_pairs(keys: np.ndarray, most: int, least: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs by falling count, each with a table place of its own (of two pairs
    that share one, the rarer waits for a later round), and all pairs of ``least``
    or more. Equal counts are ordered by a hash, so that the pairs of a chain are
    not all in line."""
    pair = np.sort(keys)
    at = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    count = np.diff(np.append(at, len(pair)))
    good = np.flatnonzero(count >= least)
    every = pair[at[good]]
    place = slots(every, bits)
    best = np.lexsort((place, -count[good]))[:most]
    _, first = np.unique(place[best], return_index=True)
    return every[best[np.sort(first)]], every


def occurrences(where: np.ndarray, live: np.ndarray, passes: int = 3) -> np.ndarray:
    """Which of the places ``where`` to replace, no two overlapping. ``live``: rank of
    the chosen pair that starts at each. A pair gives way to an overlapping one of
    better rank; in a run of one id every second counts. Later passes fill the gaps
    that are left."""
    place, found = np.arange(len(where)), []
    for _ in range(passes):
        if not len(where):
            break
        joins = np.zeros(len(where) + 1, bool)
        np.equal(where[1:], where[:-1] + 1, out=joins[1:-1])
        lower = live[1:] < live[:-1]
        lost, tied = np.zeros(len(where), bool), np.zeros(len(where), bool)
        lost[:-1] = lower & joins[1:-1]
        lost[1:] |= (live[1:] > live[:-1]) & joins[1:-1]
        at = np.flatnonzero(~lost)
        # Equal neighbours are a run of one id: keep the 1st, 3rd, ... of its winners.
        tied[1:] = (live[1:] == live[:-1]) & joins[1:-1] & ~lost[:-1]
        if tied.any():
            start = np.flatnonzero(~lost & ~tied)
            at = at[(at - start[np.searchsorted(start, at, side="right") - 1]) % 2 == 0]
        found.append(place[at])
        lost[:] = True
        lost[at] = False
        left = at[joins[at]] - 1
        right = at[joins[at + 1]] + 1
        keep = lost
        keep[left] = keep[right] = False
        where, live, place = where[keep], live[keep], place[keep]
    return np.concatenate(found) if found else np.empty(0, np.int64)


def chosen_places(keys: np.ndarray, place: np.ndarray, at: np.ndarray, pairs: np.ndarray,
                  bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (of ``at``, with ``keys`` and their table ``place``) to replace, and the ranks of their pairs."""
    ranks, held = np.full(1 << bits, -1, np.int32), np.zeros(1 << bits, keys.dtype)
    own = slots(pairs, bits)
    ranks[own], held[own] = np.arange(len(pairs)), pairs
    hit = np.flatnonzero(held.take(place, mode="clip") == keys)
    rank = ranks.take(place.take(hit), mode="clip")
    if (rank < 0).any():
        # The pair 0, 0 looks like a place without a pair.
        hit, rank = hit[rank >= 0], rank[rank >= 0]
    hit = at.take(hit)
    found = occurrences(hit, rank)
    return hit[found], rank[found]


def compress(ids: np.ndarray, base: int, per_round: int = ROUND_RULES,
             least: int = MIN_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rules (all their symbols in a row, and how many each has; rule k makes symbol base + k), the
    number of ids each expands to, and the sequence, in which no pair is left ``least`` times."""
    seq, rules, lengths = ids.astype(np.uint32), [np.empty((0, 2), np.uint32)], np.empty(0, np.int64)
    # Where a pair starts that may be frequent.
    at = np.arange(max(len(seq) - 1, 0))
    while len(at):
        wide = base + len(lengths) > 1 << 16
        keys = pair_keys(seq.take(at), seq.take(at + 1), wide)
        pairs, every = frequent_pairs(keys, per_round, least, TABLE_BITS)
        if not len(pairs):
            break
        # The table's places are the first bits of the filter's.
        slot = slots(keys, FILTER_BITS).astype(np.int64)
        place, rank = chosen_places(keys, slot >> (FILTER_BITS - TABLE_BITS), at, pairs, TABLE_BITS)
        # A pair that lost its places to better ones gets no symbol yet. The best pair loses
        # places only to itself (a short run of one id): then it is no longer looked at.
        won = np.bincount(rank, minlength=len(pairs)) >= 2
        if not won.any():
            at = at[keys != pairs[0]]
            continue
        kept = won[rank]
        place, rank, pairs = place[kept], (np.cumsum(won) - 1)[rank[kept]], pairs[won]
        half = keys.dtype.type(keys.dtype.itemsize * 4)
        new = np.stack([pairs >> half, pairs & ((keys.dtype.type(1) << half) - keys.dtype.type(1))], axis=1).astype(np.uint32)
        # Frequent pairs stay in view (some rare ones with them, by their hash), and so
        # do the pairs that the new symbols make.
        frequent = np.zeros(1 << FILTER_BITS, bool)
        frequent[slots(every, FILTER_BITS)] = True
        view, keep = np.zeros(len(seq), bool), np.ones(len(seq), bool)
        view[at[frequent.take(slot, mode="clip")]] = True
        view[place] = True
        seq[place] = base + len(lengths) + rank.astype(np.int64)
        keep[place + 1] = False
        # The symbol before a place: the one at place - 1, or a new one at place - 2.
        before = place[place > 0] - 1
        view[before] = True
        view[before[~keep[before]] - 1] = True
        keep = np.flatnonzero(keep)
        seq = seq[keep]
        at = np.flatnonzero(view[keep[:-1]])
        size = np.where(new < base, 1, 0).astype(np.int64)
        old = new >= base
        size[old] = lengths[new[old] - base]
        rules.append(new)
        lengths = np.concatenate([lengths, size.sum(axis=1)])
    return write_out_single(np.concatenate(rules).ravel(), np.full(len(lengths), 2), lengths, seq, base)


def write_out_single(rules: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, seq: np.ndarray,
                     base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The grammar with the rules that are used once put in place of their one use."""
    uses = np.bincount(np.concatenate([rules, seq])[np.concatenate([rules, seq]) >= base].astype(np.int64) - base,
                       minlength=len(sizes))
    single = uses < 2
    if not single.any():
        return rules, sizes, lengths, seq
    # Bodies of all rules with the single ones written out; those of the rules that stay; the sequence.
    first = np.cumsum(sizes) - sizes
    while True:
        nested = single_symbols(rules, single, base)
        if not nested.any():
            break
        rules, size = unfold(rules, nested, rules, first, sizes, base)
        ends = np.concatenate([[0], np.cumsum(size)])
        # A single rule is written out where it is used, so its own body is looked at no more.
        sizes, first = ends[first + sizes] - ends[first], ends[first]
    seq, _ = unfold(seq, single_symbols(seq, single, base), rules, first, sizes, base)
    body = rules[np.repeat(~single, sizes)]
    number = np.cumsum(~single) - 1
    for part in (body, seq):
        symbol = part >= base
        part[symbol] = base + number[part[symbol].astype(np.int64) - base]
    return body, sizes[~single], lengths[~single], seq


def single_symbols(symbols: np.ndarray, single: np.ndarray, base: int) -> np.ndarray:
    """Which symbols stand for rules that are ``single``."""
    nested = symbols >= base
    nested[nested] = single[symbols[nested].astype(np.int64) - base]
    return nested


def unfold(seq: np.ndarray, nested: np.ndarray, rules: np.ndarray, first: np.ndarray, sizes: np.ndarray,
           base: int) -> tuple[np.ndarray, np.ndarray]:
    """``seq`` with the bodies of the ``nested`` symbols in their place, and how many symbols
    each has become. Bodies start at ``first`` of ``rules`` and have ``sizes`` symbols."""
    size = np.ones(len(seq), np.int64)
    begin = np.arange(len(rules), len(rules) + len(seq))
    rule = seq[nested].astype(np.int64) - base
    size[nested], begin[nested] = sizes[rule], first[rule]
    ends = np.cumsum(size)
    source = np.repeat(begin - ends + size, size)
    source += np.arange(len(source))
    return np.concatenate([rules, seq])[source], size


def expand(seq: np.ndarray, rules: np.ndarray, sizes: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for."""
    seq, first = seq.astype(np.uint32), np.cumsum(sizes) - sizes
    while True:
        nested = seq >= base
        if not nested.any():
            return seq
        seq, _ = unfold(seq, nested, rules, first, sizes, base)


def bits_of(values: np.ndarray) -> int:
    return max(1, int(values.max()).bit_length()) if len(values) else 1


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """Numbers of ``width`` bits in a row; eight of them fill ``width`` bytes."""
    eight = np.append(values, np.zeros(-len(values) % 8, values.dtype)).reshape(-1, 8).T.astype(np.uint64)
    out = np.zeros((width + 4, eight.shape[1]), np.uint8)
    for k in range(8):
        # Five bytes hold any number of up to 32 bits that starts inside the first.
        first, skip = divmod(k * width, 8)
        shifted = eight[k] << np.uint64(40 - width - skip)
        for j in range((skip + width + 7) // 8):
            out[first + j] |= (shifted >> np.uint64(32 - 8 * j)).astype(np.uint8)
    return out[:width].T.tobytes()[:(len(values) * width + 7) // 8]


def unpack_bits(data: bytes, width: int, n: int) -> np.ndarray:
    rows = (n + 7) // 8
    each = np.zeros(rows * width, np.uint8)
    each[:min(len(data), len(each))] = np.frombuffer(data, np.uint8)[:len(each)]
    each = each.reshape(rows, width).T.astype(np.uint64)
    out = np.empty((rows, 8), np.uint32)
    for k in range(8):
        first, skip = divmod(k * width, 8)
        n_bytes = (skip + width + 7) // 8
        value = each[first].copy()
        for j in range(1, n_bytes):
            value = value << np.uint64(8) | each[first + j]
        out[:, k] = value >> np.uint64(8 * n_bytes - skip - width) & np.uint64((1 << width) - 1)
    return out.ravel()[:n]


class Shard:
    """A shard row opened for reading."""

    def __init__(self, row: dict):
        self.base, n = row["base"], row["n_rules"]
        self.rule_sizes = unpack_bits(row["rule_sizes"], row["size_width"], n).astype(np.int64)
        self.rules = unpack_bits(row["rules"], row["width"], int(self.rule_sizes.sum()))
        self.lengths = unpack_bits(row["lengths"], row["length_width"], n).astype(np.int64)
        self.sequence = unpack_bits(row["sequence"], row["width"], row["n_symbols"])
        self.sizes = np.frombuffer(row["doc_sizes"], "<u4").astype(np.int64)
        self.ids = np.frombuffer(row["doc_ids"], "<i8")
        self.nulls = np.frombuffer(row["nulls"], np.uint8).astype(bool)
        self._ends: np.ndarray | None = None

    def all(self) -> np.ndarray:
        # Each rule is written out once, unless that takes far more than the shard itself.
        if int(self.lengths.sum()) <= 8 * int(self.sizes.sum()):
            written = expand(self.rules, self.rules, self.rule_sizes, self.base)
            first = np.cumsum(self.lengths) - self.lengths
            return unfold(self.sequence, self.sequence >= self.base, written, first, self.lengths, self.base)[0]
        return expand(self.sequence, self.rules, self.rule_sizes, self.base)

    def range(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end``: only the symbols that cover them are expanded."""
        if self._ends is None:
            size = np.ones(len(self.sequence), np.int64)
            nested = self.sequence >= self.base
            size[nested] = self.lengths[self.sequence[nested] - self.base]
            self._ends = np.cumsum(size)
        if end <= start:
            return np.empty(0, np.uint32)
        a = int(np.searchsorted(self._ends, start, side="right"))
        z = int(np.searchsorted(self._ends, end, side="left")) + 1
        before = int(self._ends[a - 1]) if a else 0
        return expand(self.sequence[a:z], self.rules, self.rule_sizes, self.base)[start - before:end - before]

    def document(self, n: int) -> np.ndarray:
        end = int(self.sizes[:n + 1].sum())
        return self.range(end - int(self.sizes[n]), end)


def shard_row(part: int, block: int, ids: list, docs: list[np.ndarray], vocab: int) -> pa.RecordBatch:
    stream = np.concatenate(docs)
    base = max(vocab, int(stream.max()) + 1)
    rules, sizes, lengths, seq = compress(stream, base)
    width = max(1, (base + len(sizes) - 1).bit_length())
    null = [i is None for i in ids]
    values = [part, block, len(docs), len(stream), np.array([0 if i is None else i for i in ids], "<i8").tobytes(),
              bytes(null), np.array([len(d) for d in docs], "<u4").tobytes(), base, len(sizes), len(seq), width,
              pack_bits(rules, width), bits_of(sizes), pack_bits(sizes, bits_of(sizes)), bits_of(lengths),
              pack_bits(lengths, bits_of(lengths)), pack_bits(seq, width)]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in SHARD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], kinds[t]) for v, (_, t) in zip(values, fields)],
                                      [n for n, _ in fields])


# ---- tokens --------------------------------------------------------------

def char_kinds() -> np.ndarray:
    """Kind of every code point to the tokenizers library: 1 letter, 2 number, 3 white space, 0 any other."""
    from tokenizers.pre_tokenizers import ByteLevel

    chars = np.arange(0x110000, dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
    kinds = np.zeros(0x110000, np.uint8)
    for kind, name in enumerate((r"\p{L}+", r"\p{N}+", r"\s+"), 1):
        for m in regex.finditer(name, chars):
            kinds[m.start():m.end()] = kind
    # Versions of Unicode differ in which characters they know: where two do, the library is asked.
    first = np.frombuffer("".join(map(unicodedata.category, chars)).encode(), np.uint8)[::2]
    other = (first == ord("L")) + 2 * (first == ord("N"))
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    for c in np.flatnonzero((kinds != other) & (kinds != 3)).tolist():
        kinds[c] = 0 if len(split("!" + chr(c))) == 1 else 1 if len(split("a" + chr(c))) == 1 else 2
    return kinds


class ColumnSplitter:
    """Where the pieces of ``SPLIT`` start in the UTF-8 bytes of many texts, found
    for all of them at once. Letters and numbers are those of the library."""

    SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self):
        self.kinds = char_kinds()

    def byte_kinds(self, data: np.ndarray) -> np.ndarray:
        """Kind of the character that each byte belongs to."""
        kind = self.kinds[:256][data]
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            more = np.concatenate([data, np.zeros(3, np.uint8)])
            b0, b1, b2, b3 = (more[lead + k].astype(np.int32) & 0x3F for k in range(4))
            two, four = data[lead] < 0xE0, data[lead] >= 0xF0
            code = np.where(two, (b0 & 0x1F) << 6 | b1, (b0 & 0x0F) << 12 | b1 << 6 | b2)
            code[four] = ((b0 & 0x07) << 18 | b1 << 12 | b2 << 6 | b3)[four]
            own = self.kinds[code]
            for k, part in enumerate((slice(None), slice(None), ~two, four)):
                kind[lead[part] + k] = own[part]
        return kind

    def starts(self, data: np.ndarray, texts: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Start of every piece, and the end of the bytes. ``texts``: where texts start, and
        the end; those that are ``whole`` are one piece."""
        n = len(data)
        kind = self.byte_kinds(data)
        new, first = np.zeros(n + 4, bool), np.zeros(n + 4, bool)
        first[texts] = True
        first[n:] = True
        np.not_equal(kind[1:], kind[:-1], out=new[1:max(n, 1)])
        new |= first
        # The last white space before a word is apart from the ones before; a blank goes with the word.
        word = np.flatnonzero(new[1:n] & ~first[1:n] & (kind[:-1] == 3)) + 1
        last = word - 1
        for _ in range(3):
            last -= (data[last] & 0xC0) == 0x80
        new[last] = True
        new[word[data[word - 1] == 0x20]] = False
        # 's and the like, where the apostrophe starts a piece.
        quote = np.flatnonzero((data == 0x27) & new[:n])
        quote = quote[new[quote + 1] & ~first[quote + 1]]
        after = data[quote + 1]
        short = quote[(after == 0x73) | (after == 0x74) | (after == 0x6D) | (after == 0x64)]
        quote, after = quote[~first[quote + 2]], after[~first[quote + 2]]
        second = data[quote + 2]
        long = quote[((after == 0x6C) & (second == 0x6C)) | (((after == 0x72) | (after == 0x76)) & (second == 0x65))]
        new[short + 1] = new[long + 1] = False
        new[short + 2] = new[long + 3] = True
        if whole.any():
            new[:n] &= ~np.repeat(whole, np.diff(texts))
            new |= first
        return np.flatnonzero(new[:n + 1])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts without nulls, and where each text starts, with the end."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def byte_chars() -> np.ndarray:
    """Code point that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars = np.zeros(256, "<u4")
    chars[shown] = shown
    chars[np.setdiff1d(np.arange(256), shown)] = 256 + np.arange(256 - len(shown))
    return chars


def plain_byte_level(tokenizer) -> bool:
    """Does the tokenizer split by ``ColumnSplitter.SPLIT`` and nothing else?"""
    split = json.loads(tokenizer.to_str())["pre_tokenizer"] or {}
    return split.get("type") == "ByteLevel" and split.get("use_regex") is True and split.get("add_prefix_space") is False


class PieceTokens(dict):
    """Ids of text pieces by the tokenizers library; new pieces of a batch are
    encoded together and remembered, each different one looked up once a batch. Pieces that begin with one space split the
    same way when they stand in a row, so many are encoded as one text and told
    apart by the bytes their ids stand for."""

    def __init__(self, raw: bytes, pattern: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(raw.decode("utf-8"))
        # Texts are cut at added tokens before; what is between is plain text.
        self.tokenizer.encode_special_tokens = True
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: np.array([i], "<u4").tobytes() for i, t in added.items()}
        self.cut = None
        if all(t.special and not (t.single_word or t.lstrip or t.rstrip or t.normalized) for t in added.values()):
            self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.splitter = Splitter(pattern)
        self.columns = ColumnSplitter() if pattern == ColumnSplitter.SPLIT else None
        # Pieces that are the library's own splits go to its model at once, each byte as its character.
        t, self.model = self.tokenizer, None
        if self.columns and t.normalizer is None and t.truncation is None and t.padding is None and plain_byte_level(t):
            self.model, self.byte_chars = t.model, byte_chars()
        self.vocab = self.tokenizer.get_vocab_size()
        # A byte-level token has one character per byte.
        self.length = np.zeros(self.vocab, np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.length[i] = len(token)

    def _batch(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, pieces) -> None:
        """Encode new pieces and remember them."""
        rows, rest = [], []
        if self.cut is None:
            # Whole texts with added tokens that take in what is around them.
            whole = [p for p in pieces if any(t in p for t in self.added)]
            self.tokenizer.encode_special_tokens = False
            self.update((p, ids.tobytes()) for p, ids in zip(whole, self._batch(whole)))
            self.tokenizer.encode_special_tokens = True
            pieces = set(pieces).difference(whole)
        if self.model is not None:
            return self._learn_by_model(list(pieces))
        for p in pieces:
            (rows if p[0] == " " and p[1:2].strip() else rest).append(p)
        groups = [rows[k:k + ROW_PIECES] for k in range(0, len(rows), ROW_PIECES)]
        for group, ids in zip(groups, self._batch(["".join(g) for g in groups])):
            want = np.cumsum([len(p.encode("utf-8")) for p in group])
            ends = np.cumsum(self.length[ids])
            cut = np.searchsorted(ends, want) + 1
            if cut[-1] != len(ids) or (ends[cut - 1] != want).any():
                rest += group
                continue
            data, ends = ids.tobytes(), (4 * cut).tolist()
            self.update(zip(group, [data[a:z] for a, z in zip([0, *ends], ends)]))
        self.update((p, ids.tobytes()) for p, ids in zip(rest, self._batch(rest)))

    def _learn_by_model(self, pieces: list[str]) -> None:
        data, at = text_bytes(pa.array(pieces, pa.large_string()))
        chars, at = self.byte_chars[data].tobytes().decode("utf-32-le"), at.tolist()
        tokenize, ids, ends = self.model.tokenize, [], [0]
        for a, z in zip(at, at[1:]):
            ids += [t.id for t in tokenize(chars[a:z])]
            ends.append(4 * len(ids))
        out = np.array(ids, "<u4").tobytes()
        self.update(zip(pieces, [out[a:z] for a, z in zip(ends, ends[1:])]))

    def parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Texts cut at added tokens, which parts are one piece, and where each text's parts start, with the end."""
        held = np.zeros(len(texts), bool)
        for t in self.added:
            held |= pc.match_substring(texts, t).to_numpy(zero_copy_only=False)
        if not held.any():
            return texts, held, np.arange(len(texts) + 1)
        cut = [[t] if not h or self.cut is None else self.cut.split(t) for h, t in zip(held.tolist(), texts.to_pylist())]
        ends = np.cumsum([0, *map(len, cut)])
        whole = np.repeat(held, np.diff(ends))
        if self.cut is not None:
            whole &= (np.arange(ends[-1]) - np.repeat(ends[:-1], np.diff(ends))) % 2 == 1
        return pa.array([p for part in cut for p in part], pa.large_string()), whole, ends

    def pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Pieces of all texts in a row, and where those of each text start, with the end; an added token is one."""
        parts, whole, ends = self.parts(texts)
        if self.columns is None:
            split = [[t] if w else self.splitter.split(t) for w, t in zip(whole.tolist(), parts.to_pylist())]
            at = np.cumsum([0, *map(len, split)])
            return pa.array([p for part in split for p in part], pa.large_string()), at[ends]
        data, at = text_bytes(parts)
        starts = self.columns.starts(data, at, whole)
        found = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(data))
        return found, np.searchsorted(starts, at)[ends]

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        self.update(self.added)
        pieces, texts_at = self.pieces(texts)
        pieces = pieces.dictionary_encode()
        # Far cheaper than to_pylist, which makes a scalar of each.
        names, of = pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), pieces.indices.to_numpy()
        fresh = [p for p in names if p not in self]
        if len(self) + len(fresh) > TOKEN_CACHE:
            self.clear()
            self.update(self.added)
            fresh = [p for p in names if p not in self]
        self.learn(fresh)
        known = list(map(self.__getitem__, names))
        for p in fresh:
            if len(p) > CACHED_PIECE:
                del self[p]
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        # Ids of the pieces of all texts in a row, each taken from its place among the different ones.
        ends = np.concatenate([[0], np.cumsum(size[of])])
        source = np.repeat((np.cumsum(size) - size)[of] - ends[:-1], size[of]) + np.arange(ends[-1])
        ids = np.frombuffer(b"".join(known), "<u4")[source]
        cuts = ends[texts_at].tolist()
        return [ids[a:z] for a, z in zip(cuts, cuts[1:])]


_TOKENS: dict[str, PieceTokens] = {}


def _tokens(key: str, raw, pattern: str) -> PieceTokens:
    if key not in _TOKENS:
        _TOKENS.clear()
        _TOKENS[key] = PieceTokens(raw.value, pattern)
    return _TOKENS[key]


def write_shards(df: DataFrame, path: str, tokenizer_path: str, pattern: str, end_id: int, id_col: str = "doc_id",
                 text: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Write the shard table of all documents to ``path``. ``pattern``: the split
    of the tokenizer, so that pieces can be encoded once."""
    with open(tokenizer_path, "rb") as f:
        raw = f.read(MAX_VOCAB_BYTES + 1)
    if len(raw) > MAX_VOCAB_BYTES:
        raise ValueError(f"tokenizer file over {MAX_VOCAB_BYTES} bytes")
    key = hashlib.sha256(raw + pattern.encode()).hexdigest()
    sent = df.sparkSession.sparkContext.broadcast(raw)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("id").asc_nulls_first(), text_key(F.col("text"))]
    # Ranges of the whole order, so that equal ids need not meet in one task.
    rows = rows.repartitionByRange(shuffle_partitions(df.sparkSession), *order).sortWithinPartitions(*order)

    def run(batches):
        tokens, part, block = _tokens(key, sent, pattern), TaskContext.get().partitionId(), 0
        ids, docs, held = [], [], 0
        end = np.array([end_id], np.uint32)
        for b in batches:
            for i, d in zip(b.column(0).to_pylist(), tokens.encode(b.column(1))):
                ids.append(i)
                docs.append(np.concatenate([d, end]))
                held += len(docs[-1])
                if held >= shard_ids:
                    yield shard_row(part, block, ids, docs, tokens.vocab)
                    ids, docs, held, block = [], [], 0, block + 1
        if ids:
            yield shard_row(part, block, ids, docs, tokens.vocab)

    small_batches(df.sparkSession)
    rows.mapInArrow(run, SHARD).write.mode("overwrite").parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """``part``, ``block``, ``shard_start``: ids of all shards before, summed in
    each part and over the parts."""
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    rows_before = (Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*rows_before)), F.lit(0))
                         .alias("before"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(*rows_before)
    each = shards.select("part", "block", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("within"))
    return each.join(parts, "part").select("part", "block", (F.col("before") + F.col("within")).alias("shard_start"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``id``, ``start`` (ids of all documents before), ``ids`` (little-endian
    unsigned 32-bit) of every document, decoded from the shards."""
    shards = spark.read.parquet(path)

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                row = b.slice(k, 1).to_pylist()[0]
                s = Shard(row)
                stream = s.all().astype("<u4")
                ends = np.cumsum(s.sizes)
                begins = ends - s.sizes
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ends), row["part"]), pa.int32()), pa.array(np.full(len(ends), row["block"]), pa.int32()),
                     pa.array(s.ids, pa.int64(), mask=s.nulls), pa.array(begins, pa.int64()),
                     pa.array([stream[x:y].tobytes() for x, y in zip(begins, ends)], pa.binary())],
                    ["part", "block", "id", "offset", "ids"])

    small_batches(spark)
    docs = shards.mapInArrow(run, "part int, block int, id long, offset long, ids binary")
    starts = store(shard_starts(shards.select("part", "block", "n_ids")), "shard_starts")
    return (docs.join(starts, ["part", "block"])
            .select("id", (F.col("shard_start") + F.col("offset")).alias("start"), "ids"))

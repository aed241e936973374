"""SimHash near-duplicates with multi-index hashing.

Fingerprint: ASCII letters lower-cased, words are runs without the bytes
0x20 and 0x09-0x0D, shingles of ``width`` words (repeats counted; a shorter
document is one shingle). Every shingle votes with the bits of its XXH64; a
bit is set where over half of the shingles set it. No word: fingerprint 0.

Search: fingerprints are split into ``segments`` parts. By the pigeonhole
principle two fingerprints at most ``max_bits`` apart agree, in at least one
part, up to a small radius; each distinct fingerprint is tabled under its part
values, probes with the Hamming ball around its own, and the join's condition
verifies the complete distance. Copies are aggregated to one fingerprint
first, so a large group of copies is one table row. Both sides of the join are
shuffled, whatever size the planner takes them for.

Defined cases: null text counts as empty; rows with a null id get their
fingerprint and the component's smallest non-null id (null if there is none);
repeated rows stay repeated; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from recsmith.llm.common import small_batches, store, text_key
from recsmith.llm.components import connected_components

BITS = 64
# Shingles whose bits are counted at once.
CHUNK = 1 << 16


def fingerprint(text: str | None, width: int, seed: int) -> int:
    """The 64-bit fingerprint as a signed number."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    hash64 = xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = [hash64(b" ".join(words), seed)]
    else:
        hashes = [hash64(b" ".join(s), seed) for s in zip(*(words[i:] for i in range(width)))]
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = np.array(hashes[at:at + CHUNK], np.uint64).astype("<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprint(df: DataFrame, text: str, name: str = "fp", width: int = 3, seed: int = 42) -> DataFrame:
    """``df`` with the fingerprint of column ``text`` as long column ``name``."""
    small_batches(df.sparkSession)

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width, seed) for t in texts], dtype="int64")

    return df.withColumn(name, fp(F.coalesce(F.col(text), F.lit(""))))


def segment_plan(segments: int, max_bits: int) -> list[tuple[int, int, int]]:
    """(shift, bits, radius) of each part: with max_bits = s * segments + a, the
    first a + 1 parts need radius s and the others s - 1 (-1: not needed)."""
    s, a = divmod(max_bits, segments)
    edges = [round(i * BITS / segments) for i in range(segments + 1)]
    return [(lo, hi - lo, s if i <= a else s - 1) for i, (lo, hi) in enumerate(zip(edges, edges[1:]))]


def ball(bits: int, radius: int) -> list[int]:
    """XOR masks of all values within ``radius`` bits of a ``bits`` wide value."""
    return [sum(1 << i for i in on) for r in range(radius + 1) for on in combinations(range(bits), r)]


def close_pairs(prints: DataFrame, fp: str = "fp", max_bits: int = 2, segments: int = 2) -> DataFrame:
    """Pairs ``a`` < ``b`` of the distinct values of ``fp`` that differ in 1 to
    ``max_bits`` bits."""
    distinct = prints.select(F.col(fp).alias("fp")).where("fp is not null").distinct()
    tables, probes = [], []
    for i, (shift, bits, radius) in enumerate(segment_plan(segments, max_bits)):
        if radius < 0:
            continue
        key = F.shiftrightunsigned("fp", shift)
        if bits < BITS:
            key = key.bitwiseAND(F.lit((1 << bits) - 1))
        # As signed numbers: the top bit of a 64-bit part is negative.
        masks = F.array(*[F.lit(m - (1 << BITS) if m >> (BITS - 1) else m).cast("long") for m in ball(bits, radius)])
        tables.append(distinct.select(F.lit(i).alias("seg"), key.alias("key"), F.col("fp").alias("b")))
        probes.append(distinct.select(F.lit(i).alias("seg"), key.alias("own"), F.col("fp").alias("a"),
                                      F.explode(masks).alias("mask"))
                      .select("seg", F.col("own").bitwiseXOR(F.col("mask")).alias("key"), "a"))
    table, probe = tables[0], probes[0]
    for t, p in zip(tables[1:], probes[1:]):
        table, probe = table.union(t), probe.union(p)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    # Never broadcast: the planner sizes the probes as if they were not exploded (34 a fingerprint, for two
    # segments and two bits), and a side it takes for small would be gathered whole in the driver.
    return (probe.hint("merge").join(table, (probe.seg == table.seg) & (probe.key == table.key) & (F.col("a") < F.col("b")) & near)
            .select("a", "b"))


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3, seed: int = 42,
                   max_bits: int = 2, segments: int = 2) -> DataFrame:
    """One row per input row: ``id``, ``tkey`` (key of its text), ``fp``,
    ``component_id`` (smallest id reachable over links, itself included) and
    ``keeper`` (true for the rows holding the group's smallest (id, tkey))."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).withColumn("tkey", text_key(F.col("text")))
    rows = store(with_fingerprint(rows, "text", width=width, seed=seed).select("id", "tkey", "fp"), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "tkey")).alias("first")
    per_print = rows.groupBy("fp").agg(first)
    groups = connected_components(close_pairs(rows, "fp", max_bits, segments)).select(
        F.col("id").alias("fp"), "component")
    per_print = store(per_print.join(groups, "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")), "prints")
    best = per_print.groupBy("component").agg(F.min("first").alias("best"))
    named = per_print.join(best, "component").select("fp", "best")
    return (rows.join(named, "fp")
            .select("id", "tkey", "fp", F.col("best.id").alias("component_id"),
                    (F.col("id").eqNullSafe(F.col("best.id")) & (F.col("tkey") == F.col("best.tkey"))).alias("keeper")))


def simhash_dedup(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3, seed: int = 42,
                  max_bits: int = 2, segments: int = 2) -> DataFrame:
    """The rows of ``df`` that stay when one document of each group is kept: the
    one with the smallest id (null ids last), then the smallest text key; of
    repeated rows one stays. All columns of ``df`` are kept."""
    stay = (simhash_groups(df, id_col, text, width, seed, max_bits, segments).where("keeper")
            .select(F.col("id").alias("__id"), F.col("tkey").alias("__tkey")).distinct())
    keyed = df.withColumn("__key", text_key(F.col(text)))
    kept = keyed.join(stay, keyed[id_col].eqNullSafe(stay["__id"]) & (keyed["__key"] == stay["__tkey"]), "left_semi")
    return kept.dropDuplicates([id_col, "__key"]).drop("__key")

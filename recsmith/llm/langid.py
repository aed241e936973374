"""Language identification by nearest centroid.

A text's features are its character bigrams and trigrams (lower-cased, runs of
non-letters as one space) hashed into ``DIM`` buckets; its vector is
(1 + ln tf) * idf, of length 1. Document frequencies come from every learning
row, summed per task before the shuffle. For each language a bounded sample
(``per_lang`` rows by hash) is clustered by spherical k-means into ``clusters``
unit centroids. A text takes the language of the centroid of largest cosine.
It is rejected if that cosine is below the language's limit for texts with as
many different n-grams (powers of two): ``slack`` times the ``quantile`` of the
cosines of sample texts of that size and their excerpts. These are taken to
centroids learned from the other half of the sample, so no text is measured by
centroids it shaped; short texts have small cosines and so small limits.

What is sent to the tasks (idf, centroids, limits) grows with the number of
languages only, ``clusters * DIM`` floats each; at most ``max_langs`` languages are learned, the
most frequent ones.

Defined cases: null texts and texts without a letter get ``und``, score 0,
rejected; without any learning row every text does; equal cosines go to the
smaller language name; repeated rows and null ids are rows like others, but
count once for the limits; a size without a sample text has the limit of the
next smaller one; a language with too few different texts to measure has the
smallest limits of the others (0 without any); other columns are not read.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from recsmith.llm.common import map_batches, small_batches, store

DIM = 1 << 14
UNKNOWN = "und"
# Sizes of a text: powers of two of its different n-grams.
SIZES = DIM.bit_length()
# Letters of the shortest excerpt; each further one is twice as long.
EXCERPT = 4


@lru_cache(1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and counts of a text's n-grams; none without a letter."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = letters()[code]
    none = np.empty(0, np.int64)
    if not is_letter.any():
        return none, none
    kept = is_letter.copy()
    kept[1:] |= is_letter[:-1]
    c = np.where(is_letter, code, 32)[kept].astype(np.uint64)
    if is_letter[0]:
        c = np.concatenate([np.array([32], np.uint64), c])
    if c[-1] != 32:
        c = np.concatenate([c, np.array([32], np.uint64)])
    # Fixed odd multipliers mix the code points; the top bits are the bucket.
    two = c[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    three = two[:-1] * np.uint64(0x165667B19E3779F9) + c[2:] * np.uint64(0xD6E8FEB86659FD93)
    every = np.concatenate([two, three])
    every ^= every >> np.uint64(29)
    every *= np.uint64(0xBF58476D1CE4E5B9)
    count = np.bincount((every >> np.uint64(64 - 14)).astype(np.int64), minlength=DIM)
    at = np.flatnonzero(count)
    return at, count[at]


def vector(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights of the unit TF-IDF vector."""
    at, count = grams(text)
    if not len(at):
        return at, np.empty(0)
    w = (1 + np.log(count)) * idf[at]
    return at, w / np.sqrt((w * w).sum())


def cluster(x: np.ndarray, k: int, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means of unit rows, started farthest-first: unit centroids and
    the rows' cluster numbers."""
    start = [int(np.argmax(x @ x.mean(axis=0)))]
    near = x @ x[start[0]]
    while len(start) < min(k, len(x)):
        start.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[start[-1]])
    centre = x[start]
    for _ in range(rounds):
        own = np.argmax(x @ centre.T, axis=1)
        centre = np.stack([x[own == c].mean(axis=0) if (own == c).any() else centre[c] for c in range(len(centre))])
        centre /= np.maximum(np.sqrt((centre * centre).sum(axis=1, keepdims=True)), 1e-12)
    return centre, np.argmax(x @ centre.T, axis=1)


def excerpts(text: str) -> list[str]:
    """The text and its beginnings of 4, 8, 16, ... characters after the first letter."""
    start = next((i for i, c in enumerate(text) if c.isalpha()), 0)
    out, n = [text], EXCERPT
    while n < len(text) - start:
        out.append(text[start:start + n])
        n *= 2
    return out


def held_cosines(texts: dict[bytes, list], clusters: int) -> tuple[list[int], list[float]]:
    """Sizes and cosines of sample texts and their excerpts (whole text first; by a
    key of the text) to the nearest centroid of the other half of the sample."""
    halves = [[], []]
    for key in sorted(texts):
        halves[zlib.crc32(key) & 1].append(texts[key])
    sizes, cos = [], []
    for learn, check in (halves, halves[::-1]):
        if not learn:
            continue
        x = np.zeros((len(learn), DIM), np.float32)
        for row, parts in zip(x, learn):
            row[parts[0][0]] = parts[0][1]
        centre, _ = cluster(x, clusters)
        for at, w in (p for parts in check for p in parts):
            sizes.append(len(at).bit_length() - 1)
            cos.append(float((centre[:, at] @ w).max()))
    return sizes, cos


class Model:
    """``limits``: of each centroid, by size of the text or one for all sizes."""

    def __init__(self, idf: np.ndarray, langs: list[str], centres: np.ndarray, limits: np.ndarray):
        self.idf, self.langs, self.centres = idf, langs, centres
        self.limits = np.broadcast_to(limits if limits.ndim == 2 else limits[:, None], (len(langs), SIZES))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine, rejected."""
        at, w = vector(text, self.idf)
        if not len(at) or not self.langs:
            return UNKNOWN, 0.0, True
        cos = self.centres[:, at] @ w
        best = int(np.argmax(cos))
        return self.langs[best], float(min(max(cos[best], 0.0), 1.0)), bool(
            cos[best] < self.limits[best, len(at).bit_length() - 1])


def document_frequencies(rows: DataFrame) -> DataFrame:
    """``bucket``, ``df`` over the texts; bucket -1 counts them."""
    def run(batches):
        seen = np.zeros(DIM + 1, np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                seen[grams(t)[0]] += 1
                seen[DIM] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.where(at == DIM, -1, at)), pa.array(seen[at])], ["bucket", "df"])

    small_batches(rows.sparkSession)
    part = rows.select("text").mapInArrow(run, "bucket long, df long")
    return part.groupBy("bucket").agg(F.sum("df").alias("df"))


def learning_sample(rows: DataFrame, per_lang: int, max_langs: int, seed: int) -> DataFrame:
    """``lang``, ``text`` of about ``per_lang`` rows a language, of the ``max_langs`` most frequent ones: those
    whose key hashes low (rows without a key go by their text). Repeated keys and texts hash alike, so
    twice ``per_lang`` rows are the most that a language gives."""
    counts = store(rows.groupBy("lang").count(), "lang_counts").orderBy(F.desc("count"), "lang").limit(max_langs)
    share = counts.select("lang", (F.lit(float(per_lang)) / F.col("count")).alias("share"))
    hashed = F.when(F.col("key").isNull(), F.xxhash64("text", F.lit(seed))).otherwise(F.xxhash64("key", F.lit(seed)))
    u = F.pmod(hashed, F.lit(1 << 31)) / float(1 << 31)
    low = rows.join(F.broadcast(share), "lang").withColumn("u", u).where(F.col("u") < F.col("share"))
    order = Window.partitionBy("lang").orderBy("u", F.xxhash64("text"), "text")
    return low.withColumn("n", F.row_number().over(order)).where(F.col("n") <= 2 * per_lang).select("lang", "text")


def fit(rows: DataFrame, per_lang: int = 1000, clusters: int = 4, quantile: float = 0.01, slack: float = 0.4,
        seed: int = 11, max_langs: int = 256) -> Model:
    """Learn from rows (``key``, ``text``, ``lang`` not null) of at most ``max_langs`` languages."""
    seen = {r.bucket: r.df for r in store(document_frequencies(rows), "df").collect()}
    n = seen.pop(-1, 0)
    df = np.zeros(DIM)
    df[list(seen)] = list(seen.values())
    idf = np.log((1 + n) / (1 + df)) + 1
    sample = learning_sample(rows, per_lang, max_langs, seed)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        made = [(lang, [p for p in (vector(e, idf) for e in excerpts(t or "")) if len(p[0])])
                for lang, t in zip(*(c.to_pylist() for c in b.columns))]
        made = [m for m in made if m[1]]
        return pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()),
                                           pa.array([[at.astype("<i4").tobytes() for at, _ in m[1]] for m in made],
                                                    pa.list_(pa.binary())),
                                           pa.array([[w.astype("<f4").tobytes() for _, w in m[1]] for m in made],
                                                    pa.list_(pa.binary()))],
                                          ["lang", "at", "w"])

    def centroids(part: pd.DataFrame) -> pd.DataFrame:
        part = part.assign(key=[a[0] + w[0] for a, w in zip(part["at"], part["w"])]).sort_values("key")
        parts = [[(np.frombuffer(a, "<i4"), np.frombuffer(w, "<f4")) for a, w in zip(*r)]
                 for r in zip(part["at"], part["w"])]
        x = np.zeros((len(part), DIM), np.float32)
        for row, p in zip(x, parts):
            row[p[0][0]] = p[0][1]
        centre, _ = cluster(x, clusters)
        size, cos = map(np.array, held_cosines(dict(zip(part["key"], parts)), clusters))
        limit = np.full(SIZES, np.nan)
        for n in range(SIZES):
            if (size == n).any():
                limit[n] = slack * np.quantile(cos[size == n], quantile, method="lower")
            elif n:
                limit[n] = limit[n - 1]
        return pd.DataFrame({"lang": part["lang"].iloc[0], "cluster": range(len(centre)),
                             "limits": [limit.tolist()] * len(centre),
                             "centre": [c.astype("<f4").tobytes() for c in centre]})

    learned = map_batches(sample, run, "lang string, at array<binary>, w array<binary>").groupBy("lang").applyInPandas(
        centroids, "lang string, cluster int, limits array<double>, centre binary")
    found = sorted(store(learned, "centroids").collect(), key=lambda r: (r.lang, r.cluster))
    centres = np.array([np.frombuffer(r.centre, "<f4") for r in found], np.float64).reshape(-1, DIM)
    limits = np.array([r.limits for r in found], np.float64).reshape(-1, SIZES)
    least = np.where(np.isnan(limits), np.inf, limits).min(axis=0, initial=np.inf)
    limits = np.where(np.isnan(limits), np.where(np.isinf(least), 0.0, least), limits)
    return Model(idf, [r.lang for r in found], centres, limits)


def predict(df: DataFrame, model: Model, text: str = "text", name: str = "language") -> DataFrame:
    """``df`` with the struct ``name``: ``lang_pred``, ``score``, ``rejected``."""
    small_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def language(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([sent.value.predict(t) for t in texts], columns=["lang_pred", "score", "rejected"])

    # Not to be evaluated again where a later filter or column uses the result.
    return df.withColumn(name, language.asNondeterministic()(F.coalesce(F.col(text), F.lit(""))))


def held_out(id_col) -> F.Column:
    """Rows kept out of learning: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learning_rows(df: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    return df.where(~held_out(F.col(id_col)) & F.col(lang).isNotNull()).select(
        F.col(id_col).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))

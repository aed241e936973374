"""The corpus pipeline: stages applied to ``documents`` one after the other,
each written as Parquet and read again as the next one's input. All stages but
the last return the columns of ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from recsmith.llm import bpe_prefix, langid, mixing, pii_crf, simhash
from recsmith.llm.common import store


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language go; a missing language is filled in."""
    model = langid.fit(langid.learning_rows(docs))
    named = langid.predict(docs, model, name="__language").where("not __language.rejected")
    return named.withColumn("lang", F.coalesce("lang", "__language.lang_pred")).drop("__language")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (3-word shingles, 2 bits)."""
    return simhash.simhash_dedup(docs, width=3, seed=42, max_bits=2)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the texts; n_chars follows."""
    return pii_crf.mask_pii(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat or go as the target weights of their sources ask."""
    names = ("__n_copies", "__copy", "__order_key")
    return mixing.mix(docs, epochs=1.0, seed=5, names=names).drop(*names)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row (little-endian unsigned 32-bit) and their digests."""
    vocab = bpe_prefix.Vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    done = bpe_prefix.encode_documents(docs, vocab, decoded=True)
    return done.select(F.col("id").alias("doc_id"), (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("tokens", tokens),
]

# The stages learn from, hash and encode texts in ways SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

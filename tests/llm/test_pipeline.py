"""The pipeline's stages against plain readings of their contracts."""

import hashlib

import numpy as np
import pytest
import public_tokenizers
import tiktoken

import corpus_pipeline
from recsmith.llm import components as components_module, simhash as simhash_module
from recsmith.llm.bpe_prefix import load_ranks
from recsmith.llm.common import store
from llm.test_queries import brute_spans, components, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(store(stage(spark, out[-1], odd_dir), name))
    return out


def dicts(df):
    return [r.asDict() for r in df.collect()]


def test_columns_stay(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_language_keeps_what_has_letters(stages):
    before, after = dicts(stages[0]), dicts(stages[1])
    plain = lambda t: any(c.isalpha() for c in t or "")
    foreign = "漢字"
    kept = sorted((r["doc_id"] or -1, r["text"]) for r in after)
    assert kept == sorted((r["doc_id"] or -1, r["text"]) for r in before if plain(r["text"]) and (
        foreign not in r["text"] or (r["doc_id"] or -1, r["text"]) in kept))
    assert all(r["lang"] for r in after)


def test_one_document_of_each_group(stages):
    rows = dicts(stages[1])
    prints = [simhash(r["text"]) for r in rows]
    values = set(prints)
    comp = components(values, [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2])
    kept = dicts(stages[2])
    assert sorted(comp[simhash(r["text"])] for r in kept) == sorted(set(comp.values()))
    least = {}
    for r, f in zip(rows, prints):
        if r["doc_id"] is not None:
            least[comp[f]] = min(least.get(comp[f], r["doc_id"]), r["doc_id"])
    assert all(r["doc_id"] == least.get(comp[simhash(r["text"])]) for r in kept)


def test_no_exploded_table_is_broadcast(spark, stages, monkeypatch):
    """What near_dedup stores and returns, in the plans as first made."""
    plans = []

    def kept(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, name)
    for module in (components_module, simhash_module):
        monkeypatch.setattr(module, "store", kept)
    out = corpus_pipeline.near_dedup(spark, stages[1], "")
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    exploded = [p for p in plans if "Generate explode" in p]
    assert exploded and not any("Broadcast" in p for p in exploded)


def test_no_base_span_is_left(stages):
    before = {(r["doc_id"], hashlib.md5((r["text"] or "")[:20].encode()).digest()): r for r in dicts(stages[2])}
    after = dicts(stages[3])
    assert len(after) == len(before)
    for r in after:
        assert r["n_chars"] == len(r["text"])
        assert not [s for s in brute_spans(r["text"]) if r["text"][s[1]:s[2]] in (before.get((r["doc_id"], hashlib.md5(
            r["text"][:20].encode()).digest())) or {"text": ""})["text"] and s[0] == "email"]
    clean = {r["text"] for r in before.values() if not any(c in r["text"] for c in "0123456789@")}
    assert clean <= {r["text"] for r in after}


def test_copies_come_from_the_input(stages):
    before = {repr(r) for r in dicts(stages[3])}
    assert {repr(r) for r in dicts(stages[4])} <= before


def test_tokens_decode_to_the_texts(stages):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(f.read()), special_tokens={})
    want = []
    for r in dicts(stages[4]):
        ids = np.array(enc.encode_ordinary(r["text"]), "<u4").tobytes()
        want.append((r["doc_id"], len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest()))
    got = [(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in dicts(stages[5])]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_run_is_the_stages(spark, odd_dir, stages):
    key = lambda df: sorted((r["doc_id"] or -1, r["ids_sha256"]) for r in dicts(df))
    assert key(corpus_pipeline.run(spark, odd_dir)) == key(stages[5])


def test_empty_table(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).collect() == []

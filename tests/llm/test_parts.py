"""The operators' parts: encoders, families, grammars, span models, components."""

import base64
import json
import random

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import regex
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recsmith.llm import ann_bits, bpe_prefix, cotrain, int8_dedup, langid, pii_crf, repair_tokens, simhash, suffix_dedup
from recsmith.llm.common import store
from recsmith.llm.components import connected_components, star_forest


@pytest.fixture(scope="module")
def encoder():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return bpe_prefix.TextEncoder(f.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.bpe.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdeé \n\t's'll12ñ½\x1c\x85\xa0世😀_!AB", max_size=80))
def test_bpe_as_library(encoder, library, text):
    ids = encoder.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
    assert encoder.decode(ids) == text.encode()
    assert encoder.splitter.split(text) == regex.findall(public_tokenizers.PATTERN, text)


def test_bpe_documents_decode_later(spark, encoder):
    texts = ["the nation", "", None, "Füße 漢字 " * 50]
    vocab = bpe_prefix.Vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    enc = bpe_prefix.encode_documents(df, vocab, decoded=True).withColumnRenamed("decoded", "now")
    for r in bpe_prefix.decode_documents(enc, vocab, name="later").collect():
        assert bytes(r.now) == bytes(r.later) == (texts[r.id] or "").encode()
        assert bytes(r.ids) == encoder.encode(texts[r.id] or "")


@pytest.mark.parametrize("text", ["a" * 20_000, " " * 9_999, "ab" * 9_000, "\n" * 500 + "x", "=" * 7_000])
def test_bpe_long_pieces(encoder, library, text):
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_bpe_appends_and_edits(encoder):
    rng = random.Random(2)
    for _ in range(60):
        data = "".join(rng.choice("the of ingtion") for _ in range(rng.randint(0, 400))).encode()
        p = bpe_prefix.PieceEncoding(encoder.bpe)
        for k in range(0, len(data), 9):
            p.append(data[k:k + 9])
        assert p.ids == encoder.bpe.encode(data)
        a = rng.randint(0, len(data))
        z = rng.randint(a, len(data))
        p.edit(a, z, b"ionthe")
        assert p.data == data[:a] + b"ionthe" + data[z:] and p.ids == encoder.bpe.encode(p.data)


def test_bpe_edit_is_local(encoder):
    text = " ".join(f"{'thing' if i % 3 else 'nation'}{i}" for i in range(3000)).encode()
    p = bpe_prefix.PieceEncoding(encoder.bpe, text)
    assert p.edit(10, 12, b"xy") < len(text) / 10
    assert p.ids == encoder.bpe.encode(p.data)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=400))
def test_grammar_round_trip(ids):
    ids = np.array(ids, np.uint32)
    rules, sizes, lengths, seq = repair_tokens.compress(ids, 10, least=2)
    assert (repair_tokens.expand(seq, rules, sizes, 10) == ids).all()
    assert not len(sizes) or np.bincount(np.concatenate([rules, seq]), minlength=10 + len(sizes))[10:].min() >= 2
    for k, n in enumerate(lengths):
        assert len(repair_tokens.expand(np.array([10 + k]), rules, sizes, 10)) == n


def test_grammar_shrinks_and_reads_ranges():
    rng = np.random.default_rng(1)
    docs = [np.concatenate([rng.integers(3, 300, 50), np.arange(3, 200)]).astype(np.uint32) for _ in range(30)]
    row = repair_tokens.shard_row(0, 0, [None, *range(29)], docs, 400).to_pylist()[0]
    shard = repair_tokens.Shard(row)
    assert len(shard.sequence) < 0.5 * row["n_ids"]
    assert (shard.all() == np.concatenate(docs)).all()
    assert all((shard.document(n) == d).all() for n, d in enumerate(docs))
    assert (shard.range(70, 75) == shard.all()[70:75]).all() and not len(shard.range(9, 9))


def test_families_against_sets():
    rng = np.random.default_rng(3)
    batches = [np.unique(rng.integers(0, 500, 60)).astype(np.uint64) for _ in range(40)]
    seen = set()
    for b, answer in zip(batches, suffix_dedup.scan_windows(batches)):
        assert answer.tolist() == [int(x in seen) for x in b.tolist()]
        seen |= set(b.tolist())
    family = suffix_dedup.Family()
    for b in np.array_split(np.arange(4096, dtype=np.uint64), 256):
        family.add(b)
    assert len(family.levels) <= 3


def test_family_keys_with_two_contents():
    one = lambda k, c: (np.array([k], np.uint64), np.array([c], np.uint64))
    answers = suffix_dedup.scan_keys([one(5, 1), one(5, 1), one(5, 2), one(5, 1), one(6, suffix_dedup.MULTI), one(6, 9)])
    assert [a.tolist()[0] for a in answers] == [2, 1, 2, 2, 2, 2]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=300), min_size=1, max_size=6))
def test_runs_cover_every_window(texts):
    chunk = suffix_dedup.Chunk(b"".join(texts), np.array([len(t) for t in texts]))
    start, doc = chunk.windows(np.arange(len(chunk.key)))
    want = [(int(a) + s, d) for d, (t, a) in enumerate(zip(texts, chunk.starts)) for s in range(len(t) - 49)]
    assert sorted(zip(start.tolist(), doc.tolist())) == want
    data = b"".join(texts)
    where = {}
    for s in start.tolist():
        assert where.setdefault(data[s:s + 50], chunk.window[s]) == chunk.window[s]
    assert len(set(where.values())) == len(where)


def test_sign_code_bounds():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 48))
    codes, c = ann_bits.sign_codes(x, 7)
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    out = 0
    for v in rng.standard_normal((20, 48)):
        made = ann_bits.quantise_queries(v[None], 7, 6)
        query = ann_bits.Query(np.frombuffer(made["planes"], "<u8").reshape(6, -1), np.frombuffer(made["q_scalars"], "<f8"), 48)
        est = query.estimate(codes, ones) / c
        true = ann_bits.exact(v, x)
        bound = 2.5 * np.sqrt(1 - c * c) / c / np.sqrt(47) + query.lost / c
        out += int((np.abs(est - true) > bound).sum())
        assert abs((est - true).mean()) < 0.02
    assert out < 0.02 * 60_000


def nearest_rows(spark, df):
    return sorted(tuple(r) for r in ann_bits.nearest(df, F.col("id") % 7 == 0, k=3).collect())


def test_queries_are_sent_in_bounded_batches(spark, monkeypatch):
    """However many queries there are, no table of them is broadcast by a join; a batch
    holds some bytes at most, and batches give the same rows."""
    rng = np.random.default_rng(8)
    rows = [(k % 900, [float(x) for x in rng.standard_normal(8 if k % 9 else 5).astype(np.float32)]) for k in range(1000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    plans, sent = [], []
    monkeypatch.setattr(ann_bits, "store", lambda df, name: plans.append(df._jdf.queryExecution().toString()) or store(df, name))
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda sc, value, put=type(spark.sparkContext).broadcast: (
        sent.append(sum(len(x) for row in value for x in row[1:])) or put(sc, value)))
    whole = nearest_rows(spark, df)
    assert len({r[0] for r in whole}) == 129 and len(whole) == 3 * 129
    assert len(sent) == 1 and not any("Broadcast" in p or "Generate" in p for p in plans)
    monkeypatch.setattr(ann_bits, "BATCH_BYTES", 6000)
    assert nearest_rows(spark, df) == whole
    assert len(sent) > 3 and max(sent[1:]) <= 6000 and sum(sent[1:]) == sent[0]


def test_best_of_several_blocks():
    rng = np.random.default_rng(9)
    q, i, s = rng.integers(-1, 4, 400), rng.integers(0, 30, 400) - (1 << 62), rng.integers(0, 9, 400) / 8
    want = {}
    for a, b, c in zip(q.tolist(), i.tolist(), s.tolist()):
        want.setdefault(a, {})[b] = max(c, want.get(a, {}).get(b, c))
    got = {}
    for a, b, c in zip(*(x.tolist() for x in ann_bits.keep_best(q, i, s, 4))):
        got.setdefault(a, []).append((b, c))
    assert got == {a: sorted(x.items(), key=lambda y: (-y[1], y[0]))[:4] for a, x in want.items()}
    assert [len(x) for x in ann_bits.keep_best(q[:0], i[:0], s[:0], 4)] == [0, 0, 0]


@pytest.mark.parametrize("d", [3, 64, 1200])
def test_int8_bounds_lose_no_pair(d):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((120, d)).astype(np.float32)
    x[60:] = x[:60] + rng.standard_normal((60, d)).astype(np.float32) * 0.33
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    q = int8_dedup.quantise(x)
    i, j = int8_dedup.possible(*q, *q, 0.95)
    found = set(zip(i.tolist(), j.tolist()))
    assert {(a, b) for a, b in zip(*np.nonzero(u @ u.T >= 0.95))} <= found
    assert len(found) < 120 * 120 / 2 or d == 3


def test_segment_plan_finds_every_near_pair():
    rng = random.Random(9)
    for segments, bits in ((2, 2), (3, 2), (4, 3), (1, 1), (3, 5)):
        plan = simhash.segment_plan(segments, bits)
        for _ in range(300):
            diff = sum(1 << b for b in rng.sample(range(64), rng.randint(0, bits)))
            assert any(r >= 0 and (diff >> s & (1 << n) - 1).bit_count() <= r for s, n, r in plan)
    assert len(simhash.ball(32, 1)) == 33 and len(set(simhash.ball(8, 2))) == 1 + 8 + 28


@pytest.mark.parametrize("segments, bits", [(1, 1), (2, 2), (3, 3)])
def test_close_pairs_are_all_found(spark, segments, bits):
    rng = random.Random(13)
    values = {rng.getrandbits(64) for _ in range(40)}
    for v in sorted(values)[:25]:
        for b in rng.sample(range(64), 4):
            v ^= 1 << b
            values.add(v)
    values |= {0, 1 << 63, (1 << 64) - 1}
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    df = spark.createDataFrame([(v,) for v in signed] * 2 + [(None,)], "fp long")
    got = {(r.a, r.b) for r in simhash.close_pairs(df, "fp", bits, segments).collect()}
    assert got == {(a, b) for a in signed for b in signed
                   if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= bits}


def test_probes_are_not_broadcast(spark):
    """Their number is a multiple of the fingerprints' that the planner does not know."""
    df = store(spark.createDataFrame([(k,) for k in range(20)], "fp long"), "prints")
    plan = simhash.close_pairs(df)._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_of_random_graphs(spark):
    rng = random.Random(11)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)]
    edges += [(i, i + 1) for i in range(1000, 1300)] + [(2000, i) for i in range(2001, 2200)] + [(7, 7)]
    got = {r.id: r.component for r in connected_components(
        spark.createDataFrame([*edges, (None, 3), (5, None)], "a long, b long")).collect()}
    root = {}

    def find(n):
        while root.setdefault(n, n) != n:
            n = root[n]
        return n
    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    assert got == {n: find(n) for n in root}
    v, m = star_forest(np.array([1, 2, 5]), np.array([2, 3, 9]))
    assert dict(zip(v.tolist(), m.tolist())) == {2: 1, 3: 1, 9: 5}


SAMPLE = [(f"aa {w} +1 ({100 + i}) 555-{1000 + 7 * i} bb mail u{i}@m{i % 9}.example.com cc 10.{i}.3.4 dd "
           f"{4 * 10 ** 15 + 97 * i} ee") for i, w in enumerate("call the tel on and by at of in it".split() * 12)]


@pytest.fixture(scope="module")
def span_model():
    return pii_crf.train([(s, pii_crf.base_spans(s)) for s in SAMPLE])


def test_span_model_finds_masked_forms(span_model):
    found = lambda s: {(pii_crf.KINDS[k], s[a:z]) for k, a, z in span_model.find(s, 0.5)}
    assert ("email", "bob.smith(at)example.com") in found("write bob.smith(at)example.com please")
    assert ("phone", "+1 (555) 555-7777") in found("or +1 (555) 555-7777 then")
    for clean in ("in 2020 and 2021", "version 3.2", "chapter 12, pages 100-200", "a @ b", ""):
        assert found(clean) == set()


def test_span_model_scores_are_probabilities(span_model):
    """Forward and backward sums over a region agree with listing all segmentations."""
    region = "x u@m.co y"
    cut, out, ends = span_model.scores(region)
    n, step = len(out), span_model.step

    def every(at, before):
        if at == n:
            return [0.0]
        sums = [step[before, 0] + out[at] + s for s in every(at + 1, 0)]
        for j in range(at + 1, n + 1):
            for i, score in ends[j]:
                if i == at:
                    for y in range(1, len(pii_crf.KINDS) + 1):
                        sums += [step[before, y] + score[y - 1] + s for s in every(j, y)]
        return sums
    whole = np.logaddexp.reduce(every(0, 0))
    assert np.isclose(span_model.backward(out, ends)[0, 0], whole)


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 200_000, "+1" + " " * 200_000, "@" * 30_000, "a@" * 30_000])
def test_base_spans_are_linear(text):
    assert isinstance(pii_crf.base_spans(text), list)


def test_masking_overlaps():
    assert pii_crf.mask_text("ab 12345 cd", [(2, 3, 8), (3, 5, 10)]) == "ab <CARD>d"
    assert pii_crf.mask_text("x", []) == "x"


def test_rejection_by_distance():
    rng = random.Random(1)
    idf = np.ones(langid.DIM)
    words = {"a": "the of and tion ing".split(), "b": "der und heit schen ung".split()}
    langs, centres = [], []
    for lang, vocab in words.items():
        x = np.zeros((40, langid.DIM))
        for row in x:
            at, w = langid.vector(" ".join(rng.choice(vocab) for _ in range(60)), idf)
            row[at] = w
        for c in langid.cluster(x, 3)[0]:
            langs.append(lang)
            centres.append(c)
    model = langid.Model(idf, langs, np.array(centres), np.full(len(langs), 0.1))
    assert model.predict("the tion of the ing")[0] == "a" and model.predict("und der schen")[0] == "b"
    assert model.predict("漢字仮名交じり文")[2] is True
    assert model.predict("12 %%") == ("und", 0.0, True) == model.predict(None)


UNLEARNT = {
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja "
          "omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve "
          "birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem "
          "i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "sw": "Watu wote wamezaliwa huru, hadhi na haki zao ni sawa. Wote wamejaliwa akili na dhamiri, hivyo yapasa "
          "watendeane kindugu.",
    "han": "".join(chr(c) for c in random.Random(2).choices(range(0x4e00, 0x9fa5), k=3000)),
    "base64": base64.b64encode(random.Random(3).randbytes(3000)).decode(),
}


def test_learned_limits_reject_unlearnt_languages(spark):
    """The limits that fit() itself sets, and clean documents that must stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(langid.learning_rows(docs))
    for lang, text in UNLEARNT.items():
        for t in (text, text * 20, text.upper()):
            assert model.predict(t)[2], (lang, len(t), model.predict(t))
    clean = docs.where(langid.held_out(docs.doc_id)).select("text", "lang").collect()
    found = [(model.predict(r.text), r.lang) for r in clean]
    assert len(found) > 200 and all(p[0] == lang and not p[2] for p, lang in found)


def test_limits_come_from_texts_not_learned(spark):
    """A language with one repeated text has the limits of the others."""
    rng = random.Random(12)
    text = lambda words: " ".join(rng.choice(words) + rng.choice(words) for _ in range(60))
    rows = [(k, text("the of and tion ing er".split()), "a") for k in range(60)]
    rows += [(100 + k, "der und heit schen ung " * 9, "b") for k in range(40)]
    model = langid.fit(spark.createDataFrame(rows, "key long, text string, lang string"))
    assert not model.predict(text("the of and tion ing er".split()))[2]
    assert model.predict(UNLEARNT["fi"])[2] and model.predict(UNLEARNT["pl"])[2]
    assert np.isfinite(model.limits).all() and model.limits.shape == (len(model.langs), langid.SIZES)


@pytest.mark.parametrize("flags", [{}, {"lstrip": True}])
def test_added_tokens_as_library(flags):
    """Texts that hold added tokens, against the unmodified library."""
    spec = json.loads(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    spec["added_tokens"] = [t | flags for t in spec["added_tokens"]]
    raw = json.dumps(spec).encode()
    tok = Tokenizer.from_str(raw.decode()) if flags else Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["one doc <|endoftext|> next doc", "<|endoftext|>", "<|endoftext|><|endoftext|> a<|endoftext|>b  ",
             "x <|endoftext| > <|END|> plain  \n<|endoftext|>\n é漢", "", "no token here"]
    tokens = repair_tokens.PieceTokens(raw, public_tokenizers.PATTERN)
    for _ in range(2):
        assert [a.tolist() for a in tokens.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert (50256 in tokens.encode(texts)[0]) and tokens.encode(texts[-1:])[0].tolist() == tok.encode(texts[-1]).ids


SPLITTER = repair_tokens.ColumnSplitter()
ODD_CHARS = [*"aZsstdmrevl'''  \n\t5,.<|\x00\x85\xa0", *"é٣²Ⅷ漢😀\u3000\u2003\u200b\u0301\U00010400", "'ll", "'re", " '", "  '"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ODD_CHARS), max_size=12).map("".join), max_size=12), st.booleans())
def test_columns_split_as_the_pattern(texts, sliced):
    col = pa.array(["x's"] + texts, pa.large_string()).slice(1) if sliced else pa.array(texts, pa.string())
    data, at = repair_tokens.text_bytes(col)
    starts = SPLITTER.starts(data, at, np.zeros(len(texts), bool)).tolist()
    got = [data.tobytes()[a:z].decode() for a, z in zip(starts, starts[1:])]
    assert got == [p for t in texts for p in regex.findall(public_tokenizers.PATTERN, t)]


def test_pieces_are_split_and_encoded_by_the_batch(monkeypatch):
    """No text is split on its own, each different piece is encoded once, and every way gives the library's ids."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        raw = f.read()
    rng = random.Random(6)
    texts = ["".join(rng.choices([*ODD_CHARS, " the", "<|endoftext|>", " nation"], k=rng.randint(0, 40))) for _ in range(300)] * 2
    tok = Tokenizer.from_str(raw.decode())
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    spec = json.loads(raw)
    spec["padding"] = {"strategy": {"Fixed": 0}, "direction": "Right", "pad_to_multiple_of": None, "pad_id": 0,
                       "pad_type_id": 0, "pad_token": "!"}
    other = repair_tokens.PieceTokens(json.dumps(spec).encode(), public_tokenizers.PATTERN)
    assert other.model is None and [a.tolist() for a in other.encode(texts)] == want
    other = repair_tokens.PieceTokens(raw, f"(?:{public_tokenizers.PATTERN})")
    assert other.columns is None and [a.tolist() for a in other.encode(texts)] == want
    tokens, learnt = repair_tokens.PieceTokens(raw, public_tokenizers.PATTERN), []
    monkeypatch.setattr(tokens.splitter, "split", lambda text: pytest.fail("a text split on its own"))
    learn = tokens.learn
    monkeypatch.setattr(tokens, "learn", lambda pieces: (learnt.extend(pieces), learn(pieces)))
    assert [a.tolist() for a in tokens.encode(pa.array(texts))] == want and len(set(learnt)) == len(learnt)
    assert tokens.encode([]) == [] and [len(a) for a in tokens.encode(["", ""])] == [0, 0]


def test_letters_are_those_of_the_library():
    """Characters that only newer versions of Unicode know, and one of every 97 others."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        raw = f.read()
    new = [0x558, 0x88F, 0xC5C, 0xA7CE, 0x10940, 0x16EA0, 0x323B0, 0x11DE0]
    texts = [f"!{c}a{c}1{c} {c}'s{c} ; {c}" for c in map(chr, [*new, *(c for c in range(1, 0x110000, 97) if c >> 11 != 27)])]
    tok = Tokenizer.from_str(raw.decode())
    tokens = repair_tokens.PieceTokens(raw, public_tokenizers.PATTERN)
    assert tokens.model is not None
    assert [a.tolist() for a in tokens.encode(texts)] == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_sequence_is_written_out_once(monkeypatch):
    """Chains of rules with one use are put together in the rules, not by passes over the sequence."""
    rng = np.random.default_rng(8)
    passage = rng.integers(0, 40_000, 1500)
    ids = np.concatenate([np.concatenate([passage, rng.integers(0, 40_000, 2000)]) for _ in range(20)])
    passes, unfold = [], repair_tokens.unfold
    monkeypatch.setattr(repair_tokens, "unfold", lambda seq, *a: (passes.append(len(seq)), unfold(seq, *a))[1])
    rules, sizes, lengths, seq = repair_tokens.compress(ids, 50_257)
    assert sum(n >= 20 * 2000 for n in passes) == 1 and len(passes) > 2
    assert (repair_tokens.expand(seq, rules, sizes, 50_257) == ids).all() and lengths.max() == 1500


def most_left(seq):
    """The largest number of non-overlapping occurrences of a pair, counted from the left."""
    count, last = {}, {}
    for k, pair in enumerate(zip(seq.tolist(), seq[1:].tolist())):
        if last.get(pair, -2) != k - 1:
            count[pair], last[pair] = count.get(pair, 0) + 1, k
    return max(count.values(), default=0)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=400), st.integers(2, 5))
def test_grammar_leaves_no_frequent_pair(ids, least):
    ids = np.array(ids, np.uint32)
    rules, sizes, _, seq = repair_tokens.compress(ids, 10, per_round=3, least=least)
    assert most_left(seq) < least and (repair_tokens.expand(seq, rules, sizes, 10) == ids).all()


def test_grammar_of_repeated_passages():
    rng = np.random.default_rng(4)
    passage, words = rng.integers(3, 50_000, 700), rng.integers(3, 50_000, (4000, 3))
    parts = [p for _ in range(150) for p in (passage, words[rng.zipf(1.3, 400) % 4000].ravel())]
    ids = np.concatenate(parts).astype(np.uint32)
    rules, sizes, lengths, seq = repair_tokens.compress(ids, 50_257)
    assert most_left(seq) < repair_tokens.MIN_COUNT and lengths.max() >= 350
    assert (repair_tokens.expand(seq, rules, sizes, 50_257) == ids).all()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2 ** 31), max_size=60))
def test_bits_come_back(values):
    x = np.array(values, np.uint32)
    width = repair_tokens.bits_of(x)
    data = repair_tokens.pack_bits(x, width)
    assert len(data) == (len(x) * width + 7) // 8
    assert (repair_tokens.unpack_bits(data, width, len(x)) == x).all()


def test_shard_of_real_documents_is_smaller(spark):
    """No rule without two uses; the stored shard is well below the same ids as 16-bit numbers."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        tokens = repair_tokens.PieceTokens(f.read(), public_tokenizers.PATTERN)
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()]
    docs = tokens.encode(texts)
    row = repair_tokens.shard_row(0, 0, list(range(len(docs))), docs, tokens.vocab).to_pylist()[0]
    shard = repair_tokens.Shard(row)
    assert (shard.all() == np.concatenate(docs)).all()
    uses = np.bincount(np.concatenate([shard.rules, shard.sequence]), minlength=shard.base + len(shard.lengths))[shard.base:]
    assert len(uses) > 1000 and uses.min() >= 2
    assert sum(len(row[c]) for c in ("rules", "rule_sizes", "lengths", "sequence")) < 1.4 * row["n_ids"]


def test_pairs_that_lose_every_place_get_no_rule():
    """A passage many times between noise: most of its pairs lose to better ones in a round."""
    rng = np.random.default_rng(3)
    passage = rng.integers(0, 40_000, 3000)
    ids = np.concatenate([np.concatenate([passage, rng.integers(0, 40_000, 50)]) for _ in range(20)])
    rules, sizes, lengths, seq = repair_tokens.compress(ids, 50_257)
    assert (repair_tokens.expand(seq, rules, sizes, 50_257) == ids).all()
    assert lengths.max() == 3000 and len(seq) < 20 * 60
    assert np.bincount(np.concatenate([rules, seq]), minlength=50_257 + len(sizes))[50_257:].min() >= 2


def test_language_sample_is_bounded(spark):
    """Null and repeated keys hash alike; still no language gives more than twice its share."""
    rows = [(None, "same text", "aa")] * 3000 + [(7, f"text {i}", "bb") for i in range(3000)]
    rows += [(i, f"text {i}", "cc") for i in range(3000)] + [(None, f"text {i}", "dd") for i in range(3000)]
    rows += [(i, None, f"rare{i}") for i in range(30)]
    df = spark.createDataFrame(rows, "key long, text string, lang string").repartition(7)
    got = {r.lang: r["count"] for r in langid.learning_sample(df, 100, 5, 11).groupBy("lang").count().collect()}
    assert len(got) <= 5 and not any(k.startswith("rare") and k != "rare0" for k in got)
    assert all(n <= 200 for n in got.values())
    assert 60 < got["cc"] < 140 and 60 < got["dd"] < 140


def test_nearest_centroid_as_a_plain_loop(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(langid.learning_rows(docs), per_lang=40)
    for r in docs.limit(80).collect():
        lang, score, rejected = model.predict(r.text or "")
        at, w = langid.vector(r.text or "", model.idf)
        if not len(at):
            assert (lang, score, rejected) == ("und", 0, True)
            continue
        best = max((sum(float(c[a]) * float(x) for a, x in zip(at, w)), -k) for k, c in enumerate(model.centres))
        assert abs(best[0] - score) < 1e-5
        near = sum(float(model.centres[-best[1]][a]) * float(x) for a, x in zip(at, w))
        mine = max(sum(float(c[a]) * float(x) for a, x in zip(at, w)) for n, c in zip(model.langs, model.centres) if n == lang)
        assert abs(mine - near) < 1e-6


def co_training_rows():
    """Labelled rows show the first text feature only, the others the second; the metadata fit all."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(900):
        sign = 1.0 if i % 2 else -1.0
        noise = lambda: float(rng.normal(0, 0.15))
        text = [sign + noise(), 0.0] if i < 100 else [0.0, sign + noise()]
        rows.append((i, text, [sign + noise()], (sign + 1) / 2 if i < 100 else None, i % 5))
    return rows


def test_exchange_teaches_the_weak_view(spark):
    rows = co_training_rows()
    table = spark.createDataFrame(rows, "id long, text_x array<float>, meta_x array<float>, y double, fold int").cache()
    rest = [r for r in rows if r[3] is None]
    right = []
    for rounds in (0, 1):
        text, meta = cotrain.co_train(table, rounds, 0.95, 0.3)
        said = {r.id: r.z for r in table.select("id", text.log_odds().alias("z")).collect()}
        right.append(sum((said[r[0]] > 0) == (r[2][0] > 0) for r in rest) / len(rest))
    assert right[0] < 0.7 and right[1] > 0.99


def test_pseudo_labels_as_by_hand(spark):
    """One round equals fitting on the labels that both views' log-odds, computed here, would give."""
    rows = co_training_rows()
    schema = "id long, text_x array<float>, meta_x array<float>, y double, fold int"
    table = spark.createDataFrame(rows, schema).cache()
    first = dict(zip(("text_x", "meta_x"), cotrain.co_train(table, 0, 0.95, 0.3)))
    odds = {x: (v.weights, v.bias, v.scale, v.shift) for x, v in first.items()}
    limit = np.log(0.95 / 0.05)
    x_of = {"text_x": 1, "meta_x": 2}
    z = {x: [(np.dot(np.float32(r[x_of[x]]), w) + b) * s + t for r in rows] for x, (w, b, s, t) in odds.items()}
    learn = [(r[1], r[2], r[3], 1.0) for r in rows if r[3] is not None and r[4] != cotrain.CALIBRATION_FOLD]
    held = spark.createDataFrame([(r[1], r[2], r[3], 1.0) for r in rows if r[3] is not None and r[4] == cotrain.CALIBRATION_FOLD],
                                 "text_x array<float>, meta_x array<float>, y double, w double")
    after = dict(zip(("text_x", "meta_x"), cotrain.co_train(table, 1, 0.95, 0.3)))
    for x, other in (("text_x", "meta_x"), ("meta_x", "text_x")):
        made = [(r[1], r[2], float(a > 0), 0.3) for r, a, own in zip(rows, z[other], z[x]) if r[3] is None and abs(a) >= limit
                and not (abs(own) >= limit and np.sign(own) != np.sign(a))]
        assert made or x == "meta_x"
        view = cotrain.View(x, spark.createDataFrame(learn + made, held.schema), held)
        assert np.allclose(view.weights + [view.bias], after[x].weights + [after[x].bias], atol=1e-3)


def test_key_ranges_are_even(spark):
    """The largest range holds less than twice the mean."""
    texts = [(r.text or "").encode() for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(400).collect()]
    chunk = suffix_dedup.Chunk(b"".join(texts), np.array([len(t) for t in texts]))
    for ranges in (3, 11, 100):
        size = np.diff(suffix_dedup.cut(chunk.keys, ranges))
        assert size.max() < 2 * size.mean()

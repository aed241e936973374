"""Small tables with every odd case: nulls in any column, empty and very long
texts, ties, repeated rows, extra columns whose names clash with those the
operators use inside."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

WORDS = "the of and ing tion er re the an the on le la der die und que el los as at".split()
CLASH = ["id", "fp", "key", "v", "component", "rank", "cdf", "copy", "n_copies", "order_key", "language", "tkey",
         "lang_pred", "w", "y", "x", "share", "chunk", "range", "part", "block"]


def prose(rng, n, words=WORDS):
    return " ".join(rng.choice(words) + rng.choice(words) for _ in range(n))


def odd_documents():
    rng = random.Random(4)
    passage = prose(rng, 30)
    rows = []

    def add(text, lang="en", source="a", doc_id="next", n_chars="len"):
        doc_id = len(rows) if doc_id == "next" else doc_id
        rows.append((doc_id, text, lang, source, len(text or "") if n_chars == "len" else n_chars))

    for _ in range(12):
        add(prose(rng, 40))
    for lang, words in (("de", "der die und das heit ung sch".split()), ("fr", "le la les tion eau que oi".split())):
        for _ in range(12):
            add(prose(rng, 40, words), lang=lang, source=lang)
    add(None)
    add(None, lang=None, source=None, n_chars=None)
    add("")
    add("   \n\t ")
    add("x")
    add("one<|endoftext|> two <|endoftext|><|endoftext|>")
    add("12 34 %%% 56")
    add("Füße naïve 漢字かな 😀 ½ ʼn \x1c\x85 end", lang=None)
    add("B" * 30_000 + " " + "ab " * 20_000)
    add("mail bob.smith@mail.example.com or +1 (555) 555-0123, 10.0.0.1 and 4111 1111 1111 1111 now")
    add("9@x 999.1.1.1 1.2.3.4.5.6.7.8 4111111111111112 +1 2 a.b@c @d.e +" + "1" * 40)
    for k in range(6):
        add(prose(rng, 8) + " " + passage + " " + prose(rng, 8), source="b" if k % 2 else None)
    for _ in range(40):
        add(rows[0][1], source="hot")
    add(rows[1][1] + " tail")
    add(rows[1][1].upper(), n_chars=-5)
    rows.append(rows[5])
    rows.append(rows[5])
    add("without an id " + prose(rng, 20), doc_id=None)
    add(None, doc_id=None)
    return rows


def write_documents(path, rows, extra=True):
    cols = {n: [r[i] for r in rows] for i, n in enumerate(["doc_id", "text", "lang", "source", "n_chars"])}
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    table = pa.table(cols, schema=pa.schema(list(zip(cols, kinds))))
    if extra:
        for k, name in enumerate(CLASH):
            table = table.append_column(name, pa.array([f"{name}{i % 3}" if (i + k) % 4 else None for i in range(len(rows))],
                                                       pa.string()))
    pq.write_table(table, path)


def write_embeddings(path, rows, extra=True):
    table = pa.table({"vec_id": [r[0] for r in rows], "embedding": [r[1] for r in rows], "label": [None if k % 5 == 0 else k % 3 for k in range(len(rows))]},
                     schema=pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())]))
    if extra:
        for name in ("id", "v", "n", "key", "ids", "score", "rank"):
            table = table.append_column(name, pa.array(["q"] * len(rows), pa.string()))
    pq.write_table(table, path)


def write_labels(path, rows):
    table = pa.table({"doc_id": [r[0] for r in rows], "quality": [r[1] for r in rows], "toxic": [0] * len(rows)},
                     schema=pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())]))
    pq.write_table(table, path)


def odd_embeddings():
    rng = random.Random(8)
    vec = lambda: [rng.gauss(0, 1) for _ in range(16)]
    rows = [(i, vec()) for i in range(160)]
    hub = vec()
    rows += [(200 + i, [x + rng.gauss(0, 0.05) for x in hub]) for i in range(60)]
    rows += [(300, hub), (301, hub), (302, [2 * x for x in hub]), (350, hub), (350, hub)]
    rows += [(400, None), (401, [0.0] * 16), (402, [None] + [1.0] * 15), (403, [float("nan")] + [1.0] * 15),
             (404, [float("inf")] + [1.0] * 15), (405, [1.0, 2.0]), (450, []), (None, vec())]
    # Vectors of other lengths are compared among themselves; ids with several vectors.
    rows += [(500, [1.0, 0.0]), (501, [1.0, 0.1]), (502, [2.0, 0.1]), (503, [0.0, 0.0]), (550, [1.0, 0.2, 0.1]), (551, [1.0, 0.2, 0.2])]
    rows += [(600, [0.0, 1.0]), (600, [1.0, 0.0]), (600, hub), (600, vec()), (650, [0.0, 1.0, 0.0]), (650, [1.0, 0.2]), (500, hub)]
    rows += [(601, [x + rng.gauss(0, 0.01) for x in hub]) for _ in range(40)]
    return rows


def odd_conversations():
    """(conv_id, turn, role, text): shared beginnings, copies, ties, nulls in any column, a long
    conversation, ids whose group has no first conversation, negative ids."""
    rng = random.Random(11)
    turn = lambda i: ("user" if i % 2 == 0 else "assistant", f"turn {i} " + rng.choice(["a", "b é😀", ""]))
    rows = []
    for c in [0, 1, 2, 3, 7, 8, 99, 100, 101, 150, 230, 231, 399, 400, -5, -100, -101, -150]:
        rows += [(c, i, *turn(i)) for i in range(rng.randrange(1, 9))]
    shared = [("system", "be kind"), ("user", "hello"), ("assistant", "yes")]
    for c in range(500, 540):
        rows += [(c, i, r, t) for i, (r, t) in enumerate(shared[:1 + c % 3] + [turn(9)] * (c % 4 == 0))]
    rows += [(600, i, "user", f"long {i % 3}") for i in range(300)]
    rows += [(601, None, "user", "no turn"), (601, 1, None, "no role"), (601, 1, "user", None), (601, 2, None, None), (601, 0, "", "")]
    rows += [(602, 1, "user", "tie"), (602, 1, "user", "tie"), (602, 1, "assistant", "tie"), (602, 1, "user", "other")]
    rows += [(None, 0, "user", "no conversation"), (700, 0, "user", "x" * 200_000)]
    rows += [(999, 0, "u", "s"), (998, 0, "us", "")]
    rng.shuffle(rows)
    return rows


def write_conversations(path, rows, extra=True):
    table = pa.table({n: [r[i] for r in rows] for i, n in enumerate(["conv_id", "turn", "role", "text"])},
                     schema=pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
    if extra:
        for name in ("conv", "pos", "digest", "chars", "len", "depth", "z1", "rows", "key"):
            table = table.append_column(name, pa.array(["q"] * len(rows), pa.string()))
    pq.write_table(table, path)


@pytest.fixture(scope="session")
def odd_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("odd")
    docs = odd_documents()
    write_documents(d / "documents.parquet", docs)
    write_embeddings(d / "embeddings.parquet", odd_embeddings())
    write_labels(d / "labels.parquet", [(i, (i % 3 > 0) + 0 if i % 5 else None) for i in range(50)] + [(None, 1), (3, 0), (3, 1)])
    write_conversations(d / "conversations.parquet", odd_conversations())
    return str(d)


@pytest.fixture(scope="session")
def empty_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("empty")
    write_documents(d / "documents.parquet", [])
    write_embeddings(d / "embeddings.parquet", [])
    write_labels(d / "labels.parquet", [])
    write_conversations(d / "conversations.parquet", [])
    return str(d)


@pytest.fixture(scope="session")
def odd_rows():
    return odd_documents()


@pytest.fixture(scope="session")
def odd_vectors():
    return odd_embeddings()

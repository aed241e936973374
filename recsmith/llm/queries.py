"""The queries of this subpackage: one ``opN_<name>`` per operator, applied
with production parameters to its whole table. ``QUERIES`` and ``SQL`` are
merged into the catalogue by ``__spark_entry__.py``."""

from __future__ import annotations

import hashlib
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from recsmith.session import scratch_path
from recsmith.llm import ann_bits, bpe_prefix, bpe_tree, cotrain, int8_dedup, langid, mixing, orchard_codes, pii_crf
from recsmith.llm import prefix_trie, repair_tokens, simhash, suffix_dedup
from recsmith.llm.common import store

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_ann_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every vector whose id is divisible by 50."""
    return ann_bits.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


@query
def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(langid.learning_rows(docs))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred", "language.score",
        "language.rejected")


@query
def op3_cotrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from its text and its metadata."""
    scored = cotrain.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumnRenamed("id", "doc_id")


@query
def op4_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans and those the model adds."""
    p = pii_crf.find_pii(table(spark, sf_dir, "documents"))
    return p.select(F.col("id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone",
                    F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replicated corpus, by document and copy, in its shuffled order."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, epochs=1.0, seed=5).select("doc_id", "source", "n_copies", "copy", "order_key")


SQL["op5_mixing"] = """
WITH size AS (
  SELECT source, sum(coalesce(length(text), 0))::BIGINT AS chars FROM documents GROUP BY source),
tot AS (SELECT sum(chars)::DOUBLE AS total, sum(sqrt(chars::DOUBLE)) AS wanted FROM size),
rate AS (
  SELECT source, CASE WHEN chars > 0 THEN sqrt(chars::DOUBLE) / wanted * total / chars ELSE 1.0 END AS rate
  FROM size, tot),
j AS (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 40)::BIGINT + 1)) AS j FROM rate),
fact AS (
  SELECT *, sum(CASE WHEN j > 0 THEN ln(j) ELSE 0.0 END) OVER (PARTITION BY source ORDER BY j) AS log_fact FROM j),
cdf AS (
  SELECT source, j, sum(CASE WHEN rate > 0 THEN exp(j * ln(rate) - rate - log_fact) WHEN j = 0 THEN 1.0 ELSE 0.0 END)
    OVER (PARTITION BY source ORDER BY j) AS p FROM fact),
u AS (
  SELECT doc_id, source, (('0x' || substr(md5('5:' || doc_id), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 AS u
  FROM documents),
drawn AS (
  SELECT u.doc_id, u.source, count(*) FILTER (WHERE cdf.p < u.u) AS n_copies
  FROM u JOIN cdf ON u.source IS NOT DISTINCT FROM cdf.source GROUP BY u.doc_id, u.source),
each AS (SELECT *, unnest(range(1, n_copies + 1)) AS copy FROM drawn WHERE n_copies > 0)
SELECT doc_id, source, n_copies, copy, md5('order5:' || doc_id || ':' || copy) AS order_key FROM each"""


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 50 bytes that start in
    a document of smaller id."""
    r = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return r.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"),
                    F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_int8_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors linked by a cosine of 0.95 or more."""
    g = int8_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)
    return g.withColumnRenamed("id", "vec_id")


SQL["op7_int8_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE CASE WHEN len(embedding) > 0 AND list_count(embedding) = len(embedding)
    THEN isfinite(list_sum(embedding::DOUBLE[])) AND list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0
    ELSE false END),
link AS (
  SELECT DISTINCT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.95 ELSE false END),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
comp AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
cnt AS (SELECT x AS vec_id, count(*) AS n FROM link GROUP BY x)
SELECT comp.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, comp.vec_id = component_id AS kept
FROM comp LEFT JOIN cnt USING (vec_id)"""


@query
def op8_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as read back from their Re-Pair shards."""
    path = scratch_path(spark, f"shards-{uuid.uuid4().hex}")
    repair_tokens.write_shards(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"),
                               public_tokenizers.PATTERN, end_id=2)
    docs = repair_tokens.read_documents(spark, path)
    return docs.select(F.col("id").alias("doc_id"), "start", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: 3-word shingles, at most 2 bits apart."""
    g = simhash.simhash_groups(table(spark, sf_dir, "documents"), width=3, seed=42, max_bits=2)
    return g.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id")


@query
def op10_bpe_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the rank file, and the bytes they decode to."""
    vocab = bpe_prefix.Vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    done = bpe_prefix.encode_documents(table(spark, sf_dir, "documents"), vocab, decoded=True)
    return done.select(F.col("id").alias("doc_id"), (F.length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op11_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors, 16 parts of 64 entries, with the error of their labels."""
    vectors = table(spark, sf_dir, "embeddings")
    books = orchard_codes.learn(vectors, parts=16, entries=64, rounds=2, scale=256)
    coded = store(orchard_codes.encode(vectors, books, keep=["label"], scale=256), "codes")
    labels = coded.groupBy(F.col("keep_label").alias("label")).agg(F.sum("error").alias("label_error"))
    return (coded.join(labels, F.col("keep_label").eqNullSafe(F.col("label")))
            .join(F.broadcast(orchard_codes.digests(spark, books)), "length")
            .select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
                    "codebooks_sha256"))


SQL["op11_orchard"] = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS n, vec_id, label,
    [floor(256 * x::DOUBLE) for x in embedding] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND list_count([x for x in embedding if isfinite(x)]) = len(embedding)),
part AS MATERIALIZED (
  SELECT n, p, x[p * len(x) // 16 + 1 : (p + 1) * len(x) // 16] AS y FROM v, (SELECT unnest(range(16)) AS p)),
book AS (
  SELECT 0 AS round, p, n - 1 AS e, y FROM part WHERE n <= 64
  UNION ALL
  (WITH pair AS (
     SELECT part.n, part.p, e,
       list_inner_product(part.y, part.y) - 2 * list_inner_product(part.y, book.y) + list_inner_product(book.y, book.y) AS d
     FROM part JOIN book USING (p) WHERE round < 2),
   near AS (SELECT n, p, arg_min(e, d * 64 + e) AS e FROM pair GROUP BY n, p),
   each AS (SELECT p, e, unnest(y) AS c, generate_subscripts(y, 1) AS i FROM near JOIN part USING (n, p)),
   mean AS (SELECT p, e, i, floor(sum(c) / count(*)) AS m FROM each GROUP BY p, e, i),
   made AS (SELECT p, e, list(m ORDER BY i) AS y FROM mean GROUP BY p, e)
   SELECT round + 1, book.p, book.e, coalesce(made.y, book.y)
   FROM book LEFT JOIN made ON book.p = made.p AND book.e = made.e WHERE round < 2)),
last AS (SELECT p, e, y FROM book WHERE round = 2),
pair AS (
  SELECT n, part.p, e,
    list_inner_product(part.y, part.y) - 2 * list_inner_product(part.y, last.y) + list_inner_product(last.y, last.y) AS d
  FROM part JOIN last USING (p)),
near AS (SELECT n, p, min(d * 64 + e)::BIGINT AS d FROM pair GROUP BY n, p),
code AS (
  SELECT n, string_agg(printf('%02x', d % 64), '' ORDER BY p) AS code, sum(d // 64)::BIGINT AS error
  FROM near GROUP BY n),
sha AS (SELECT sha256(string_agg(array_to_string([c::BIGINT for c in y], ','), ',' ORDER BY p, e)) AS s FROM last)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, s AS codebooks_sha256
FROM code JOIN v USING (n), sha"""


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations with the sums of its subtrees."""
    turns = prefix_trie.turns(table(spark, sf_dir, "conversations"))
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % 6
    paths = prefix_trie.paths(*prefix_trie.rebuild(turns, head, group=100))
    none = hashlib.sha256(b"").hexdigest()
    return (prefix_trie.trie(paths).join(prefix_trie.end_digests(paths), prefix_trie.KEY, "left")
            .select(F.col("first_conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs",
                    "n_children", "n_leaves", F.col("saved_chars").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))


SQL["op12_prefix_trie"] = """
WITH RECURSIVE turn AS (
  SELECT conv_id AS c, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
    length(coalesce(text, '')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
crc AS (
  SELECT DISTINCT c, 0 AS step, c::VARCHAR AS t, 4294967295::BIGINT AS r FROM turn
  UNION ALL
  SELECT c, step + 1, t,
    CASE WHEN step % 9 = 0 THEN xor(r, ascii(substr(t, step // 9 + 1, 1))::BIGINT)
      ELSE xor(r >> 1, (r & 1) * 3988292384) END
  FROM crc WHERE step < 9 * length(t)),
head AS (SELECT c, xor(r, 4294967295) % 6 AS h, c - c % 100 AS b FROM crc WHERE step = 9 * length(t)),
lent AS (SELECT head.c, turn.i AS d, turn.k, turn.chars FROM head JOIN turn ON turn.c = head.b AND turn.i <= head.h),
taken AS (SELECT c, count(*) AS m FROM lent GROUP BY c),
own AS (
  SELECT c, i - h + coalesce(m, 0) AS d, k, chars
  FROM turn JOIN head USING (c) LEFT JOIN taken USING (c) WHERE i > h),
built AS (SELECT * FROM lent UNION ALL SELECT * FROM own),
path AS (
  SELECT c, d, chars, md5(string_agg(k, '') OVER (PARTITION BY c ORDER BY d)) AS z FROM built
  UNION ALL SELECT c, 0, 0, '' FROM head),
last AS (SELECT c, max(d) AS d FROM path GROUP BY c),
node AS (SELECT d, z, min(c) AS c, count(*) AS n, max(chars) AS chars FROM path GROUP BY d, z),
edge AS (
  SELECT node.d, node.z, up.z AS up, over.c AS p
  FROM node JOIN path up ON up.c = node.c AND up.d = node.d - 1 JOIN node over ON over.d = up.d AND over.z = up.z),
kids AS (SELECT d - 1 AS d, up AS z, count(*) AS kids FROM edge GROUP BY d, up),
own_sum AS (
  SELECT node.*, coalesce(kids, 0) AS kids, CASE WHEN kids IS NULL THEN 1 ELSE 0 END AS leaf, (n - 1) * chars AS saved
  FROM node LEFT JOIN kids USING (d, z)),
total AS (
  SELECT a.d, a.z, sum(leaf)::BIGINT AS leaves, sum(saved)::BIGINT AS saved
  FROM own_sum o JOIN path a ON a.c = o.c AND a.d <= o.d GROUP BY a.d, a.z),
ends AS (
  SELECT path.d, path.z, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS sha FROM path JOIN last USING (c, d)
  GROUP BY path.d, path.z)
SELECT o.c AS conv_id, d::BIGINT AS depth, p AS parent_conv_id, n AS n_convs, o.kids::BIGINT AS n_children,
  leaves AS n_leaves, total.saved AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
FROM own_sum o JOIN total USING (d, z) LEFT JOIN edge USING (d, z) LEFT JOIN ends USING (d, z)"""


@query
def op13_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the tokenizer file, and the text they decode to."""
    tokenizer = bpe_tree.TokenizerFile(spark, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    done = bpe_tree.encode_documents(table(spark, sf_dir, "documents"), tokenizer)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return done.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))

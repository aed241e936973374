"""Quality classification by co-training.

Two views of a document never see each other's features: its text (shares of
character classes and of their bigrams, word and line statistics) and its
metadata (source, language, stated length). Each has a logistic regression,
fitted by Spark ML over all labelled rows, and a Platt calibration fitted on a
fold that is kept out. In every round each view is fitted again with the other
view's confident labels of unlabelled documents added at a lower weight. At the
end every document is scored: the mean of the views' calibrated log-odds.

Features are extracted once, in one pass over the whole texts, and stored;
rounds read that narrow table, and a view's score is a native column expression.

Defined cases: null text is empty; null metadata is a value of its own; a
document with several labels takes the smallest; without labels of both classes
the views cannot be fitted and every score is the share of good labels (0.5
without any); repeated rows and null ids are rows like others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from recsmith.llm.common import small_batches, store

CLASSES = 6
N_TEXT = CLASSES * CLASSES + CLASSES + 8
SOURCES, LANGS = 64, 16
CALIBRATION_FOLD = 0


def char_classes() -> np.ndarray:
    """lower, upper, digit, space, sentence mark, other - of the first 64K code points."""
    kind = np.full(1 << 16, 5, np.uint8)
    for c in range(1 << 16):
        s = chr(c)
        kind[c] = 0 if s.islower() else 1 if s.isupper() else 2 if s.isdigit() else 3 if s.isspace() else \
            4 if s in ".,;:'\"-()?" else 0 if s.isalpha() else 5
    return kind


_CLASSES: list[np.ndarray] = []


def text_features(text: str) -> list[float]:
    if not _CLASSES:
        _CLASSES.append(char_classes())
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = np.where(code < (1 << 16), _CLASSES[0][np.minimum(code, (1 << 16) - 1)], 0).astype(np.int64)
    n = max(len(kind), 1)
    single = np.bincount(kind, minlength=CLASSES) / n
    double = np.bincount(kind[:-1] * CLASSES + kind[1:], minlength=CLASSES * CLASSES) / n if len(kind) > 1 \
        else np.zeros(CLASSES * CLASSES)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    w, m = max(len(words), 1), max(len(lines), 1)
    more = [np.log1p(len(code)), np.log1p(len(words)), len(set(words)) / w, len(set(lines)) / m, len(code) / w,
            np.log1p(len(code) / m), text.count("|") / w, text.count("!") / w]
    return [*single.tolist(), *double.tolist(), *map(float, more)]


def features(df: DataFrame, labels: DataFrame, id_col: str, text: str, source: str, lang: str, n_chars: str,
             label: str) -> DataFrame:
    """``id``, ``text_x``, ``meta_x``, ``y`` (null: unlabelled), ``fold``."""
    small_batches(df.sparkSession)

    @F.pandas_udf("array<float>")
    def extract(texts: pd.Series) -> pd.Series:
        return pd.Series([text_features(t) for t in texts], dtype=object)

    def one_of(col: str, n: int):
        at = F.pmod(F.xxhash64(F.coalesce(F.col(col).cast("string"), F.lit("\0null"))), F.lit(n))
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (i == at).cast("float"))

    length = F.array(F.log1p(F.greatest(F.coalesce(F.col(n_chars).cast("double"), F.lit(0.0)), F.lit(0.0))).cast("float"),
                     F.col(n_chars).isNull().cast("float"))
    rows = df.select(F.col(id_col).cast("long").alias("id"), extract(F.coalesce(F.col(text), F.lit(""))).alias("text_x"),
                     F.concat(one_of(source, SOURCES), one_of(lang, LANGS), length).alias("meta_x"))
    given = (labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(F.col(label).cast("double")).alias("y")))
    fold = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(5)).alias("fold")
    return store(rows.join(given, "id", "left").select("*", fold), "quality_features")


def dot(x: str, weights: list[float], bias: float):
    w = F.array(*[F.lit(float(c)) for c in weights])
    return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(float(bias)), lambda acc, v: acc + v)


def logistic(rows: DataFrame, x: str, rounds: int, reg: float) -> tuple[list[float], float]:
    m = LogisticRegression(featuresCol="v", labelCol="y", weightCol="w", maxIter=rounds, regParam=reg).fit(
        rows.select(array_to_vector(F.col(x)).alias("v"), "y", "w"))
    return list(m.coefficients), float(m.intercept)


class View:
    """A fitted, calibrated view: ``log_odds`` is a column over the feature table."""

    def __init__(self, x: str, rows: DataFrame, held: DataFrame):
        self.x = x
        self.weights, self.bias = logistic(rows, x, 25, 1e-3)
        margin = held.select(F.array(dot(x, self.weights, self.bias)).alias("m"), "y", "w")
        scale, self.shift = logistic(margin, "m", 15, 1e-3)
        self.scale = scale[0]

    def log_odds(self):
        return dot(self.x, self.weights, self.bias) * F.lit(self.scale) + F.lit(self.shift)


def sigmoid(z):
    return 1 / (1 + F.exp(-z))


def co_train(table: DataFrame, rounds: int, sure: float, weight: float) -> tuple[View, View] | None:
    """Both views after ``rounds`` exchanges; None without both classes in both folds."""
    known = table.where("y is not null").withColumn("w", F.lit(1.0))
    held, learn = known.where(F.col("fold") == CALIBRATION_FOLD), known.where(F.col("fold") != CALIBRATION_FOLD)
    n = known.agg(*[F.countDistinct(F.when(c, F.col("y"))) for c in
                    (F.col("fold") == CALIBRATION_FOLD, F.col("fold") != CALIBRATION_FOLD)]).first()
    if min(n) < 2:
        return None
    views = {x: View(x, learn, held) for x in ("text_x", "meta_x")}
    limit = float(np.log(sure / (1 - sure)))
    for _ in range(rounds):
        made = {}
        for x, other in (("text_x", "meta_x"), ("meta_x", "text_x")):
            said, own = views[other].log_odds(), views[x].log_odds()
            # A label that the view itself is sure to be wrong is not taken.
            taken = (F.abs(said) >= limit) & ~((F.abs(own) >= limit) & (F.signum(own) != F.signum(said)))
            pseudo = table.where("y is null").where(taken).select(
                x, (said > 0).cast("double").alias("y"), F.lit(weight).alias("w"))
            made[x] = View(x, learn.select(x, "y", "w").union(pseudo), held)
        views = made
    return views["text_x"], views["meta_x"]


def classify(df: DataFrame, labels: DataFrame, rounds: int = 2, sure: float = 0.95, weight: float = 0.3,
             id_col: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
             n_chars: str = "n_chars", label: str = "quality") -> DataFrame:
    """``id``, ``p_text``, ``p_meta``, ``score`` (probability of good quality),
    ``good`` (score of one half or more) of every row."""
    table = features(df, labels, id_col, text, source, lang, n_chars, label)
    views = co_train(table, rounds, sure, weight)
    if views is None:
        share = table.agg(F.avg("y")).first()[0]
        share = F.lit(0.5 if share is None else float(share))
        return table.select("id", share.alias("p_text"), share.alias("p_meta"), share.alias("score"),
                            (share >= 0.5).alias("good"))
    a, b = views
    return (table.select("id", a.log_odds().alias("a"), b.log_odds().alias("b"))
            .select("id", sigmoid(F.col("a")).alias("p_text"), sigmoid(F.col("b")).alias("p_meta"),
                    sigmoid((F.col("a") + F.col("b")) / 2).alias("score"))
            .withColumn("good", F.col("score") >= 0.5))

"""Mixing sources to target weights by Poisson replication.

A source with target share ``w`` of a total of ``epochs`` times the corpus's
characters gets the mean repetition rate w * total / its characters. Every
document draws its number of copies from the Poisson distribution of that mean
by inverting it at a number hashed from the seed and its id, so the draw does
not depend on partitions or retries. Copies are exploded and the whole corpus
is shuffled: rows are dealt out and sorted by a hash of (seed, id, copy).

The distribution functions are a table with one array per source, stored first;
the planner broadcasts it only if its stored size allows. Sums are partial per
task, so a source that holds a third of all rows is no hot group.

Defined cases: a null source is a source; null text has no characters; a source
without characters keeps the mean 1; a source without a target weight gets none
of the total (no copies); null ids draw like the empty id; repeated rows draw
alike; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from recsmith.llm.common import shuffle_partitions, store

# 52 bits of the hash, so that the number is exact in double precision.
HEX, UNIT = 13, float(1 << 52)


def unit_number(seed: int, *cols):
    """A number in (0, 1) hashed from the seed and the columns."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, HEX), 16, 10).cast("double") + 0.5) / UNIT


def source_rates(df: DataFrame, weights: dict | None, epochs: float, source: str, text: str) -> DataFrame:
    """``source``, ``rate``: without given weights the target share of a source
    is in proportion to the square root of its characters."""
    size = df.groupBy(F.col(source).alias("source")).agg(
        F.sum(F.coalesce(F.length(text), F.lit(0))).cast("long").alias("chars"))
    if weights is None:
        want = F.sqrt(F.col("chars").cast("double"))
    else:
        want = F.lit(0.0)
        for name, w in weights.items():
            want = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(want)
    size = store(size.withColumn("want", want), "source_sizes")
    total = size.agg(F.sum("chars").cast("double").alias("total"), F.sum("want").alias("wanted")).first()
    rate = F.col("want") / F.lit(total.wanted or 1.0) * F.lit(total.total or 0.0) * F.lit(float(epochs)) / F.col("chars")
    return size.select("source", F.when(F.col("chars") > 0, rate).otherwise(F.lit(1.0)).alias("rate"))


def distributions(rates: DataFrame) -> DataFrame:
    """``source``, ``rate``, ``cdf``: P(copies <= j) for j = 0, 1, ... until the
    rest is below what a double can tell."""
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 40).cast("int")
    j = rates.select("source", "rate", F.explode(F.sequence(F.lit(0), last)).alias("j"))
    so_far = Window.partitionBy("source").orderBy("j")
    fact = j.withColumn("log_fact", F.sum(F.when(F.col("j") > 0, F.log("j")).otherwise(0.0)).over(so_far))
    mass = F.when(F.col("rate") > 0, F.exp(F.col("j") * F.log("rate") - F.col("rate") - F.col("log_fact"))).otherwise(
        (F.col("j") == 0).cast("double"))
    cdf = fact.select("source", "rate", "j", F.sum(mass).over(so_far).alias("p"))
    return (cdf.groupBy("source", "rate").agg(F.array_sort(F.collect_list(F.struct("j", "p"))).alias("steps"))
            .select("source", "rate", F.col("steps.p").alias("cdf")))


def with_copies(df: DataFrame, weights: dict | None = None, epochs: float = 1.0, seed: int = 5, id_col: str = "doc_id",
                source: str = "source", text: str = "text", name: str = "n_copies") -> DataFrame:
    """``df`` with its number of copies as column ``name``."""
    table = store(distributions(source_rates(df, weights, epochs, source, text)), "source_rates").select(
        F.col("source").alias("__source"), F.col("cdf").alias("__cdf"))
    drawn = df.join(table, F.col(source).eqNullSafe(F.col("__source")), "left")
    u = unit_number(seed, F.col(id_col))
    below = F.size(F.filter("__cdf", lambda p: p < u)).cast("long")
    return drawn.withColumn(name, below).drop("__source", "__cdf")


def mix(df: DataFrame, weights: dict | None = None, epochs: float = 1.0, seed: int = 5, id_col: str = "doc_id",
        source: str = "source", text: str = "text",
        names: tuple[str, str, str] = ("n_copies", "copy", "order_key")) -> DataFrame:
    """The copies of all rows in shuffled order: the columns of ``df`` and, under
    ``names``, the number of copies, the copy's own number (from 1) and the key
    it is shuffled by. Columns of ``df`` that have one of these names give way;
    choose others to keep them."""
    n, copy, order = names
    drawn = with_copies(df, weights, epochs, seed, id_col, source, text, n).where(F.col(n) > 0)
    each = drawn.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))))
    key = F.md5(F.concat_ws(":", F.lit(f"order{seed}"), F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                            F.col(copy).cast("string")).cast("binary"))
    return (each.withColumn(order, key).repartition(shuffle_partitions(df.sparkSession), order)
            .sortWithinPartitions(order))

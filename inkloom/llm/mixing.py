"""Operator 6: mixing sources to target weights by Poisson replication (native)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize

#: Target weights that are taken at most, and bytes of the sources' tables that are broadcast at most.
MAX_SOURCES, MAX_BROADCAST_BYTES = 100_000, 50_000_000
#: The highest rate of one draw; a higher one is the sum of equal independent draws, as exp(-rate) would underflow.
MAX_RATE = 500.0


def uniform(*parts: Column, seed: int) -> Column:
    """A number in [0, 1) with 52 random bits from the MD5 of a seed and the parts; SQL engines agree on it."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def poisson_table(rate: Column) -> Column:
    """Cumulative probabilities of a Poisson distribution for 0, 1, 2 ... up to 12 deviations above its mean."""
    top = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    zero = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("all"))
    return F.aggregate(
        F.sequence(F.lit(1), top),
        zero,
        lambda a, k: F.struct((a["p"] * rate / k).alias("p"), (a["sum"] + a["p"] * rate / k).alias("sum"), F.concat(a["all"], F.array(a["sum"] + a["p"] * rate / k)).alias("all")),
        lambda a: a["all"],
    )


def rates(docs: DataFrame, weights: DataFrame, total: float | None = None) -> DataFrame:
    """``(source, size, rate)``: the mean repetitions of a document that bring each source to its share of ``total``.

    ``weights(source, weight)`` lists sources; others, and null, share what the listed ones leave of 1 in proportion
    to their size. ``total`` is the number of documents wanted, by default as many as there are.
    """
    sizes = docs.groupBy("source").agg(F.count(F.lit(1)).alias("size"))
    both = sizes.join(F.broadcast(weights.groupBy("source").agg(F.sum("weight").alias("weight"))), "source", "left")
    sums = both.agg(F.sum("size").alias("docs"), F.sum(F.when(F.col("weight").isNull(), F.col("size"))).alias("rest"), F.sum("weight").alias("given"))
    both = both.crossJoin(F.broadcast(sums))  # sums is one row
    left = F.greatest(F.lit(0.0), 1 - F.coalesce("given", F.lit(0.0)))
    share = F.coalesce(F.col("weight"), left * F.col("size") / F.col("rest")) / F.when(F.col("rest").isNull(), F.col("given")).otherwise(F.greatest(F.lit(1.0), F.coalesce("given", F.lit(0.0))))
    wanted = F.lit(float(total)) if total is not None else F.col("docs").cast("double")
    return both.select("source", "size", (share * wanted / F.col("size")).alias("rate"))


def poisson_mix(docs: DataFrame, weights: Mapping[str, float], total: float | None = None, seed: int = 42) -> DataFrame:
    """Every document as often as a Poisson number with its source's rate says, in a global random order.

    Adds ``copy`` (1, 2 ...) and ``shuffle_key``; rows are dealt to partitions and sorted within them by that key. The
    number is the inverse of the distribution at a uniform number hashed from the seed and the doc_id, so each document
    decides alone, reruns agree, and no source, however large, is gathered. A rate above ``MAX_RATE`` is split into equal
    parts, each drawn with a uniform number of its own; the sum of independent Poisson numbers is one of the whole rate.

    A null source is a source of its own, at the rest's rate. Rows with one doc_id draw the same number. A weight of
    zero drops its source. Weights of sources that are absent go unused. Columns of the input that are named as the
    two added ones give way to them; all others stay, whatever their names. No rows: no rows.
    """
    if len(weights) > MAX_SOURCES:
        raise ValueError(f"at most {MAX_SOURCES} weights")
    spark = docs.sparkSession
    docs = docs.drop("copy", "shuffle_key")
    given = spark.createDataFrame([(str(k), float(v)) for k, v in weights.items()], "source string, weight double")
    names = [free_name(n, docs.columns) for n in ("_source", "_parts", "_table", "_n")]
    source, parts, cdf, times = names
    split = F.greatest(F.lit(1.0), F.ceil(F.col("rate") / MAX_RATE))
    rate = materialize(rates(docs, given, total).select(F.col("source").alias(source), split.cast("int").alias(parts), poisson_table(F.col("rate") / split).alias(cdf)))
    size = rate.agg(F.sum(F.size(cdf) * 8 + 64).alias("n")).collect()[0]["n"] or 0
    # Beyond the bound Spark joins by a shuffle that AQE can split.
    rate = F.broadcast(rate) if size <= MAX_BROADCAST_BYTES else rate

    def draw(u: Column) -> Column:
        return F.size(F.filter(cdf, lambda c: c <= u))

    first = draw(uniform(F.col("doc_id"), seed=seed))
    more = F.aggregate(F.sequence(F.lit(2), F.col(parts)), F.lit(0), lambda a, k: a + draw(uniform(F.col("doc_id"), k, seed=seed + 2)))
    joined = docs.join(rate, docs["source"].eqNullSafe(rate[source])).withColumn(times, F.when(F.col(parts) > 1, first + more).otherwise(first))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    copies = joined.where(F.col(times) > 0).select(*kept, F.explode(F.sequence(F.lit(1), F.col(times))).alias("copy"))
    keyed = copies.withColumn("shuffle_key", uniform(F.col("doc_id"), F.col("copy"), seed=seed + 1))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")

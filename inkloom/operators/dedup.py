"""Ordered near-duplicate removal by 64-bit hashes: a row stays if it is far from all that stayed before it."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.functions import bits
from inkloom.sources.tables import materialize, unsized

#: Up to so many rows are folded in one task; beyond, links are sought by blocks and resolved in rounds.
FOLD_ROWS = 5_000
#: Up to this distance bound buckets of equal bits hold the links; beyond, there are too many masks.
BLOCK_LIMIT = 12
CHUNK = 8192


def fold(rows: DataFrame, distance: int) -> DataFrame:
    """The rows ``(ord, h)`` that stay, by one ordered pass over an array; for bounded inputs."""
    ordered = rows.agg(F.array_sort(F.collect_list(F.struct("ord", "h"))).alias("all"))
    none = F.array().cast("array<struct<ord:bigint,h:bigint>>")
    kept = F.aggregate("all", none, lambda acc, x: F.when(F.exists(acc, lambda k: bits.hamming(k["h"], x["h"]) < distance), acc).otherwise(F.array_append(acc, x)))
    return ordered.select(F.inline(kept))


def close_pairs(rows: DataFrame, distance: int) -> DataFrame:
    """``(a, b)``: ords of all rows ``(ord, h)``, a < b, that differ in fewer than ``distance`` bits."""
    if distance > BLOCK_LIMIT:
        return _by_chunks(rows, distance)
    if distance <= 0:
        return rows.select(F.col("ord").alias("a"), F.col("ord").alias("b")).limit(0)
    rows = materialize(rows)  # else the hash would be made anew for every mask
    masks = F.array(*[F.lit(m).cast("bigint") for m in bits.masks(distance - 1, rows.count())])
    keyed = rows.select("ord", "h", F.posexplode(masks).alias("no", "mask")).select("ord", "h", F.xxhash64("no", F.col("h").bitwiseAND(F.col("mask"))).alias("key"))
    # The planner counts the keys of a row as one, so it would broadcast what is hundreds of times larger than it believes.
    x, y = keyed.alias("x"), keyed.hint("merge").alias("y")
    same = (F.col("x.key") == F.col("y.key")) & (F.col("x.ord") < F.col("y.ord"))
    near = same & (bits.hamming(F.col("x.h"), F.col("y.h")) < distance)
    return x.join(y, near).select(F.col("x.ord").alias("a"), F.col("y.ord").alias("b")).distinct()


def _by_chunks(rows: DataFrame, distance: int) -> DataFrame:
    """As ``close_pairs`` for bounds that blocks don't serve: rows are dealt into chunks, and each pair of chunks is
    compared in one task, so memory is bounded; the comparisons, not the rows, grow with the square."""
    chunks = max(1, -(-rows.count() // CHUNK))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("ord"), F.lit(chunks)).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    pairs = dealt.select(F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "ord", "h")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pdf["i"].iat[0], pdf["j"].iat[0]
        left, right = pdf[pdf["chunk"] == i], pdf[pdf["chunk"] == j]
        # Unsigned, as numpy counts the bits of a signed number's absolute value.
        x_h, h, o = left["h"].to_numpy().view(np.uint64), right["h"].to_numpy().view(np.uint64), right["ord"].to_numpy()
        # Arrays, made one frame at the end: a frame for each row took far longer than the comparing.
        firsts, others = [], []
        for at, x in zip(left["ord"].to_numpy(), x_h):
            near = o[np.bitwise_count(h ^ x) < distance]
            near = near[(near > at) if i == j else (near != at)]
            if len(near):
                firsts.append(np.full(len(near), at))
                others.append(near)
        if not firsts:
            return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
        one, other = np.concatenate(firsts), np.concatenate(others)
        return pd.DataFrame({"a": np.minimum(one, other), "b": np.maximum(one, other)})

    return pairs.groupBy("i", "j").applyInPandas(compare, "a bigint, b bigint")


def resolve(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows that stay, from all close pairs: in each round those without an open earlier neighbour stay, and
    their later neighbours go. Each round is checkpointed; rounds grow with the longest chain of neighbours."""
    open_pairs = unsized(pairs)
    gone = None
    while not open_pairs.isEmpty():
        blocked = open_pairs.select(F.col("b").alias("ord")).distinct()
        stay = open_pairs.select(F.col("a").alias("ord")).distinct().join(blocked, "ord", "left_anti")
        out = unsized(open_pairs.join(stay.withColumnRenamed("ord", "a"), "a", "left_semi").select(F.col("b").alias("ord")).distinct())
        gone = out if gone is None else unsized(gone.unionByName(out))
        closed = out.unionByName(stay)
        rest = open_pairs.join(out.withColumnRenamed("ord", "b"), "b", "left_anti")
        open_pairs = unsized(rest.join(closed.withColumnRenamed("ord", "a"), "a", "left_anti"))
    return rows if gone is None else rows.join(gone, "ord", "left_anti")


def greedy_dedup(rows: DataFrame, distance: int, fold_rows: int = FOLD_ROWS) -> DataFrame:
    """Of ``rows(ord, h)`` those that stay when, in the order of the distinct ``ord``, a row goes if it differs in
    fewer than ``distance`` bits from one that stayed. A distance of zero keeps all."""
    if distance <= 0:
        return rows
    rows = materialize(rows)
    if rows.limit(fold_rows + 1).count() <= fold_rows:
        return fold(rows, distance)
    # Of equal hashes the first stays alone if it stays, and goes with the others if it goes.
    firsts = materialize(rows.groupBy("h").agg(F.min("ord").alias("ord")).select("ord", "h"))
    return resolve(firsts, close_pairs(firsts, distance))

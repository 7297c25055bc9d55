"""64-bit hashes as column expressions."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def median(values: Column) -> Column:
    """Of an array: the middle value, or the mean of both."""
    ordered = F.array_sort(values)
    n = F.size(values)
    return (F.get(ordered, F.floor((n - 1) / 2).cast("int")) + F.get(ordered, F.floor(n / 2).cast("int"))) / 2


def above_median_bits(values: Column) -> Column:
    """A bigint with a bit, the first being the highest, for each of 64 numbers above their median.

    The median is part of the fold's first state, so it is found once a row.
    """
    start = F.struct(F.lit(0).cast("bigint").alias("bits"), median(values).alias("m"))
    step = lambda s, v: F.struct(F.shiftleft(s["bits"], 1).bitwiseOR(F.when(v > s["m"], 1).otherwise(0).cast("bigint")).alias("bits"), s["m"].alias("m"))
    return F.aggregate(values, start, step, lambda s: s["bits"])


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def masks(distance: int, rows: int) -> list[int]:
    """Masks, as signed numbers, of which two values that differ in at most ``distance`` bits share the bits of one.

    The 64 bits are cut into blocks, of which all but ``distance`` agree. There are as many blocks as it takes for
    unrelated values, of ``rows`` in all, to share the bits of a mask but rarely; at most four more than needed.
    """
    for count in range(distance + 1, distance + 6):
        cuts = [round(64 * i / count) for i in range(count + 1)]
        parts = [((1 << (high - low)) - 1) << low for low, high in itertools.pairwise(cuts)]
        out = [sum(c) for c in itertools.combinations(parts, count - distance)]
        if min(m.bit_count() for m in out) >= math.log2(max(rows, 2)):
            break
    return [m - (1 << 64) if m >> 63 else m for m in out]

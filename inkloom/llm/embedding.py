"""Operator 7: embedding near-duplicates by spherical-cap filters from a structured random product code."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, map_column, materialize, runs_of

#: Vectors of one group of filters that are compared in one task; two such chunks meet at a time.
CHUNK = 4096
#: Random pairs on which the bound of the filters is calibrated.
PAIRS = 10_000


class ProductCode:
    """Filter directions: every concatenation of one random unit vector per block, ``size`` of them a block, in axes
    turned by a random rotation. All from the seed.

    The bound for a filter is calibrated: on random pairs at a cosine of ``least_cosine``, the share ``recall`` and a
    margin have a filter in common. A random rotation makes any pair like a random one, so that share holds for all
    pairs at that cosine, and closer ones share more. The bound is never above that of ``per_vector`` filters a vector.
    """

    def __init__(self, dim: int, blocks: int, size: int, per_vector: float, seed: int, least_cosine: float, recall: float) -> None:
        rng = np.random.default_rng([seed, dim, blocks, size])
        blocks = min(blocks, dim)
        cuts = [round(dim * i / blocks) for i in range(blocks + 1)]
        turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.books = []
        for a, b in zip(cuts, cuts[1:]):
            book = rng.standard_normal((size, b - a))
            self.books.append(_grid(turn[:, a:b] @ (book / np.linalg.norm(book, axis=1, keepdims=True) / math.sqrt(blocks)).T))
        last, order = self.books[-1], [0]
        rest = set(range(1, size))
        while rest:  # neighbours come one after the other, so that a vector's filters fall in few groups
            order.append(max(rest, key=(last.T @ last[:, order[-1]]).__getitem__))
            rest.remove(order[-1])
        self.books[-1] = np.ascontiguousarray(last[:, order])
        self.size = size
        tail = min(0.5, per_vector / size**blocks)
        self.least = float(_grid(NormalDist().inv_cdf(1 - tail) / math.sqrt(dim)))
        x, y = _pairs_at(rng, PAIRS, dim, least_cosine)
        reach = np.sort([self._common(p, q) for p, q in zip(self._products(x), self._products(y))])
        # Of the pairs, a share that is so small that three standard errors more are still within 1 - recall.
        missed = max(0.0, 1 - recall - 3 * math.sqrt(recall * (1 - recall) / PAIRS))
        self.least = min(self.least, float(reach[int(missed * PAIRS)]))

    def group(self, n: int, most: float) -> int:
        """So many filters in a row make a group that about ``most`` of ``n`` unrelated vectors fall in, if not more
        than that share one filter."""
        x = np.random.default_rng(0).standard_normal((500, self.books[0].shape[0]))
        lists, g = self.decode(x / np.linalg.norm(x, axis=1, keepdims=True)), self.size
        while g > 1 and n * sum(len(np.unique(c // g)) for c in lists) / len(lists) * g / self.size ** len(self.books) > most:
            g = (g + 1) // 2
        return g

    def _products(self, unit: np.ndarray) -> Iterator[list[np.ndarray]]:
        """For each vector its products with each block's vectors: exact, as all factors are on a grid, so that a vector
        has the same filters in whatever batch it comes."""
        products = [_grid(unit) @ book for book in self.books]
        for i in range(len(unit)):
            yield [p[i] for p in products]

    def _common(self, p: list[np.ndarray], q: list[np.ndarray]) -> float:
        """The highest bound at which two vectors share a filter; -1 if that is below all that can be of use."""
        width = 0.05
        while True:
            # A filter in which both reach t has a mean of at least t; those of the mean's highest are looked at first.
            mean = [(a + b) / 2 for a, b in zip(p, q)]
            top = sum(m.max() for m in mean)
            ids = self._reach(mean, top - width)
            both = np.minimum(*(sum(x[ids // self.size ** (len(r) - 1 - k) % self.size] for k, x in enumerate(r)) for r in (p, q))).max()
            if both >= top - width or width > 4:
                return float(both)
            width *= 2

    def _reach(self, products: list[np.ndarray], least: float) -> np.ndarray:
        """Ids of all directions whose product is at least ``least``: block by block, part sums go on only if the best
        that the remaining blocks can add reaches it."""
        rest = [*itertools.accumulate((float(p.max()) for p in products[:0:-1]), initial=0.0)][::-1]
        ids, sums = np.zeros(1, np.int64), np.zeros(1)
        for p, more in zip(products, rest):
            near = np.flatnonzero(p >= least - sums.max() - more)
            total = sums[:, None] + p[near][None, :]
            x, y = np.nonzero(total >= least - more)
            ids, sums = ids[x] * self.size + near[y], total[x, y]
        return ids

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """For each unit vector the sorted ids of all directions whose product with it is at least ``least``.

        A vector that reaches no direction takes the nearest one.
        """
        return [np.sort(self._reach(p, min(self.least, sum(float(x.max()) for x in p)))) for p in self._products(unit)]


def _grid(x):
    """Rounded to multiples of 2**-24: sums of products of two such numbers, of vectors of length one, are exact."""
    return np.round(np.asarray(x) * 2.0**24) / 2.0**24


def _pairs_at(rng: np.random.Generator, n: int, dim: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Random pairs of unit vectors at a cosine; in one dimension, where there are none, equal ones."""
    x, y = rng.standard_normal((2, n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if dim == 1:
        return x, x
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    return x, cosine * x + math.sqrt(1 - cosine * cosine) * y


def code_shape(n: int, per_vector: float, bucket: float = 24.0) -> tuple[int, int]:
    """Blocks and directions a block, so that ``n`` unrelated vectors fill a filter with about ``bucket``."""
    filters = max(64.0, n * per_vector / bucket)
    blocks = max(2, math.ceil(math.log2(filters) / 10))
    return blocks, math.ceil(filters ** (1 / blocks))


def _links(unit: np.ndarray, lists: list[np.ndarray], decode: Callable[[np.ndarray], list[np.ndarray]], weight: np.ndarray, floor: int, left: int, least: float):
    """Among vectors with filters (``lists``) in one group: each row's copies linked here first, and links that span the
    components. Pairs that share a filter below ``floor`` are counted where they share it.

    ``left``: rows of the first chunk; only pairs across the two chunks count, or, if it is zero, all pairs.
    """
    n = len(unit)
    flat, row = np.concatenate(lists), np.repeat(np.arange(n), [len(c) for c in lists])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    cuts = [0, *(np.flatnonzero(flat[1:] != flat[:-1]) + 1).tolist(), len(flat)]
    near = np.zeros((n, n), bool)
    for a, b in itertools.pairwise(cuts):
        if b - a > 1:
            at = row[a:b]
            near[at[:, None], at] |= unit[at] @ unit[at].T >= least
    np.fill_diagonal(near, False)
    if left:
        near[:left, :left] = near[left:, left:] = False
    some = np.flatnonzero(near.any(axis=1))
    if not len(some):
        return np.zeros(n, np.int64), []
    lower = [c[c < floor] for c in decode(unit[some])]
    flat = np.concatenate(lower)
    first = near
    if len(flat):
        names, at_name = np.unique(flat, return_inverse=True)
        at = np.repeat(np.arange(len(some)), [len(c) for c in lower])
        first = near.copy()
        bounds = np.concatenate([[0], np.cumsum([len(c) for c in lower])])
        for lo in range(0, len(some), 512):
            hi = min(lo + 512, len(some))
            mine = at_name[bounds[lo] : bounds[hi]]
            few = np.unique(mine)
            spot = np.searchsorted(few, at_name)
            spot[spot == len(few)] = 0
            known = few[spot] == at_name if len(few) else np.zeros(len(at_name), bool)
            both = np.zeros((hi - lo, len(some)), np.float32)
            for c in range(0, len(few), 512):
                part = known & (spot >= c) & (spot < c + 512)
                member = np.zeros((len(some), 512), np.float32)
                member[at[part], spot[part] - c] = 1
                both += member[lo:hi] @ member.T
            first[some[lo:hi, None], some] &= both < 0.5
    degree = first.astype(np.float64) @ weight if n <= 256 else np.array([weight[r].sum() for r in first])
    labels, edges = np.arange(n), []
    for i in some.tolist():
        for j in np.flatnonzero(near[i] & (labels != labels[i])).tolist():
            if labels[j] != labels[i]:
                edges.append((i, j))
                labels[labels == labels[j]] = labels[i]
    return degree.astype(np.int64), edges


def embedding_neighbours(vectors: DataFrame, least: float = 0.9, per_vector: float = 24.0, seed: int = 42, recall: float = 0.99) -> DataFrame:
    """Per row of ``vectors(vec_id, embedding)``: vec_id, n_links, component_id, kept.

    Two vectors of one length link if they fall in a common filter and their cosine, in double precision, is at least
    ``least``; no other pair links. Of the pairs at just ``least`` the share ``recall`` is found, and more of closer ones,
    for any number of vectors: a vector falls in as many filters as that takes, at least about ``per_vector`` of them
    in the mean, and a slowly growing number as there are more vectors. Equal vectors are one vector with a count and
    always link. Vectors meet by groups of filters that lie side by side, so that one travels once for all its filters in
    a group. A group's vectors are dealt into chunks, and each pair of chunks is compared in one
    task, which gives back a count per vector and a spanning set of links, never all pairs.

    Null or zero vectors, and those with null or non-finite components, link with nothing: no links, their own
    component, kept. Rows that repeat a vec_id count as vectors of their own. A row with a null vec_id is compared and
    counted like any other; its component is named after the smallest vec_id in it, null if there is none. Other columns
    are ignored, whatever their names. No rows: no rows.
    """
    kind = np.float32 if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else np.float64

    def clean(values: list) -> list[list]:
        raw = []
        for v in values:
            x = None if not v or None in v else np.array(v, kind)
            raw.append((x + kind(0)).tobytes() if x is not None and np.isfinite(x).all() and x.any() else None)
        return [raw]

    rows = materialize(map_column(vectors, ["vec_id"], "embedding", lambda: clean, "raw binary"))
    distinct = rows.where("raw is not null").groupBy("raw").agg(F.min("vec_id").alias("name"), F.count(F.lit(1)).alias("copies"))
    distinct = materialize(distinct.select(F.monotonically_increasing_id().alias("uid"), "raw", "name", "copies"))
    made, steps, width = {}, {}, np.dtype(kind).itemsize
    for r in distinct.groupBy((F.octet_length("raw") / width).cast("int").alias("dim")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").collect():
        made[r["dim"]] = ProductCode(r["dim"], *code_shape(r["n"], per_vector), per_vector, seed, least, recall)
        steps[r["dim"]] = made[r["dim"]].group(r["n"], CHUNK / 2)
    shared = vectors.sparkSession.sparkContext.broadcast((made, steps))

    def unit_of(raws) -> np.ndarray:
        x = np.stack([np.frombuffer(r, kind) for r in raws]).astype(np.float64)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        return x / np.sqrt((x * x).sum(axis=1, keepdims=True))

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby(pdf["raw"].map(len) // width):
                codes, steps = shared.value
                if dim not in codes:  # alone in its length
                    continue
                for lo in range(0, len(part), 512):
                    few = part.iloc[lo : lo + 512]
                    yield pd.DataFrame({"dim": dim, "step": steps[dim], "uid": few["uid"].to_numpy(), "filters": codes[dim].decode(unit_of(few["raw"]))})

    filed = materialize(distinct.select("raw", "uid").mapInPandas(spread, "dim int, step long, uid long, filters array<long>"))
    filed = filed.select("dim", "step", "uid", F.explode("filters").alias("filter"))
    shared_filters = filed.groupBy("dim", "filter").agg(F.count(F.lit(1)).alias("size")).where("size > 1").drop("size")
    grouped = filed.join(shared_filters, ["dim", "filter"]).groupBy("dim", F.floor(F.col("filter") / F.col("step")).alias("group"), "uid").agg(F.collect_list("filter").alias("filters"))
    grouped = materialize(grouped)
    sizes = grouped.groupBy("dim", "group").agg(F.count(F.lit(1)).alias("size")).where("size > 1").withColumn("chunks", F.ceil(F.col("size") / CHUNK).cast("int")).drop("size")
    chunked = grouped.join(sizes, ["dim", "group"]).withColumn("chunk", F.pmod(F.xxhash64("uid"), F.col("chunks")).cast("int"))
    units = chunked.withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
    units = units.withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other")).drop("other", "chunks")
    keys = ["dim", "group", "i", "j"]
    units = units.join(distinct.drop("name"), "uid").repartition(*keys).sortWithinPartitions(*keys, "chunk")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        few = (pdf.iloc[lo : lo + CHUNK] for pdf in batches for lo in range(0, len(pdf), CHUNK))
        for pdf, bounds in runs_of(few, keys):
            out = []
            raw, uids, copies, chunk, lists = (pdf[c].to_numpy() for c in ("raw", "uid", "copies", "chunk", "filters"))
            dims, group, i, j = (pdf[c].to_numpy() for c in keys)
            for a, b in zip(bounds, [*bounds[1:], len(pdf)]):
                if b - a < 2:
                    continue
                code, step = (x[dims[a]] for x in shared.value)
                left = int((chunk[a:b] == i[a]).sum()) if i[a] != j[a] else 0
                degree, edges = _links(unit_of(raw[a:b]), list(lists[a:b]), code.decode, copies[a:b].astype(np.float64), int(group[a]) * step, left, least)
                out += [(int(r), None, int(d)) for r, d in zip(uids[a:b], degree) if d]
                out += [(int(uids[a + x]), int(uids[a + y]), 0) for x, y in edges]
            if out:
                yield pd.DataFrame(out, columns=["a", "b", "n"]).astype({"b": "Int64"})

    found = materialize(units.mapInPandas(compare, "a long, b long, n long"))
    degrees = found.groupBy(F.col("a").alias("uid")).agg(F.sum("n").alias("degree"))
    linked = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "uid")
    reps = distinct.join(degrees, "uid", "left").join(linked, "uid", "left").select("raw", "name", (F.coalesce("degree", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "uid").alias("component"))
    names = reps.groupBy("component").agg(F.min("name").alias("component_id"))
    reps = reps.join(names, "component").select("raw", "links", "component_id", F.lit(True).alias("live"))
    out = rows.join(reps, "raw", "left").select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("live"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

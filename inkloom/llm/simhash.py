"""Operator 5: SimHash near-duplicate groups by pigeonhole blocks; and the near-copy stage, by keys of SimHash bits and similarity."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, free_name, lower_words, map_column, materialize, of_some, runs_of, text_key

#: Fingerprints of a block bucket up to this many are compared by a self-join; larger buckets in chunks.
SMALL_BUCKET = 4
CHUNK = 4096
#: Shingles of a chunk of the near-copy stage, about, so that long texts make chunks of fewer rows (8 bytes each).
CHUNK_SHINGLES = 1 << 23
#: Keys a document, and SimHash bits a key, of the near-copy stage.
BANDS, KEY_BITS = 160, 24
#: Words of the fingerprints that candidates are compared by, and bits in which they differ at most. At a similarity of 0.8
#: some 39 of 256 bits differ (standard deviation 6), of unrelated texts 128.
SKETCH, FAR = 4, 70


def _remixed(hashes: np.ndarray, no: int) -> np.ndarray:
    """Hashes for the fingerprint ``no``: the hashes themselves, or a bijective mix of them."""
    if not no:
        return hashes
    x = hashes + np.uint64(no * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _hashes(text: str | None, width: int, seed: int) -> np.ndarray:
    """XXH64 of each shingle of a text, as often as it occurs; a text of fewer words is one shingle, of none has none."""
    words = lower_words(text)
    if not words:
        return np.zeros(0, "<u8")
    joined, ends = b" ".join(words), list(itertools.accumulate(len(w) + 1 for w in words))
    starts, digest = [0, *ends], xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = [digest(joined, seed)]
    else:
        hashes = [digest(joined[a : b - 1], seed) for a, b in zip(starts, ends[width - 1 :])]
    return np.array(hashes, dtype="<u8")


def fingerprint(text: str | None, width: int = 4, seed: int = 42, prints: int = 1, repeats: bool = True) -> list[int]:
    """64-bit SimHashes, as signed integers, of the ``width``-word shingles of a text; no words: zero.

    Shingles count as often as they occur, or once without ``repeats``; a bit is set if over half of the shingles'
    XXH64 have it set. Further fingerprints take the same hashes, mixed anew.
    """
    array, out = _hashes(text, width, seed), []
    if not len(array):
        return [0] * prints
    if not repeats:
        array = np.unique(array)
    for no in range(prints):
        total = np.zeros(64, np.int64)
        for at in range(0, len(array), 65536):
            bits = np.unpackbits(_remixed(array[at : at + 65536], no).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += bits.sum(axis=0, dtype=np.int64)
        out.append(_signed(sum(1 << i for i in np.flatnonzero(2 * total > len(array)).tolist())))
    return out


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42, prints: int = 1, repeats: bool = True) -> DataFrame:
    """``(doc_id, fps)`` for each row of ``docs(doc_id, text)``."""
    return map_column(docs, ["doc_id"], "text", lambda: lambda texts: [[fingerprint(t, width, seed, prints, repeats) for t in texts]], "fps array<long>")


def block_masks(distance: int, distinct: int) -> list[int]:
    """Masks of which any two fingerprints within ``distance`` share the bits of at least one.

    64 bits are split into k blocks; of these at least k - distance agree. More blocks make longer keys, so that a
    bucket of unrelated fingerprints stays about constant while ``distinct`` grows; pairs within ``distance`` all stay.
    """
    best: list[int] = []
    for k in range(distance + 1, distance + 6):
        cuts = [round(64 * i / k) for i in range(k + 1)]
        blocks = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(cuts)]
        best = [sum(c) for c in itertools.combinations(blocks, k - distance)]
        if min(m.bit_count() for m in best) >= math.log2(max(distinct, 2)) + 1:
            break
    return best


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _merge(fps: np.ndarray, ids: np.ndarray, labels: np.ndarray, left: range, right: slice, bits: int) -> list[tuple[int, int]]:
    """Link rows of ``left`` to those of ``right``; give back only the links that joined two labels."""
    out = []
    for i in left:
        at = max(i + 1, right.start)
        other = np.flatnonzero(labels[at : right.stop] != labels[i]) + at
        near = other[np.bitwise_count(fps[other] ^ fps[i]).sum(axis=1, dtype=np.int64) <= bits]
        for j in near.tolist():
            if labels[j] != labels[i]:
                out.append((int(ids[i]), int(ids[j])))
                labels[labels == labels[j]] = labels[i]
    return out


def chunk_links(left: np.ndarray, left_ids: np.ndarray, right: np.ndarray, right_ids: np.ndarray, same: bool, bits: int) -> list[tuple[int, int]]:
    """Links that span the components of one chunk (``same``), or that connect the components of two chunks.

    ``left`` and ``right`` hold a row of fingerprints for each document.
    """
    n = len(left)
    if same:
        return _merge(left, left_ids, np.arange(n), range(n), slice(0, n), bits)
    fps, ids = np.concatenate([left, right]), np.concatenate([left_ids, right_ids])
    labels = np.arange(len(fps))
    _merge(fps, ids, labels, range(n), slice(0, n), bits)
    _merge(fps, ids, labels, range(n, len(fps)), slice(n, len(fps)), bits)
    return _merge(fps, ids, labels, range(n), slice(n, len(fps)), bits)


def links(reps: DataFrame, prints: int = 1, distance: int = 4, bits: int = 4) -> DataFrame:
    """Links ``(a, b)`` between rows ``(uid, rep, fps)``, each fps once; they have all candidates' exact components.

    Candidates share a block key of one fingerprint, as do all pairs of which one fingerprint differs in at most
    ``distance`` bits; they link if all fingerprints together differ in at most ``bits``. Keys travel without the
    fingerprints, which join those that are not alone in their bucket. Buckets of unrelated fingerprints are small
    and are joined with themselves. A bucket with over ``SMALL_BUCKET`` rows is dealt into chunks, and each pair of
    chunks is compared by itself, which gives back no more links than there are components to be joined:
    memory and rows stay bounded for any bucket.
    """
    masks = block_masks(distance, reps.count() * prints)
    # Dealt anew, as each row becomes many and few partitions would be left after coalescing.
    keyed = reps.repartition(int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))).select("uid", F.posexplode("fps").alias("no", "fp"))
    keyed = keyed.select("uid", "no", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("block", "masked"))
    keyed = keyed.select("uid", F.xxhash64("no", "block", "masked").alias("key"))  # one long; a chance collision only adds candidates
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sized = materialize(keyed.join(sizes, "key").join(reps, "uid"))
    small = sized.where(F.col("size") <= SMALL_BUCKET)
    x, y = small.alias("x"), small.alias("y")
    differing = sum((F.bit_count(F.col("x.fps")[i].bitwiseXOR(F.col("y.fps")[i])) for i in range(prints)), F.lit(0))
    plain = x.join(
        y,
        (F.col("x.key") == F.col("y.key")) & (F.col("x.rep") < F.col("y.rep")) & (differing <= bits),
    ).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
    chunked = sized.where(F.col("size") > SMALL_BUCKET).withColumn("chunks", F.ceil(F.col("size") / CHUNK).cast("int"))
    chunked = chunked.withColumn("chunk", F.pmod(F.xxhash64("uid"), F.col("chunks")).cast("int"))
    paired = chunked.withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)"))).select(
        "key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "rep", "fps"
    )
    units = ["key", "i", "j"]
    paired = paired.repartition(*units).sortWithinPartitions(*units, "chunk")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, bounds in runs_of(batches, units):
            fps = np.array(pdf["fps"].tolist(), np.int64).reshape(-1, prints).view(np.uint64)
            ids, i, j, chunk = (pdf[c].to_numpy() for c in ("rep", "i", "j", "chunk"))
            out = []
            for a, b in zip(bounds, [*bounds[1:], len(pdf)]):
                if b - a < 2:
                    continue
                cut = a + int((chunk[a:b] == i[a]).sum())
                right = slice(a, b) if i[a] == j[a] else slice(cut, b)
                out += chunk_links(fps[a:cut], ids[a:cut], fps[right], ids[right], bool(i[a] == j[a]), bits)
            if out:
                yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return plain.unionByName(paired.mapInPandas(compare, "a long, b long"))


def simhash_groups(docs: DataFrame, width: int = 4, distance: int = 4, prints: int = 1, bits: int | None = None, repeats: bool = True) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for each row of ``docs(doc_id, text)``; other columns are ignored.

    Documents link if their ``prints`` fingerprints together differ in at most ``bits`` (by default ``distance``) and
    share a block, as all do of which one fingerprint differs in at most ``distance``; with one fingerprint that is
    each pair within ``distance``. Equal fingerprints are collapsed before candidates are sought, so a large group of
    copies is one fingerprint. Null, empty and blank texts have fingerprint zero and link like any other. Repeated
    rows stay. A row with a null doc_id links like any other; its component is named after the smallest doc_id in it, null
    if there is none. No rows: no rows.
    """
    found = materialize(fingerprints(docs, width, prints=prints, repeats=repeats))
    reps = materialize(found.groupBy("fps").agg(F.min("doc_id").alias("name")).select(F.monotonically_increasing_id().alias("uid"), "name", "fps"))
    groups = components(links(reps.select("uid", F.col("uid").alias("rep"), "fps"), prints, distance, distance if bits is None else bits)).withColumnRenamed("node", "uid")
    grouped = reps.join(groups, "uid", "left").select("fps", "name", F.coalesce("component", "uid").alias("component"))
    names = grouped.groupBy("component").agg(F.min("name").alias("component_id"))
    by_fps = grouped.join(names, "component").select("fps", "component_id")
    return found.join(by_fps, "fps").select("doc_id", F.lower(F.lpad(F.hex(F.col("fps")[0]), 16, "0")).alias("fingerprint"), "component_id")


def sim_hashes(shingles: np.ndarray, prints: int = BANDS * KEY_BITS // 64) -> np.ndarray:
    """What ``fingerprint`` gives for a set of shingles' hashes, by counts of many bits at once."""
    seeds, total = np.arange(prints, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.zeros((prints, 8, 8), np.int64)
    for at in range(0, len(shingles), 2040):
        part = shingles[at : at + 2040]
        x = part[:, None] + seeds
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x ^= x >> np.uint64(shift)
            x *= np.uint64(factor)
        x ^= x >> np.uint64(31)
        x[:, 0] = part
        x = np.concatenate([x, np.zeros((-len(x) % 15, prints), np.uint64)]).reshape(-1, 5, 3, prints)
        # Sums of 3 rows fit two bits, of 15 four, of 255 eight.
        for i in range(2):
            two = (x >> np.uint64(i)) & np.uint64(0x5555555555555555)
            two = two[:, :, 0] + two[:, :, 1] + two[:, :, 2]
            for j in (0, 2):
                four = ((two >> np.uint64(j)) & np.uint64(0x3333333333333333)).sum(axis=1)
                for k in (0, 4):
                    eight = (four >> np.uint64(k)) & np.uint64(0x0F0F0F0F0F0F0F0F)
                    for lo in range(0, len(eight), 17):
                        total[:, :, i + j + k] += eight[lo : lo + 17].sum(axis=0).view(np.uint8).reshape(prints, 8)
    return np.packbits(2 * total.reshape(prints, 64) > len(shingles), axis=1, bitorder="little").view("<u8").ravel()


def band_key(fps: Column, band: Column) -> Column:
    """``KEY_BITS`` bits of the fingerprints, those of ``band``, with the number of the band above them."""
    at = band * KEY_BITS
    word, spot = F.shiftright(at, 6), at.bitwiseAND(63)
    low, high = F.call_function("shiftrightunsigned", fps[word], spot), F.call_function("shiftleft", fps[word + 1], 64 - spot)
    bits = F.when(spot <= 64 - KEY_BITS, low).otherwise(low.bitwiseOR(high))
    return bits.bitwiseAND(F.lit((1 << KEY_BITS) - 1).cast("long")).bitwiseOR(F.shiftleft(band.cast("long"), KEY_BITS))


def bands() -> Column:
    return F.sequence(F.lit(0), F.lit(BANDS - 1))


def band_keys(fps: Column) -> Column:
    """The ``BANDS`` keys of the fingerprints."""
    return F.transform(bands(), lambda band: band_key(fps, band))


def _shingled(width: int, seed: int, keys: bool):
    def of(texts: list) -> tuple[list, ...]:
        sets = [np.unique(_hashes(t, width, seed)) for t in texts]
        return [sim_hashes(x).view(np.int64) for x in sets] if keys else [x.view(np.int64) for x in sets], [len(x) for x in sets], [xxhash.xxh128_digest(x.tobytes()) for x in sets]

    return of


def set_links(sets: list[np.ndarray], ids: np.ndarray, groups: np.ndarray, cut: int, least: float) -> list[tuple[int, int]]:
    """Links, of pairs of sorted sets with a similarity of ``least`` or more, that span the components. ``groups``: those that are
    known to be linked.

    With ``cut`` below the number of sets, only pairs across it count: links that connect the components of both parts.
    """
    n, lengths, labels, out = len(sets), np.array([len(x) for x in sets]), groups.copy(), []

    def merge(left: range, right: range) -> None:
        for i in left:
            at = max(i + 1, right.start)
            other = np.flatnonzero(labels[at : right.stop] != labels[i]) + at
            other = other[np.minimum(lengths[other], lengths[i]) >= least * np.maximum(lengths[other], lengths[i])]
            for lo in range(0, len(other), 256):
                few = other[lo : lo + 256]
                few = few[labels[few] != labels[i]]
                if not len(few):
                    continue
                all_of = np.concatenate([sets[j] for j in few])
                spot = np.minimum(np.searchsorted(sets[i], all_of), lengths[i] - 1)
                common = np.add.reduceat((sets[i][spot] == all_of).astype(np.int64), np.cumsum(lengths[few]) - lengths[few])
                for j in few[common / (lengths[few] + lengths[i] - common) >= least].tolist():
                    if labels[j] != labels[i]:
                        out.append((int(ids[i]), int(ids[j])))
                        labels[labels == labels[j]] = labels[i]

    merge(range(cut), range(cut))
    if cut < n:
        merge(range(cut, n), range(cut, n))
        out.clear()
        merge(range(cut), range(cut, n))
    return out


def _near(pairs: DataFrame, reps: DataFrame, least: float) -> DataFrame:
    """Of ``pairs(a, b, few)``, once each, with ``few`` if any has it, those whose sizes allow a similarity of ``least`` and whose first fingerprints differ in
    at most ``FAR`` bits."""
    pairs = pairs.groupBy("a", "b").agg(F.max("few").alias("few"))
    for c in ("a", "b"):
        pairs = pairs.join(reps.select(F.col("rep").alias(c), F.col("n").alias(f"{c}_n"), *[F.col("fps")[i].alias(f"{c}{i}") for i in range(SKETCH)]), c)
    differing = sum((F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(SKETCH)), F.lit(0))
    return pairs.where((F.least("a_n", "b_n") >= least * F.greatest("a_n", "b_n")) & (differing <= FAR)).select("a", "b", "few")


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Of ``pairs(a, b)`` those whose sets have a similarity of at least ``least``."""
    for c in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("rep").alias(c), F.col("shingles").alias(f"{c}_set")), c)
    common, both = F.size(F.array_intersect("a_set", "b_set")), F.size("a_set") + F.size("b_set")
    return pairs.where(common / (both - common) >= least).select("a", "b")


def similar_links(reps: DataFrame, sets_of: Callable[[DataFrame], DataFrame], least: float) -> DataFrame:
    """Links ``(a, b)`` between rows ``(rep, n, fps)``, each set of n shingles once; they have the
    components of the candidates, pairs that share a key, whose similarity is at least ``least``.

    ``sets_of`` gives ``(rep, shingles)`` of the rows that are near another one, or in a large bucket.

    Each row is compared to the smallest one of its buckets, and rows of small buckets to each other, if their fingerprints
    are near: first each row to the smallest row near it, then those of small buckets that this leaves in different components. All rows of
    large buckets that are in different components still are compared in chunks, as in ``links``, of about ``CHUNK`` rows or
    ``CHUNK_SHINGLES`` shingles, whichever is less.
    """
    # One expression for all bands: with one for each, the driver held hundreds of MB to plan and compile them.
    keyed = reps.select("rep", "n", "fps", F.explode(bands()).alias("band")).select("rep", "n", band_key(F.col("fps"), F.col("band")).alias("key"))
    keyed = keyed.repartition("key")  # shuffled once for both uses, as both read all its columns
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("head"), F.sum("n").alias("shingled")).where("size > 1")
    sized = materialize(keyed.join(sizes, "key"))
    small, large = sized.where(F.col("size") <= SMALL_BUCKET), sized.where(F.col("size") > SMALL_BUCKET)
    star = sized.where("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b"), (F.col("size") <= SMALL_BUCKET).alias("few"))
    x, y = small.where("rep <> head").alias("x"), small.alias("y")
    others = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.rep") < F.col("y.rep"))).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), F.lit(True).alias("few"))
    near = materialize(_near(star.unionByName(others), reps, least))
    sets = sets_of(near.select(F.col("a").alias("rep")).unionByName(near.select(F.col("b").alias("rep"))).unionByName(large.select("rep")).distinct())
    found = materialize(_verified(near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), sets, least))

    def grouped(rows: DataFrame, labels: DataFrame, rep: str = "rep", group: str = "group") -> DataFrame:
        return rows.join(labels.select(F.col("node").alias(rep), "component"), rep, "left").withColumn(group, F.coalesce("component", rep)).drop("component")

    labels = components(found)
    apart = grouped(grouped(near.where("few"), labels, "a", "a_group"), labels, "b", "b_group").where("a_group <> b_group").select("a", "b")
    more = materialize(_verified(apart, sets, least))
    if not more.isEmpty():
        found = found.unionByName(more)
        labels = components(found)
    large = materialize(grouped(large, labels))
    mixed = large.groupBy("key").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo < hi")
    chunked = large.join(mixed.select("key"), "key").withColumn("chunks", F.ceil(F.greatest(F.col("size") / CHUNK, F.col("shingled") / CHUNK_SHINGLES)).cast("int"))
    chunked = chunked.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    paired = chunked.withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)"))).select(
        "key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "rep", "group"
    )
    units = ["key", "i", "j"]
    paired = paired.join(sets, "rep").repartition(*units).sortWithinPartitions(*units, "chunk")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        few = (pdf.iloc[lo : lo + CHUNK] for pdf in batches for lo in range(0, len(pdf), CHUNK))
        for pdf, bounds in runs_of(few, units):
            ids, i, j, chunk, sets, groups = (pdf[c].to_numpy() for c in ("rep", "i", "j", "chunk", "shingles", "group"))
            out = []
            for a, b in zip(bounds, [*bounds[1:], len(pdf)]):
                if b - a < 2:
                    continue
                cut = b - a if i[a] == j[a] else int((chunk[a:b] == i[a]).sum())
                out += set_links([np.sort(x.view(np.uint64)) for x in sets[a:b]], ids[a:b], groups[a:b], cut, least)
            if out:
                yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return found.unionByName(paired.mapInPandas(compare, "a long, b long"))


def dedup(docs: DataFrame, width: int = 5, least: float = 0.8, seed: int = 42) -> DataFrame:
    """One row of ``docs`` of each group of similar texts: that of the smallest doc_id, a null one last, then of the
    smallest hash of its text; of rows that agree in both, any one. Other columns, of any names, stay as they are.

    Documents link if their sets of ``width``-word shingles have a similarity (Jaccard) of at least ``least``, which
    is computed for each pair of candidates. Candidates share one of ``BANDS`` keys of ``KEY_BITS`` SimHash bits, whose
    number and length don't depend on the input. A bit of sets of the same size and a similarity s differs with a chance of about
    d = acos(2 s / (1 + s)) / pi, so such pairs share a key with one of 1 - (1 - (1 - d) ** KEY_BITS) ** BANDS: 0.957 at
    0.8, 0.99 at 0.83, more above. Texts
    without a word, null ones too, are never duplicates of anything; rows that share a doc_id but not a similar text all
    stay. No rows: no rows.
    """
    key = free_name("_key", docs.columns)
    marked = docs.withColumn(key, text_key(F.col("text")))
    wordy = marked.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select("doc_id", F.col(key).alias("key"), "text")
    found = materialize(map_column(wordy, ["doc_id", "key"], "text", lambda: _shingled(width, seed, True), "fps array<long>, n int, digest binary"))
    one = found.groupBy("digest").agg(F.min(F.struct("key", "n", "fps")).alias("m"))
    first = materialize(one.select(F.monotonically_increasing_id().alias("rep"), "digest", "m.key", "m.n", "m.fps"))

    def sets_of(members: DataFrame) -> DataFrame:
        named = first.select("rep", "key").join(members, "rep")
        made = map_column(of_some(wordy, named), ["rep"], "text", lambda: _shingled(width, seed, False), "shingles array<long>, n int, digest binary")
        return materialize(made.select("rep", "shingles"))

    groups = components(similar_links(first.select("rep", "n", "fps"), sets_of, least)).withColumnRenamed("node", "rep")
    named = first.join(groups, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    rows = materialize(found.select("doc_id", "key", "digest").join(named, "digest").groupBy("component", "doc_id", "key").agg(F.count(F.lit(1)).alias("n")))
    # Joined by text and doc_id, not by component, so that a large group is dealt over all tasks.
    best = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("best"))
    best = materialize(best.select(F.col("best.doc_id").alias("_of"), F.col("best.key").alias("_by")))
    wins = rows["doc_id"].eqNullSafe(best["_of"]) & (rows["key"] == best["_by"])

    def among(those: DataFrame) -> tuple[DataFrame, Column]:
        those = those.select(F.col("doc_id").alias("_its"), F.col("key").alias("_at"))
        return those, marked["doc_id"].eqNullSafe(those["_its"]) & (marked[key] == those["_at"])

    kept = marked.join(*among(rows.join(best, wins, "left_anti")), "left_anti")
    again = materialize(rows.where("n > 1").join(best, wins, "left_semi"))
    if not again.isEmpty():  # rows that repeat a winner in doc_id and text
        kept = kept.join(*among(again), "left_anti").unionByName(kept.join(*among(again), "left_semi").dropDuplicates(["doc_id", key]))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])

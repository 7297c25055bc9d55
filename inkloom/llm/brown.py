"""Operator 2: language-model scores by Brown class-based n-grams."""

from __future__ import annotations

import itertools
import logging
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FEW, commonest, lower_words, materialize

log = logging.getLogger(__name__)

#: The commonest words, whose classes start by exchange on the driver (at most the square of them pairs are sent there).
#: Every other word is then inserted into one of these classes on the executors.
CLUSTERED = 2000
CLASSES, SWEEPS = 64, 8
#: Words whose classes and counts every executor holds (bounded: about 100 bytes each); other words' are joined.
HEAD = 400_000
#: Endings (last three bytes) that tell the class of a word never seen beside a clustered one, at most.
ENDINGS = 20_000
#: Weight of the class frequencies in each class transition.
MIX = 0.02
FOLDS, HELD = 7, 2
#: Words of the texts that are packed into one row; a longer text is a row of its own.
PACKED = 1 << 18
#: Bits of a word's hash that its neighbours' counts are summed by, beside 7 bits for the neighbour's class.
WORD_BITS = 57

END, OTHER = 0, 1


def squeezed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def opened(value: pa.BinaryScalar) -> bytes:
    raw = value.as_buffer()
    return pa.decompress(raw.slice(8), int.from_bytes(raw.slice(0, 8).to_pybytes(), "little"), codec="zstd", asbytes=True)


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as numbers: rows ``(doc_ids, held, lens, words, seq)``. ``words`` are the distinct words, one a line, and
    ``seq`` holds for each word of the texts, in order, its line, in two bytes where they suffice; both are compressed.
    Later passes look up each distinct word only once."""
    names: dict[bytes, int] = defaultdict(itertools.count().__next__)
    ids, held, parts = [], [], []
    size = 0

    def row() -> pa.RecordBatch:
        kind = np.uint16 if len(names) <= 1 << 16 else np.uint32
        seq = squeezed(np.concatenate(parts).astype(kind).tobytes())
        made = [pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())), pa.array([[len(p) for p in parts]], pa.list_(pa.int32())), pa.array([squeezed(b"\n".join(names))], pa.binary()), pa.array([seq], pa.binary())]
        return pa.RecordBatch.from_arrays(made, names=["doc_ids", "held", "lens", "words", "seq"])

    for batch in (b.slice(i, FEW) for b in batches for i in range(0, b.num_rows, FEW)):
        for doc, out, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            words = lower_words(text)
            if ids and (size + len(words) > PACKED or len(names) + len(words) > 1 << 16 or len(ids) >= PACKED):
                yield row()
                names, ids, held, parts, size = defaultdict(itertools.count().__next__), [], [], [], 0
            ids.append(doc)
            held.append(out)
            parts.append(np.fromiter(map(names.__getitem__, words), np.uint32, len(words)))
            size += len(words)
    if ids:
        yield row()


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of each packed row: the batch, its place there, the words, and per text whether it is held out and its length, and ``seq``."""
    for b in batches:
        words, held, lens, seq = (b.column(c) for c in ("words", "held", "lens", "seq"))
        for i in range(b.num_rows):
            n = lens[i].values.to_numpy()
            raw, lines = opened(seq[i]), opened(words[i])
            kind = np.uint16 if len(raw) == 2 * int(n.sum()) else np.uint32
            yield b, i, lines.split(b"\n") if lines else [], held[i].values.to_numpy(zero_copy_only=False).astype(bool), n, np.frombuffer(raw, kind)


def with_ends(seq: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The texts one after the other, with ``END`` after each."""
    return np.insert(seq, np.cumsum(lens), END)


def word_counts(packed: DataFrame) -> tuple[DataFrame, int]:
    """``(word, n)`` of all words of the texts that aren't held out, and the number of these texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, words, held, lens, seq in unpacked(batches):
            n = np.bincount(seq[np.repeat(~held, lens)], minlength=len(words))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).filter(pa.array(n > 0)), pa.array(n[n > 0], pa.int64())], names=["word", "n"])

    counts = packed.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    texts = packed.agg(F.sum(F.size(F.filter("held", lambda h: ~h))).alias("n")).collect()[0]["n"]
    return materialize(counts), int(texts or 0)


def transitions(packed: DataFrame, units: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """How often each unit follows each other in the texts that aren't held out: ``u * size + v`` and its count. Units are
    ``END``, ``OTHER`` and the given words; counts are summed on the executors."""
    size = len(units) + 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for _, _, words, held, lens, seq in unpacked(batches):
            of = np.array([units.get(w, OTHER) for w in words], np.int64)
            full = with_ends(of[seq[np.repeat(~held, lens)]] if len(of) else np.zeros(0, np.int64), lens[~held])
            if len(full):
                names, n = np.unique(np.concatenate([[END], full[:-1]]) * size + full, return_counts=True)
                total[names] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["pair", "n"])

    got = packed.mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).orderBy("pair").toArrow()
    return got.column("pair").to_numpy().astype(np.int64), got.column("n").to_numpy()


def _h(x):
    return x * np.log(np.maximum(x, 1))


def likelihood(joint: np.ndarray) -> float:
    """The log-likelihood of class transitions, but for what doesn't depend on the classes."""
    return float(_h(joint).sum() - _h(joint.sum(axis=0)).sum() - _h(joint.sum(axis=1)).sum())


def exchange(pairs: np.ndarray, n: np.ndarray, size: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> tuple[np.ndarray, list[float]]:
    """A class for each unit by the exchange algorithm, and the likelihood after each sweep, which never falls.

    Units are taken one after the other, the commonest first; each goes to the class that raises the likelihood most,
    all counts being brought up to date after each move; of equals the first, and a unit only moves for a rise. Sweeps
    end when no unit has moved. ``END`` and ``OTHER`` keep classes 0 and 1 for themselves; the others start in turn in
    the rest.
    """
    u, v = pairs // size, pairs % size
    classes = max(3, min(classes, size))
    own = np.concatenate([[0, 1], 2 + np.arange(size - 2) % (classes - 2)])
    joint = np.bincount(own[u] * classes + own[v], n, classes * classes).reshape(classes, classes)
    after = np.searchsorted(u, np.arange(size + 1))  # pairs are sorted by u, then v
    order = np.argsort(v, kind="stable")
    back_u, back_n, before = u[order], n[order], np.searchsorted(v[order], np.arange(size + 1))
    history = [likelihood(joint)]
    diagonal = np.arange(classes)
    for _ in range(sweeps):
        moved = 0
        for w in range(2, size):
            a, b, c, d = after[w], after[w + 1], before[w], before[w + 1]
            if a == b and c == d:
                continue
            out = np.bincount(own[v[a:b]], n[a:b], classes)
            inn = np.bincount(own[back_u[c:d]], back_n[c:d], classes)
            at = a + np.searchsorted(v[a:b], w)
            same = float(n[at]) if at < b and v[at] == w else 0.0
            was = own[w]
            out[was] -= same
            inn[was] -= same
            rest = joint.copy()
            rest[was] -= out
            rest[:, was] -= inn
            rest[was, was] -= same
            h = _h(rest)
            rows, cols = _h(rest + out) - h, _h(rest + inn[:, None]) - h
            both = _h(rest[diagonal, diagonal] + out + inn + same) - h[diagonal, diagonal]
            gain = rows.sum(axis=1) - rows[diagonal, diagonal] + cols.sum(axis=0) - cols[diagonal, diagonal] + both
            left, right = rest.sum(axis=1) + inn, rest.sum(axis=0) + out
            gain -= _h(left + out.sum() + same) - _h(left) + _h(right + inn.sum() + same) - _h(right)
            gain[:2] = -np.inf
            best = int(np.argmax(gain))
            if best != was and gain[best] > gain[was] + 1e-6:
                moved += 1
                own[w] = best
            else:
                best = was
            rest[best] += out
            rest[:, best] += inn
            rest[best, best] += same
            joint = rest
        history.append(likelihood(joint))
        log.info("exchange: %d of %d units moved, log-likelihood %.6g", moved, size, history[-1])
        if not moved:
            break
    return own, history


def insert(packed: DataFrame, head: dict[bytes, int], joint: np.ndarray) -> DataFrame:
    """``(wid, class)`` of the words that aren't in ``head`` (word: class) and stand beside one that is, or an end.

    A word goes to the class, of those of ``head``, that makes its neighbours there likeliest, by ``joint``, given how
    often they come before and after it in all texts that aren't held out; of equals the first. These counts are summed on
    the executors, by a hash of the word (``wid``) and the neighbour's class.
    """
    k = len(joint)
    if not head:
        return packed.sparkSession.createDataFrame([], "wid long, class int")
    follow = np.log((joint + 0.1) / (joint.sum(axis=1, keepdims=True) + 0.1 * k))
    precede = np.log((joint + 0.1) / (joint.sum(axis=0, keepdims=True) + 0.1 * k))
    weights = np.vstack([follow, precede.T])  # neighbours before, then after, by classes of the word
    weights[:, [c for c in range(k) if c not in set(head.values())]] = -np.inf

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums, rows = [], [], 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            names, at = np.unique(np.concatenate(keys), return_inverse=True)
            return names, np.bincount(at, np.concatenate(sums)).astype(np.int64)

        def made(names: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            wid = (names >> np.uint64(7)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(wid), pa.array((names & np.uint64(127)).astype(np.int32)), pa.array(n)], names=["wid", "code", "n"])

        for _, _, words, held, lens, seq in unpacked(batches):
            of = np.array([head.get(w, -1) for w in words] + [END], np.int64)
            wid = np.array([xxhash.xxh64_intdigest(w, 42) if c < 0 else 0 for w, c in zip(words, of)] + [0], np.uint64) << np.uint64(7)
            end = len(words)
            full = np.insert(seq[np.repeat(~held, lens)].astype(np.int64), np.cumsum(lens[~held]), end)
            if not len(full):
                continue
            full = np.concatenate([[end], full])
            left, right = full[:-1], full[1:]
            got = []
            for me, other, base in ((right, left, 0), (left, right, 64)):
                use = (of[me] < 0) & (of[other] >= 0)
                got.append(me[use] * 128 + of[other[use]] + base)
            names, n = np.unique(np.concatenate(got), return_counts=True)
            keys.append(wid[names >> 7] | (names & 127).astype(np.uint64))
            sums.append(n)
            rows += len(names)
            if rows > 2_000_000:
                names, n = summed()
                keys, sums, rows = [names], [n], len(names)
                if rows > 1_500_000:
                    yield made(names, n)
                    keys, sums, rows = [], [], 0
        if keys:
            yield made(*summed())

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.concatenate([np.arange(k), 64 + np.arange(k)])
        for b in (b.slice(i, 8192) for b in batches for i in range(0, b.num_rows, 8192)):
            lists, flat = b.column("near"), b.column("near").flatten()
            row = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            counts = np.bincount(row * 128 + flat.field("code").to_numpy(), flat.field("n").to_numpy(), b.num_rows * 128).reshape(-1, 128)
            finite = np.flatnonzero(np.isfinite(weights[0]))
            best = finite[np.argmax(counts[:, at] @ weights[:, finite], axis=1)]
            yield pa.RecordBatch.from_arrays([b.column("wid"), pa.array(best.astype(np.int32))], names=["wid", "class"])

    # No word here is among the commonest, so no key has a large share of the rows.
    summed = packed.mapInArrow(count, "wid long, code int, n long").repartition("wid").groupBy("wid", "code").agg(F.sum("n").alias("n"))
    near = summed.groupBy("wid").agg(F.collect_list(F.struct("code", "n")).alias("near"))  # at most 128 a word
    return materialize(near.mapInArrow(choose, "wid long, class int"))


@dataclass
class Model:
    """The classes and counts of all words, ``words(word, n, class)``, and the numbers of the classes."""

    words: DataFrame
    texts: int
    n_all: int
    n_types: int
    classes: int
    #: The classes of words that weren't seen: by their last three bytes, else that of the most distinct words.
    endings: dict[bytes, int]
    spare: int
    #: log10 of tokens and distinct words and, but for the end's, one unknown word, by class.
    room: np.ndarray
    history: list[float]


def fit(packed: DataFrame, clustered: int = CLUSTERED, classes: int = CLASSES, sweeps: int = SWEEPS) -> Model:
    """Counts all words of the texts that aren't held out and gives each a class."""
    if classes > 64:
        raise ValueError("at most 64 classes")
    spark = packed.sparkSession
    counts, texts = word_counts(packed)
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()[0]
    top = commonest(counts, clustered).collect()
    top = sorted(((bytes(r["word"]), r["n"]) for r in top), key=lambda x: (-x[1], x[0]))
    units = {w: i + 2 for i, (w, _) in enumerate(top)}
    pairs, n = transitions(packed, units)
    own, history = exchange(pairs, n, len(units) + 2, classes, sweeps)
    k, size = int(own.max()) + 1, len(units) + 2
    joint = np.bincount(own[pairs // size] * k + own[pairs % size], n, k * k).reshape(k, k)
    head = {w: int(own[i]) for w, i in units.items()}
    tail = insert(packed, head, joint)
    heads = spark.createDataFrame([(bytearray(w), c) for w, c in head.items()], "word binary, head int")
    named = counts.withColumn("wid", F.xxhash64("word").bitwiseAND(F.lit((1 << WORD_BITS) - 1)))
    named = named.join(F.broadcast(heads), "word", "left").join(tail, "wid", "left").select("word", "n", F.coalesce("head", "class").alias("class"))
    named = materialize(named.withColumn("ending", F.expr("substring(word, greatest(length(word) - 2, 1), 3)")))
    ends = named.where("class is not null").groupBy("ending", "class").agg(F.count(F.lit(1)).alias("v"))
    ends = materialize(ends.groupBy("ending").agg(F.max_by("class", F.struct("v", -F.col("class"))).alias("by_ending"), F.sum("v").alias("n")))
    ends = materialize(commonest(ends, ENDINGS).drop("n"))
    sizes = {r["class"]: r["v"] for r in named.where("class is not null").groupBy("class").agg(F.count(F.lit(1)).alias("v")).collect()}
    spare = min(sizes, key=lambda c: (-sizes[c], c)) if sizes else END
    words = materialize(named.join(F.broadcast(ends), "ending", "left").select("word", "n", F.coalesce("class", "by_ending", F.lit(spare)).alias("class")))
    mass = np.ones(k)
    mass[END] = texts + (texts > 0) + (spare == END)
    for r in words.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        mass[r["class"]] += r["n"] + r["v"]
    endings = {bytes(r["ending"]): r["by_ending"] for r in ends.collect()}
    return Model(words, texts, int(total["n"] or 0) + texts, int(total["v"]) + (texts > 0), k, endings, spare, np.log10(np.maximum(mass, 1)), history)


def encode(packed: DataFrame, model: Model, head: int = HEAD) -> DataFrame:
    """Texts as classes: ``(doc_ids, held, lens, known, logs, path)``: per text the number of known tokens and the log10 of
    their counts plus one, and the class of each word, in one byte.

    The ``head`` commonest words are looked up in a broadcast table; all others are joined with the table of words, once
    for each packed row they are in.
    """
    common = commonest(model.words, head).toArrow()
    heads = {w: i for i, w in enumerate(common.column("word").to_pylist())}
    table = [common.column(c).to_numpy() for c in ("class", "n")]
    shared = packed.sparkSession.sparkContext.broadcast((heads, *table, model.endings))
    spare, texts = model.spare, model.texts

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = shared.value[0]
        for b, i, words, *_ in unpacked(batches):
            at = np.array([j for j, w in enumerate(words) if w not in heads], np.int32)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), b.column("chunk")[i].as_py())), pa.array(at), pa.array([words[j] for j in at], pa.binary())], names=["chunk", "at", "word"])

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, class_of, count_of, endings = shared.value
        for b, i, words, held, lens, seq in unpacked(batches):
            place = np.array([heads.get(w, -1) for w in words], np.int64)
            known, of, n = place >= 0, np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
            of[known], n[known] = class_of[place[known]], count_of[place[known]]
            for j in np.flatnonzero(~known).tolist():
                of[j] = endings.get(words[j][-3:], spare)
            more = b.column("more")[i]
            if more.is_valid:
                at = more.values.field("at").to_numpy()
                of[at], n[at] = more.values.field("class").to_numpy(), more.values.field("n").to_numpy()
            text = np.repeat(np.arange(len(lens)), lens)
            known = np.bincount(text, (n > 0)[seq], len(lens)).astype(np.int64) + (texts > 0)
            logs = np.bincount(text, np.log10(n + 1.0)[seq], len(lens)) + math.log10(texts + 1)
            made = [b.column("doc_ids").slice(i, 1), b.column("held").slice(i, 1), b.column("lens").slice(i, 1), pa.array([known], pa.list_(pa.int64())), pa.array([logs], pa.list_(pa.float64())), pa.array([of[seq].astype(np.uint8).tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(made, names=["doc_ids", "held", "lens", "known", "logs", "path"])

    found = packed.mapInArrow(rare, "chunk long, at int, word binary").join(model.words, "word")
    more = found.groupBy("chunk").agg(F.collect_list(F.struct("at", F.col("class").cast("int").alias("class"), "n")).alias("more"))
    schema = "doc_ids array<long>, held array<boolean>, lens array<int>, known array<long>, logs array<double>, path binary"
    return materialize(packed.join(more, "chunk", "left").mapInArrow(classed, schema))


def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of each encoded row: the batch, its place, lengths, what is held out, and the classes before and at each token."""
    for b in batches:
        for i in range(b.num_rows):
            lens = b.column("lens")[i].values.to_numpy()
            at = with_ends(np.frombuffer(b.column("path")[i].as_buffer(), np.uint8).astype(np.int64), lens)
            yield b, i, lens, b.column("held")[i].values.to_numpy(zero_copy_only=False).astype(bool), np.concatenate([[END], at[:-1]]), at


def class_transitions(encoded: DataFrame, k: int) -> np.ndarray:
    """How often each class follows each other in the texts that aren't held out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * k, np.int64)
        for _, _, lens, held, prior, at in paths(batches):
            use = np.repeat(~held, lens + 1)
            total += np.bincount(prior[use] * k + at[use], minlength=k * k)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["pair", "n"])

    out = np.zeros(k * k)
    for r in encoded.mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r["pair"]] = r["n"]
    return out.reshape(k, k)


def smoothed(joint: np.ndarray) -> np.ndarray:
    """log10 of the probability of each class after each other; those after one class sum to one."""
    share = (joint.sum(axis=0) + 1) / (joint.sum() + len(joint))
    return np.log10((1 - MIX) * (joint + share * 0.5) / (joint.sum(axis=1, keepdims=True) + 0.5) + MIX * share)


def brown_scores(docs: DataFrame, head: int = HEAD, clustered: int = CLUSTERED, classes: int = CLASSES, sweeps: int = SWEEPS) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for each row of ``docs(doc_id, text)``.

    Learns from the rows that are not held out. A token's probability is that of its class after the class before
    (mixed with the class's frequency) times that of the word in its class, (n + 1) / (tokens + words of the class), where
    all unknown words of a class are one more word of it. So the probabilities after any class sum to one. The ``clustered``
    commonest words are put into classes by exchange, then every other word is inserted into the class that makes its
    neighbours likeliest, or, where none of them is clustered, and if it was never seen, into the class of the most
    words with its last three bytes; class transitions are counted anew over all words. Counts of all words are exact.

    Null, empty and blank texts are one end token. Rows with a null doc_id are learnt from. Repeated rows stay and
    count as often as they come. Other columns are ignored. Without any training row all counts are zero. No rows: no rows.
    """
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == HELD, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"), "text")
    rows = rows.mapInArrow(pack, "doc_ids array<long>, held array<boolean>, lens array<int>, words binary, seq binary")
    packed = materialize(rows.withColumn("chunk", F.monotonically_increasing_id()))
    model = fit(packed, clustered, classes, sweeps)
    encoded = encode(packed, model, head)
    follow = smoothed(class_transitions(encoded, model.classes))
    room = model.room

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, i, lens, _, prior, at in paths(batches):
            text = np.repeat(np.arange(len(lens)), lens + 1)
            path = np.bincount(text, follow[prior, at] - room[at], len(lens))
            made = [b.column(c)[i].values for c in ("doc_ids", "held")] + [pa.array(lens.astype(np.int64) + 1)] + [b.column(c)[i].values for c in ("known", "logs")] + [pa.array(path)]
            yield pa.RecordBatch.from_arrays(made, names=["doc_id", "held_out", "n_tokens", "known", "logs", "path"])

    scored = encoded.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, known long, logs double, path double")
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        F.col("known").alias("n_known"),
        F.lit(model.n_all).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * math.log10(model.n_all + model.n_types + 1)).alias("base_score"),
        (F.col("logs") + F.col("path")).alias("score"),
    )

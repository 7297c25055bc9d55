"""Operator 3: removal of word passages that occur elsewhere, by level-wise doubling of the window length."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FEW, byte_words, free_name, map_column, materialize, of_some, text_key

#: An odd multiplier of the window hashes (any odd 64-bit number will do) and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def levels(window: int, first: int) -> list[int]:
    """Window lengths: ``first``, doubled until ``window`` is reached."""
    out = [min(first, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    digest = xxhash.xxh3_64_digest
    return np.frombuffer(b"".join([digest(w, seed) for w in words]), ">u8").astype(np.uint64)


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` word hashes; equal runs have equal hashes in any document."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(len(hashes), BASE), dtype=np.uint64)])
    mixed = (sums[length:] - sums[:-length]) * _powers(n, INVERSE)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def anchors(hashes: np.ndarray, window: int, length: int, alive: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window that is alive, the leftmost smallest part of ``length`` words, one row for a run that shares it.

    Gives the parts' hashes and the runs' first and last window. Equal windows have equal parts, so a window whose
    part occurs at one place alone occurs once itself. Other than all parts, these are few: about 2 / (window -
    length + 2) of the words.
    """
    parts = window_hashes(hashes, length)
    n = len(hashes) - window + 1
    if n <= 0:
        return parts[:0], np.empty(0, np.int64), np.empty(0, np.int64)
    wide = window - length + 1
    if wide > 1:
        at = np.empty(n, np.int64)
        view = np.lib.stride_tricks.sliding_window_view(parts, wide)
        for i in range(0, n, 8192):
            at[i : i + 8192] = np.argmin(view[i : i + 8192], axis=1)
        at += np.arange(n)
    else:
        at = np.arange(n)
    starts = np.arange(n) if alive is None else np.flatnonzero(alive)
    if not len(starts):
        return parts[:0], starts, starts
    place = at[starts]
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    return parts[place[new]], starts[new], starts[np.concatenate([new[1:], [len(starts)]]) - 1]


def covered(n: int, window: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Of ``n`` words, those in a window that starts in one of the runs from ``first`` to ``last``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, np.minimum(last + window, n), -1)
    return np.cumsum(edge[:-1]) > 0


def _bounds(runs) -> tuple[np.ndarray, np.ndarray]:
    """First and last starts of packed runs."""
    packed = np.asarray(runs, np.int64)
    return packed >> 32, packed & 0xFFFFFFFF


def _alive(n: int, runs) -> np.ndarray:
    out = np.zeros(max(n, 0), bool)
    for a, b in zip(*_bounds(runs)):
        out[a : b + 1] = True
    return out


def repeated_runs(docs: DataFrame, window: int = 35, first: int = 18) -> tuple[DataFrame, DataFrame]:
    """From ``docs(doc_id, text, key)``: ``(uid, runs, lone)``, starts of windows that occur elsewhere are those in
    ``runs`` but not in ``lone``; and ``(uid, doc_id, key, n_words, digest, copies, first)``.

    Rows are numbered (``uid``) in the table that the first scan writes; later scans find a row's text by ``key``.
    Exact copies are collapsed first: of rows with the same word sequence (``whole``) one goes on, marked as many.
    Each level asks for the parts of the surviving windows whether they occur at two places; only documents with
    survivors are read at the next level, which is twice as long. The last level compares 128-bit hashes of whole
    windows; by then nearly all survivors do occur elsewhere, so it gives the starts of the few that don't (``lone``).
    Nothing is gathered by key: counts are pre-aggregated before the shuffle.
    """

    def scan(texts: list) -> tuple[list, ...]:
        rows = []
        for text in texts:
            words = byte_words(text)
            h, a, b = anchors(word_hashes(words), window, sizes[0], None)
            rows.append((len(words), hashlib.sha256(b" ".join(words)).hexdigest(), h.view(np.int64), a << 32 | b))
        return tuple(zip(*rows)) if rows else ([], [], [], [])

    sizes = levels(window, first)
    numbered = docs.withColumn("uid", F.monotonically_increasing_id())
    seen = materialize(map_column(numbered, ["uid", "doc_id", "key"], "text", lambda: scan, "n_words long, digest string, h array<long>, run array<long>"))
    long = seen.where(F.col("n_words") >= window)
    whole = materialize(long.groupBy("digest").agg(F.min("uid").alias("uid"), F.count(F.lit(1)).alias("copies")).select("uid", "copies", "digest"))
    parts = long.select("uid", "h", "run").join(whole.select("uid"), "uid", "left_semi")
    runs = _twice(parts.select("uid", F.explode(F.arrays_zip("h", "run")).alias("p")).select("uid", "p.h", "p.run"))
    lone = runs.select("uid", F.array().cast("array<long>").alias("lone")).limit(0)
    for size in sizes[1:]:
        runs = materialize(runs)

        def extend(batches: Iterator[pd.DataFrame], size=size) -> Iterator[pd.DataFrame]:
            for pdf in (p.iloc[i : i + FEW] for p in batches for i in range(0, len(p), FEW)):
                got = []
                for uid, text, live in zip(pdf["uid"], pdf["text"], pdf["runs"]):
                    words = byte_words(text)
                    h, a, b = anchors(word_hashes(words), window, size, _alive(len(words) - window + 1, live))
                    h2 = window_hashes(word_hashes(words, 1), size)[a] if size == window else np.zeros(len(h), np.uint64)
                    got.append((np.full(len(h), uid), h.view(np.int64), h2.view(np.int64), a << 32 | b))
                if got:
                    yield pd.DataFrame(dict(zip(("uid", "h", "h2", "run"), map(np.concatenate, zip(*got)))))

        parts = of_some(docs, runs.join(seen.select("uid", "key"), "uid")).select("uid", "text", "runs").mapInPandas(extend, "uid long, h long, h2 long, run long")
        if size < window:
            runs = _twice(materialize(parts.drop("h2")))
        else:
            once = parts.groupBy("h", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("uid").alias("uid"), F.min("run").alias("run")).where("n = 1")
            lone = once.groupBy("uid").agg(F.collect_list("run").alias("lone"))
    names = whole.select("digest", "copies", F.col("uid").alias("first"))
    return runs.join(lone, "uid", "left"), seen.select("uid", "doc_id", "key", "n_words", "digest").join(names, "digest", "left")


def _twice(parts: DataFrame) -> DataFrame:
    """``(uid, runs)`` of the parts whose hash occurs at two places at least. The hashes are a table of their own, so
    that both sides of the join come from shuffles and a hash with very many parts can be split."""
    many = materialize(parts.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"))
    return parts.join(many, "h", "left_semi").groupBy("uid").agg(F.collect_list("run").alias("runs"))


def substring_dedup(docs: DataFrame, window: int = 35, first: int = 18, with_text: bool = False) -> DataFrame:
    """Remove every word in a run of ``window`` words that also starts anywhere else, in the same document or another.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; windows are judged on the input. Gives for each row of
    ``docs(doc_id, text)``: doc_id, n_words, n_removed, kept_sha256, and with ``with_text`` the kept words joined by
    one space (``kept``) and the ``text_key`` (``key``). Null, empty and blank texts have no words. A text in several rows, also under one doc_id,
    loses every word if it is ``window`` words long. A null doc_id is kept as it is. No rows: no rows.
    Other columns are ignored, whatever their names.
    """
    docs = docs.select("doc_id", "text", text_key(F.col("text")).alias("key"))
    runs, seen = repeated_runs(docs, window, first)
    seen = materialize(seen)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in (p.iloc[i : i + FEW] for p in batches for i in range(0, len(p), FEW)):
            rows = []
            for uid, text, live, lone in zip(pdf["uid"], pdf["text"], pdf["runs"], pdf["lone"]):
                words = byte_words(text)
                alive = _alive(len(words) - window + 1, live)
                if lone is not None:
                    alive[_bounds(lone)[0]] = False
                starts = np.flatnonzero(alive)
                gone = covered(len(words), window, starts, starts)
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                rows.append((uid, int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace") if with_text else None))
            yield pd.DataFrame(rows, columns=["uid", "n_removed", "kept_sha256", "kept"])

    single = seen.where("coalesce(copies, 1) = 1").select("uid", "key")
    partly = materialize(runs.join(single, "uid"))
    cuts = of_some(docs, partly).select("uid", "text", "runs", "lone").mapInPandas(cut, "uid long, n_removed long, kept_sha256 string, kept string")
    empty = hashlib.sha256(b"").hexdigest()
    many = F.col("copies") > 1
    out = seen.join(cuts, "uid", "left").select(
        "doc_id",
        "key",
        "n_words",
        F.when(many, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(many, F.lit(empty)).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
        F.when(many, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )
    return out if with_text else out.drop("key", "kept")


def strip_repeats(docs: DataFrame, window: int = 35, first: int = 18) -> DataFrame:
    """``docs`` with the passages cut out of the texts that ``substring_dedup`` removes; ``n_chars`` follows.

    Texts that lose nothing stay as they are to the byte; texts of which no word is left go. Null, empty and blank texts
    lose nothing. Rows of equal texts fare alike. Input columns of any other names stay as they are. No rows: no rows.
    """
    key, kept = free_name("_key", docs.columns), free_name("_kept", docs.columns)
    cut = substring_dedup(docs, window, first, with_text=True).where("n_removed > 0")
    cut = cut.select(F.col("key").alias(key), F.col("kept").alias(kept)).dropDuplicates([key])
    out = docs.withColumn(key, text_key(F.col("text"))).join(cut, key, "left").where(F.col(kept).isNull() | (F.col(kept) != ""))
    values = {"text": F.coalesce(F.col(kept), F.col("text")), "n_chars": F.coalesce(F.char_length(kept).cast("long"), F.col("n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*[values[c].alias(c) if c in values else F.col(f"`{c}`") for c in docs.columns])

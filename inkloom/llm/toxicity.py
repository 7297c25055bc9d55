"""Operator 4: toxicity by a weighted lexicon, matched by Aho-Corasick after folding look-alikes."""

from __future__ import annotations

import bisect
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import FEW, hashed_sample, map_column, materialize

#: Letters of other scripts, digits and signs that stand for a Latin letter (fixed values).
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "€": "e",
    "!": "i", "|": "i",
}
FULL_WIDTH = {0xFF01 + i: chr(0x21 + i) for i in range(94)}
ZERO_WIDTH = dict.fromkeys((0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0x00AD))
WORD = re.compile(r"[^\W_]+")
SIGNED = re.compile(r"(?<=\w)[@$€!|](?=\w)|(?<!\w)[@$](?=\w)")
LETTER = re.compile(r"[^\W\d_]")
DIGITS = str.maketrans({k: v for k, v in LOOKALIKES.items() if k.isdigit()})
LETTERS = str.maketrans({k: v for k, v in LOOKALIKES.items() if k.isalpha()} | {chr(k): v for k, v in FULL_WIDTH.items()} | {chr(k): "" for k in ZERO_WIDTH})

#: Labelled rows that the lexicon and the scale are fitted to, at most so many of either label.
SAMPLE = 4000
#: Lengths of the stems that can be entries, beside whole words of any length.
STEMS = range(4, 9)


def fold(text: str) -> list[str]:
    """Words of a text in lower case, with look-alike letters, and digits and signs within words, made Latin letters.

    Numbers (words without a letter) are dropped; accents stay, as they tell words apart.
    """
    text = text.lower()
    if not text.isascii():
        text = text.translate(LETTERS)
    text = SIGNED.sub(lambda m: LOOKALIKES[m[0]], text)
    return [w if w.isalpha() else w.translate(DIGITS) for w in WORD.findall(text) if w.isalpha() or LETTER.search(w)]


def candidates(words: list[str]) -> set[str]:
    """Lexicon entries that a text could support: whole words and stems, both with a space before them."""
    out = set()
    for w in set(words):
        out.add(f" {w} ")
        out.update(f" {w[:k]}" for k in STEMS if k < len(w))
    return out


@dataclass
class Lexicon:
    """Entries with weights, phrases in which entries do not count, and the scale of the score."""

    weights: dict[str, float]
    phrases: list[str] = field(default_factory=list)
    scale: tuple[float, ...] = (-3.0, 1.0, 1.0)

    def automaton(self):
        out = ahocorasick.Automaton()
        for w, v in self.weights.items():
            out.add_word(w, (len(w), v, w))
        for p in self.phrases:
            if p not in self.weights:
                out.add_word(p, (len(p), None, p))
        out.make_automaton()
        return out


def matches(words: list[str], automaton) -> list[tuple[int, float, str]]:
    """``(word end, weight, entry)`` of the entries that occur outside exception phrases; of entries in one word the longest."""
    if not len(automaton):
        return []
    text = f" {' '.join(words)} "
    found, spared = {}, []
    for end, (n, weight, entry) in automaton.iter(text):
        start = end - n + 1
        if weight is None:
            spared.append((start, end))
        elif start not in found or found[start][0] < end:
            found[start] = (end, weight, entry)
    if not spared:
        return [(end, w, e) for end, w, e in found.values()]
    spared.sort()
    starts, reach = [a for a, _ in spared], list(itertools.accumulate((b for _, b in spared), max))

    def inside(start: int, end: int) -> bool:
        """Whether a phrase that starts no later ends no earlier."""
        at = bisect.bisect_right(starts, start)
        return at > 0 and reach[at - 1] >= end

    return [(end, w, e) for start, (end, w, e) in found.items() if not inside(start, end)]


def features(words: list[str], automaton) -> tuple[float, float]:
    """The matched weight per square root of the length, and the share of words matched, both damped."""
    got = matches(words, automaton)
    if not got:
        return 0.0, 0.0
    total, n = sum(w for _, w, _ in got), len(words)
    return math.log1p(total / math.sqrt(n)), math.log1p(100 * len(got) / n)


def score(words: list[str], automaton, scale: tuple[float, ...]) -> float:
    z = scale[0] + sum(a * b for a, b in zip(scale[1:], features(words, automaton)))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.5) -> tuple[float, ...]:
    """Weighted logistic regression with a small ridge on all but the intercept."""
    x = np.hstack([np.ones((len(x), 1)), x])
    b = np.zeros(x.shape[1])
    penalty = np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (weight * (y - p)) - penalty @ b)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in b)


def held_out(doc_id: Column, folds: int = 4, fold_no: int = 2) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold_no, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Lexicon:
    """A lexicon from ``labels(doc_id, toxic)`` that are not held out, on at most ``sample`` rows of either label.

    Rows are taken in the order of a hash of their doc_id; of several texts of one doc_id the smallest is. Entries are words and stems that occur far more often in
    toxic texts; of entries that contain each other the better stays. Exceptions are pairs of words, one of them
    matched, that occur in clean texts alone. The scale is a logistic regression, weighted back to all rows' labels.
    All entries and phrases that pass are kept: the sample bounds their number, as each occurs in several of its rows.
    They, and two numbers per sampled row, reach the driver. Null and empty texts hold no entries.
    """
    spark = docs.sparkSession
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~held_out(F.col("doc_id"))).withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return Lexicon({}, [], (-3.0 if 1 not in sizes else 3.0, 0.0, 0.0))
    known = known.withColumn("h", F.xxhash64("doc_id"))
    parts = [hashed_sample(known.where(F.col("toxic") == v), "h", sample) for v in (0, 1)]
    chosen = docs.select("doc_id", "text").join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id")
    texts = materialize(chosen.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic").repartition(2 * spark.sparkContext.defaultParallelism))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = (Counter(), Counter())
        for pdf in batches:
            for text, toxic in zip(pdf["text"], pdf["toxic"]):
                both[toxic].update(candidates(fold(text or "")))
        names = list(both[1])
        if names:
            yield pd.DataFrame({"entry": names, "bad": [both[1][e] for e in names], "fine": 0})
        names = list(both[0])
        if names:
            yield pd.DataFrame({"entry": names, "bad": 0, "fine": [both[0][e] for e in names]})

    rows = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, fine = rows.get(1, 0), rows.get(0, 0)
    if not bad or not fine:
        return Lexicon({}, [], (-3.0, 0.0, 0.0))
    least = max(3, round(0.01 * bad))
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("fine") + 0.5) / (fine + 1))
    counted = texts.mapInPandas(count, "entry string, bad long, fine long").groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine"))
    # An entry is rare in clean texts, at most one occurrence in ten at equal numbers of texts, and is no accident
    # among as many candidates as there are: its excess in toxic texts (G) is beyond the logarithm of their number.
    counted = materialize(counted.where(F.col("bad") + F.col("fine") >= least))
    rate = bad / (bad + fine)
    n, share = F.col("bad") + F.col("fine"), F.col("bad") / (F.col("bad") + F.col("fine"))
    excess = n * (share * F.log(share / rate) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - rate))).otherwise(0.0))
    certain = math.log(max(2, counted.count())) - 2
    ranked = counted.where(F.col("bad") >= least).withColumn("odds", odds).where((F.col("odds") > math.log(10)) & (excess > certain))
    weights: dict[str, float] = {}
    stems, begun = set(), set()  # of the entries so far, and all their beginnings
    for r in ranked.orderBy((F.col("odds") * F.sqrt("bad")).desc(), "entry").collect():
        stem = r["entry"].rstrip(" ")
        if stem not in begun and not any(stem[:i] in stems for i in range(2, len(stem) + 1)):
            weights[r["entry"]] = float(r["odds"])
            stems.add(stem)
            begun.update(r["entry"][:i] for i in range(1, len(r["entry"]) + 1))
    lexicon = Lexicon(weights)

    def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton, both = lexicon.automaton(), (Counter(), Counter())
        for pdf in batches:
            for text, toxic in zip(pdf["text"], pdf["toxic"]):
                words = fold(text or "")
                ends = np.cumsum([1, *[len(w) + 1 for w in words]])
                pairs = set()
                for end, _, _ in matches(words, automaton):
                    k = min(int(np.searchsorted(ends, end, "right")) - 1, len(words) - 1)
                    k -= ends[k] >= end  # the space after a word belongs to it
                    pairs.update(f" {words[i]} {words[i + 1]} " for i in (k - 1, k) if 0 <= i < len(words) - 1)
                both[toxic].update(pairs)
        names = list(both[0] | both[1])
        if names:
            yield pd.DataFrame({"entry": names, "bad": [both[1][e] for e in names], "fine": [both[0][e] for e in names]})

    pairs = texts.mapInPandas(around, "entry string, bad long, fine long").groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine"))
    lexicon.phrases = [r["entry"] for r in pairs.where("bad = 0 and fine >= 2").orderBy(F.desc("fine"), "entry").collect()]

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for pdf in batches:
            got = [features(fold(t or ""), automaton) for t in pdf["text"]]
            yield pd.DataFrame({"a": [g[0] for g in got], "b": [g[1] for g in got], "toxic": pdf["toxic"]})

    table = texts.mapInPandas(measure, "a double, b double, toxic int").toPandas().sort_values(["toxic", "a", "b"])
    y = table["toxic"].to_numpy(float)
    lexicon.scale = _logistic(table[["a", "b"]].to_numpy(float), y, np.where(y > 0, sizes[1] / bad, sizes[0] / fine))
    return lexicon


def toxicity(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3) -> DataFrame:
    """``(doc_id, score, predicted)`` for each row of ``docs(doc_id, text)``, whole texts; other columns are ignored.

    A score is the logistic of the matched weight, normalised by the length, and the share of words matched. Null,
    empty and wordless texts have the score of a text without a match. Repeated rows and null ids stay. Only the
    lexicon, whose size its sample bounds, is sent to the executors. No rows: no rows.
    """

    def start():
        automaton = lexicon.automaton()

        def of(texts: list) -> tuple[list, list]:
            scores = [score(fold(t or ""), automaton, lexicon.scale) for t in texts]
            return scores, [int(s >= threshold) for s in scores]

        return of

    return map_column(docs, ["doc_id"], "text", start, "score double, predicted int")


def drop_toxic(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3) -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``, whole and unchanged; scores are made where the rows are read.

    Null and empty texts have the score of a text without a match. Columns of any names, repeated rows and null ids pass.
    """
    names = list(docs.columns)
    at = names.index("text")

    def keep(batches: Iterator) -> Iterator:
        import pyarrow as pa

        automaton = lexicon.automaton()
        for batch in (b.slice(i, FEW) for b in batches for i in range(0, b.num_rows, FEW)):
            texts = batch.column(at).to_pylist()
            yield batch.filter(pa.array([score(fold(t or ""), automaton, lexicon.scale) < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)

"""Operator 9: benchmark decontamination by a broadcast hash set of normalised test n-grams (native)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, free_name, materialize, text_key

#: What separates words: all ASCII but letters and digits.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Windows and ids that are broadcast at most, in bytes, with so many more for each row; a larger table is joined by a shuffle.
MAX_BROADCAST_BYTES, ROW_BYTES = 100_000_000, 32


def normal_words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; null has none."""
    return F.filter(F.split(F.coalesce(ascii_lower(text), F.lit("")), GAP), lambda w: w != "")


def _hash(words: Column, at: Column, n: int) -> Column:
    """Hash of the ``n`` words from ``at`` (from zero); written out word by word, so that it is compiled."""
    return F.xxhash64(*[F.get(words, at + k) for k in range(n)])


def window_table(items: DataFrame, width: int) -> DataFrame:
    """``(n, hash, window, items)``: each distinct window, its length in words, and the sorted ids with it."""
    words = items.select("item_id", normal_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(width))
    words = words.withColumn("n", n).withColumn("at", F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)))
    window = words.select("item_id", "n", F.slice("w", F.col("at"), F.col("n")).alias("w"))
    hash_of = F.lit(None).cast("long")
    for k in range(1, width + 1):
        hash_of = F.when(F.col("n") == k, _hash(F.col("w"), F.lit(0), k)).otherwise(hash_of)
    return window.groupBy("n", hash_of.alias("hash"), F.array_join("w", " ").alias("window")).agg(
        F.array_sort(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("")))).alias("items")
    )


def _placed(words: DataFrame, lengths: list[int]) -> DataFrame:
    """``words(key, w)`` as ``(key, w, at, n, hash)``: each place with the hash of the ``n`` words from there, of all lengths."""
    placed = words.where(F.size("w") >= lengths[0]).select("key", "w", F.posexplode("w").alias("at", "word")).drop("word")
    if len(lengths) == 1:
        n = lengths[0]
        return placed.where(F.col("at") <= F.size("w") - n).select("key", "w", "at", F.lit(n).alias("n"), _hash(F.col("w"), F.col("at"), n).alias("hash"))
    grams = F.array(*[F.struct(F.lit(n).alias("n"), _hash(F.col("w"), F.col("at"), n).alias("hash")) for n in lengths])
    return placed.select("key", "w", "at", F.explode(grams).alias("g")).select("key", "w", "at", "g.n", "g.hash").where(F.col("at") <= F.size("w") - F.col("n"))


def hits(docs: DataFrame, items: DataFrame, width: int = 10, most: int | None = None) -> DataFrame:
    """``(key, at, n, items)``: each place ``at`` of ``docs(key, text)`` where a window of ``n`` words occurs.

    Windows of the texts are hashed where they are read and looked up in the table, which is broadcast up to ``most``
    bytes of windows and ids; the words themselves are compared only where a hash is found. Beyond that size the hashes
    alone are shuffled, never the words, and the places that are found go back to their texts to be compared.
    """
    table = materialize(window_table(items, width))
    size = table.agg(F.sum(F.octet_length("window") + F.octet_length(F.array_join("items", ",")) + ROW_BYTES).alias("n")).collect()[0]["n"] or 0
    # At most ``width`` lengths, most often one.
    lengths = sorted(r["n"] for r in table.select("n").distinct().collect())
    if not lengths:
        return docs.select("key", F.lit(0).alias("at"), F.lit(0).alias("n"), F.array(F.lit("")).alias("items")).limit(0)
    words = docs.select("key", normal_words(F.col("text")).alias("w"))
    placed = _placed(words, lengths).alias("p")
    grams = table.alias("g")
    found = (F.col("p.hash") == F.col("g.hash")) & (F.col("p.n") == F.col("g.n"))

    def said(at: Column, n: Column) -> Column:
        return F.array_join(F.slice("w", at + 1, n), " ")

    if size <= (MAX_BROADCAST_BYTES if most is None else most):
        # Equality, said in a way that is not made a join key: it is evaluated only where a hash is found.
        here = said(F.col("p.at"), F.col("p.n"))
        same = F.startswith(here, F.col("g.window")) & (F.char_length(here) <= F.char_length("g.window"))
        return placed.join(F.broadcast(grams), found & same).select("p.key", "p.at", "p.n", "g.items")
    near = placed.drop("w").join(grams, found).select("p.key", "p.at", "p.n", "g.window", "g.items").distinct()
    again = near.join(words.dropDuplicates(["key"]), "key")
    return again.where(said(F.col("at"), F.col("n")) == F.col("window")).select("key", "at", "n", "items")


def _small(found: DataFrame, more: Column) -> DataFrame:
    """What is to be joined with all documents, written first; marked for a broadcast if its bytes are within the bound, so
    that documents aren't shuffled, copies of one text least of all."""
    found = materialize(found)
    size = found.agg(F.sum(more + 32 + ROW_BYTES).alias("n")).collect()[0]["n"] or 0
    return F.broadcast(found) if size <= MAX_BROADCAST_BYTES else found


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 10, most: int | None = None) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A window is ``width`` consecutive words of an item; an item of fewer words, but not none, is one window. A word
    inside any occurrence of a window is hit. Null and empty texts have no words. Repeated rows stay, each with its
    own result; a null item_id counts as one item named by the empty string. Other columns are ignored, whatever their
    names. No items: nothing is hit. No rows: no rows.
    """
    docs = docs.select("doc_id", "text", text_key(F.col("text")).alias("key"))
    spans = hits(docs, items, width, most).groupBy("key").agg(F.collect_set(F.struct("at", "n")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    cover = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["n"] - 1)))))
    spans = spans.select("key", cover.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("names"))
    spans = _small(spans, F.octet_length("names"))
    words = docs.select("key", "doc_id", F.size(normal_words(F.col("text"))).cast("long").alias("n_words"))
    zero = F.lit(0).cast("long")
    out = words.join(spans, "key", "left").select("doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"), F.sha2(F.coalesce("names", F.lit("")), 256).alias("items_sha256"))
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """``docs`` without the rows in which a window of the benchmark occurs; all others stay as they are, null and empty
    texts and repeated rows with them. Input columns of any names stay. No items: all rows stay."""
    key = free_name("_key", docs.columns)
    marked = docs.withColumn(key, text_key(F.col("text")))
    bad = _small(hits(marked.select(F.col(key).alias("key"), "text"), items, width).select(F.col("key").alias(key)).distinct(), F.lit(0))
    return marked.join(bad, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])

import math
import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from inkloom.llm import brown, chat, common, decontaminate, embedding, html_text, mixing, queries, simhash, substring, toxicity, url_filter

ODD = [None, "", " \n\t ", "one", "a b c", "É é Ñ ñ", "x" * 50_000, "w " * 30_000]


def words(rng, n, vocabulary=60):
    return " ".join(f"{rng.choice('Aabc')}{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    shared = words(rng, 50, 500)
    out = list(ODD)
    for i in range(n):
        text = words(rng, rng.randrange(1, 120), 500)
        if i % 5 == 0:
            text = f"{text} {shared} {words(rng, 5)}"
        if i % 7 == 0:
            text = text.replace(" ", "\n ", 3)
        out.append(text)
    base = words(rng, 300, 5000)
    for i in range(8):  # near copies, and copies
        w = base.split()
        if i > 2:
            w[rng.randrange(300)] = "other"
        out.append(" ".join(w))
    return [(i, t) for i, t in enumerate(out)] + [(3, "one"), (None, "a null id"), (None, None)]


def docs(spark, rows=None):
    """Extra columns have names that operators use themselves."""
    rows = corpus() if rows is None else rows
    data = [(d, t, "en", f"s{(d or 0) % 3}" if d != 4 else None, -1, 0, 1, 0.0) for d, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, copy int, fp int, h double")


CLASHES = ["uid", "_uid", "_u", "_n", "_table", "_whole", "_key", "_kept", "key", "kept", "w", "hash", "items", "digest"]


def clashing(spark, rows):
    """Rows with more columns, of names that operators use themselves; ``uid`` is the same for several rows."""
    data = [(d, t, f"s{(d or 0) % 3}", -1, *[(d or 0) // 2] * len(CLASHES)) for d, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, source string, n_chars long, " + ", ".join(f"{c} long" for c in CLASHES))


def by_row(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, i) for i in range(2000, 2050)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        p, q = root(a), root(b)
        parent[max(p, q)] = min(p, q)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in linked}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(("window", "first"), [(35, 18), (35, 9), (8, 4), (5, 9)])
def test_substring(spark, window, first):
    got = by_row(substring.substring_dedup(docs(spark), window, first), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.substring(corpus(), window), key=repr)


def test_strip_repeats(spark):
    got = {r["doc_id"]: r for r in substring.strip_repeats(docs(spark)).collect()}
    for (doc, text), (_, _, gone, _) in zip(corpus(), brute.substring(corpus(), 35)):
        w = brute.WORD.findall(text or "")
        if not gone and doc is not None:
            assert got[doc]["text"] == text and got[doc]["n_chars"] == -1
        elif gone and gone == len(w):
            assert doc not in got


def test_clashing_names(spark):
    """Columns named as the helpers change no result and stay as they are."""
    rows = corpus()
    df = clashing(spark, rows)
    got = by_row(substring.substring_dedup(df), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.substring(rows, 35), key=repr)
    items = [(1, words(random.Random(9), 30, 500)), (2, "one"), (3, rows[20][1])]
    table = spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, uid int, key int")
    got = decontaminate.decontaminate(df, table)
    assert by_row(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(brute.leaks(rows, items), key=repr)
    for out in (substring.strip_repeats(df), decontaminate.drop_contaminated(df, table), mixing.poisson_mix(df, {"s1": 0.5}).drop("copy", "shuffle_key")):
        assert out.columns == df.columns
        assert all(r[c] == (r["doc_id"] or 0) // 2 for r in out.collect() for c in CLASHES)


def test_split_of_the_input_may_change_between_jobs(spark, tmp_path):
    """Rows aren't known by their place: a table that is split in another way in every job gives the same result."""
    rows = corpus()
    docs(spark, rows).repartition(5).write.parquet(str(tmp_path / "t"))
    before, job = spark.conf.get("spark.sql.files.maxPartitionBytes"), iter(range(10**6))
    plain = common.materialize

    def shifting(df):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(3000 + 7000 * (next(job) % 3)))
        return plain(df)

    try:
        substring.materialize = decontaminate.materialize = shifting
        df = spark.read.parquet(str(tmp_path / "t"))
        got = by_row(substring.substring_dedup(df), "doc_id", "n_words", "n_removed", "kept_sha256")
    finally:
        substring.materialize = decontaminate.materialize = plain
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted(brute.substring(rows, 35), key=repr)


@pytest.mark.parametrize("rate", [700.0, 5000.0])
def test_poisson_at_high_rates(spark, rate):
    """Mean and variance are those of a Poisson number, whatever the rate."""
    n = 400
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"))
    counts = np.array([r["n"] for r in mixing.poisson_mix(df, {"s": 1.0}, total=rate * n).groupBy("doc_id").agg(F.count("*").alias("n")).collect()])
    assert len(counts) == n and abs(counts.mean() - rate) < 5 * math.sqrt(rate / n)
    assert abs(counts.var(ddof=1) / rate - 1) < 5 * math.sqrt(2 / n)


@pytest.mark.parametrize("small", [128, 1])
def test_simhash(spark, monkeypatch, small):
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)  # 1: all buckets go by chunks
    monkeypatch.setattr(simhash, "CHUNK", 4)
    rows = corpus()
    prints = [brute.simhash(t, 4) for _, t in rows]
    roots = brute.groups(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    least = {}
    for (d, _), r in zip(rows, roots):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    expected = sorted(((d, f"{p:016x}", least.get(r)) for (d, _), p, r in zip(rows, prints, roots)), key=repr)
    assert by_row(simhash.simhash_groups(docs(spark)), "doc_id", "fingerprint", "component_id") == expected


@pytest.mark.parametrize("distance", [0, 3, 4])
def test_block_masks(distance):
    rng = random.Random(5)
    for n in (10, 10**5, 10**8):
        masks = simhash.block_masks(distance, n)
        for _ in range(300):
            flips = sum(1 << b for b in rng.sample(range(64), distance))
            assert any(not flips & m for m in masks)


def test_simhash_dedup_keeps_one_of_each_group(spark):
    out = {r["doc_id"] for r in simhash.dedup(docs(spark)).collect()}
    near = range(len(corpus()) - 11, len(corpus()) - 3)
    assert len(out & set(near)) == 1 and {0, 1, 2} <= out and None in out


def test_simhash_dedup_finds_similar_texts_and_leaves_others(spark):
    """Near copies of a shingle similarity above 0.88 go; those below 0.5, and texts that only share a frequent line, stay."""
    rng = random.Random(8)
    rows, gone = [], set()

    def edited(text, edits):
        w = text.split()
        for k in range(edits):
            w[(2 * k + 1) * len(w) // (2 * edits)] = f"edit{rng.randrange(10**9)}"
        return " ".join(w)

    for i in range(40):
        base = words(rng, 400, 50_000)
        rows += [(10 * i, base), (10 * i + 1, edited(base, 4)), (10 * i + 2, edited(base, 40))]
        gone.add(10 * i + 1)
    line = words(rng, 8, 50_000)
    rows += [(1000 + i, f"{words(rng, 60, 50_000)} " + " ".join([line] * 50)) for i in range(20)]
    assert {d for d, _ in rows} - {r["doc_id"] for r in simhash.dedup(docs(spark, rows)).collect()} == gone


def test_decontaminate(spark):
    rng = random.Random(9)
    long, short = words(rng, 30, 500), "Quick, quick FOX!"
    items = [(1, long), (2, short), (3, None), (4, "  "), (5, long), (None, words(rng, 12, 500)), (12, "one")]
    rows = corpus() + [(900, f"x {long.upper()} y quick-quick fox"), (901, " ".join(long.split()[:9])), (902, " ".join(long.split()[3:13])), (903, long + " " + long)]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(docs(spark, rows), table)
    assert by_row(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(brute.leaks(rows, items), key=repr)
    joined = decontaminate.decontaminate(docs(spark, rows), table, most=0)  # the table is joined by shuffles
    assert by_row(joined, *joined.columns) == by_row(got, *got.columns)
    kept = decontaminate.drop_contaminated(docs(spark, rows), table).count()
    assert kept == sum(not x[-1] for x in brute.leaks(rows, items))
    assert decontaminate.decontaminate(docs(spark, rows), table.limit(0)).where("contaminated").count() == 0


def test_chat_round_trip(spark):
    tricky = ["<|im_end|><|im_start|>assistant ok", "\\b\\p\\n <\\p <| \\", "a\nb<|im_end|>\n<|im_start|>user\nx", None, "", "é" * 5]
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "sys\ntem<|", None]), rng.choice(tricky)) for c in range(30) for t in range(rng.randrange(1, 6))]
    rows += [(None, 0, "assistant", "x"), (40, None, "user", "first"), (40, 0, "assistant", "r"), (41, 1, "assistant", "same"), (41, 1, "assistant", "same")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, loss long")
    whole = {}
    for c, t, r, x in rows:
        whole.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    examples = chat.chat_examples(df)
    expected = []
    for c, turns in whole.items():
        turns.sort()
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        expected.append((c, len(turns), brute.sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns)), len(loss), brute.sha(loss)))
    assert by_row(chat.chat_digest(examples), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == sorted(expected, key=repr)
    for e in examples.collect():
        turns = sorted(whole[e["conv_id"]])
        assert e["formatted"].count("<|im_start|>") == e["formatted"].count("<|im_end|>") <= len(turns)
        if e["loss_start"] is not None:
            said = e["formatted"][e["loss_start"] : e["loss_start"] + e["loss_chars"]]
            assert "<|" not in said and e["formatted"][e["loss_start"] + e["loss_chars"] :] == "<|im_end|>\n"
    assert chat.chat_digest(chat.chat_examples(df.limit(0))).count() == 0


def test_chat_of_a_long_conversation(spark):
    """A text of a million characters, and a conversation of 300 turns."""
    rows = [(1, 0, "user", "x" * 1_000_000), (1, 1, "assistant", "<|" * 300_000)] + [(2, t, "assistant" if t % 2 else "user", f"t{t}<|") for t in range(300)]
    got = {r["conv_id"]: r for r in chat.chat_digest(chat.chat_examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    assert got[1]["loss_chars"] == 600_000 and got[2]["n_turns"] == 300
    assert got[2]["loss_sha256"] == brute.sha("".join(f"t{t}<|" for t in range(1, 300, 2)))


def test_poisson_mix(spark):
    data = [(i, "x", "big" if i % 3 else "hot") for i in range(3000)] + [(None, "n", None), (5, "x", "tiny")]
    df = spark.createDataFrame([(*r, 7) for r in data], "doc_id long, text string, source string, copy int")
    got = mixing.poisson_mix(df, {"hot": 0.7, "tiny": 0.0, "absent": 0.1}, total=20_000)
    n = {r["source"]: r["n"] for r in got.groupBy("source").agg(F.count("*").alias("n")).collect()}
    rest = 20_000 * 0.3
    assert abs(n["hot"] - 14_000) < 5 * math.sqrt(14_000) and abs(n["big"] - rest) < 5 * math.sqrt(rest) and "tiny" not in n
    assert got.columns == ["doc_id", "text", "source", "copy", "shuffle_key"]
    assert by_row(got, *got.columns) == by_row(mixing.poisson_mix(df.repartition(3), {"hot": 0.7, "tiny": 0.0, "absent": 0.1}, total=20_000), *got.columns)
    counts = [r["n"] for r in got.where("source = 'hot'").groupBy("doc_id").agg(F.count("*").alias("n")).collect()]
    assert abs(np.var(counts + [0] * (1000 - len(counts))) / 14 - 1) < 0.2
    large = mixing.poisson_mix(df.where("source = 'tiny'"), {"tiny": 1.0}, total=5000)
    assert 4900 < large.count() < 5100
    assert mixing.poisson_mix(df.limit(0), {"hot": 0.7}).count() == 0


@pytest.mark.parametrize(("small", "chunk", "shingles"), [(4, 3, 1 << 23), (1, 3, 1 << 23), (1, 4096, 300)])
def test_simhash_dedup_by_brute_force(spark, monkeypatch, small, chunk, shingles):
    """Pairs on either side of a five-word similarity of 0.8, in few and in many rows: those of 0.8 and more go."""
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    monkeypatch.setattr(simhash, "CHUNK_SHINGLES", shingles)
    rng = random.Random(9)
    rows, sets, gone = [], {}, set()
    for i in range(200):
        w = words(rng, 150, 50_000).split()
        for k in range(3):
            edited = list(w)
            for at in rng.sample(range(150), k and rng.randrange(1, 8)):
                edited[at] = f"edit{rng.randrange(10**9)}"
            rows.append((3 * i + k, " ".join(edited)))
            sets[3 * i + k] = {tuple(edited[a : a + 5]) for a in range(146)}
        link = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8 for a, b in ((3 * i, 3 * i + 1), (3 * i, 3 * i + 2), (3 * i + 1, 3 * i + 2))}
        ab, ac, bc = link.values()
        gone |= ({3 * i + 1} if ab or (ac and bc) else set()) | ({3 * i + 2} if ac or bc else set())
    got = {d for d, _ in rows} - {r["doc_id"] for r in simhash.dedup(docs(spark, rows)).collect()}
    assert got <= gone and len(got) >= 0.98 * len(gone) > 50


def test_near_copy_keys_are_simhash_bits(spark):
    """Each key holds bits of the SimHash fingerprints of the distinct shingles, all of them by plain counting."""
    rng = random.Random(11)
    texts = ["one", words(rng, 8), words(rng, 9), words(rng, 300), words(rng, 6000, 10**6)]
    n = simhash.BANDS * simhash.KEY_BITS // 64
    prints = [simhash.sim_hashes(np.unique(simhash._hashes(t, 5, 42))).view(np.int64).tolist() for t in texts]
    assert prints == [simhash.fingerprint(t, 5, prints=n, repeats=False) for t in texts]
    got = spark.createDataFrame(list(enumerate(prints)), "i int, fps array<long>").select("i", simhash.band_keys(F.col("fps")).alias("keys")).collect()
    for r in got:
        bits = "".join(f"{x & (1 << 64) - 1:064b}"[::-1] for x in prints[r["i"]])
        at = [bits[k : k + simhash.KEY_BITS] for k in range(0, len(bits), simhash.KEY_BITS)]
        assert r["keys"] == [(k << simhash.KEY_BITS) | int(b[::-1], 2) for k, b in enumerate(at)]


def test_near_copy_keys_are_small_plans(spark, monkeypatch):
    """No query of the stage has generated code that grows with the keys of a document, which the driver holds and compiles."""
    real, code = simhash.materialize, []

    def materialize(df):
        out = real(df)
        code.append(len(spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")))
        return out

    monkeypatch.setattr(simhash, "materialize", materialize)
    w = words(random.Random(4), 60, 50_000)
    assert simhash.dedup(docs(spark, [(1, w), (2, w + " x"), (3, "another")])).count() == 2
    assert 50_000 < max(code) < 250_000


def test_near_copies_of_large_buckets_are_left_to_chunks(spark, monkeypatch):
    """Pairs that are near, but not similar, and share large buckets only are not verified one by one as well."""
    real, pairs = simhash._verified, []
    monkeypatch.setattr(simhash, "SMALL_BUCKET", 1)
    monkeypatch.setattr(simhash, "_verified", lambda p, *a: (pairs.append(p.count()), real(p, *a))[1])
    rng = random.Random(6)
    w = words(rng, 300, 50_000).split()
    rows = [(i, " ".join(f"x{rng.random()}" if rng.random() < 0.025 else x for x in w)) for i in range(40)]
    simhash.dedup(docs(spark, rows)).count()
    assert len(pairs) == 2 and pairs[0] > 0 == pairs[1]


def test_near_copy_keys_recall_at_the_bound():
    """Pairs of a similarity of just 0.8 share a key, and are near by their first words, in nine of ten cases and more."""
    rng, hit = np.random.default_rng(1), 0
    for _ in range(400):
        both = rng.integers(0, 1 << 64, 180, np.uint64)
        a, b = (simhash.sim_hashes(both[x]) for x in (slice(0, 162), slice(18, 180)))
        a_keys, b_keys = (np.packbits(np.unpackbits(x.view(np.uint8), bitorder="little").reshape(simhash.BANDS, -1), axis=1) for x in (a, b))
        hit += bool((a_keys == b_keys).all(axis=1).any()) and np.bitwise_count(a ^ b)[: simhash.SKETCH].sum() <= simhash.FAR
    assert hit >= 0.92 * 400


def test_dedup_of_repeated_and_null_ids(spark):
    rng = random.Random(3)
    a, b, c = (words(rng, 40, 50_000) for _ in range(3))
    rows = [(1, a), (1, b), (2, a), (None, a), (None, b), (None, c), (None, c), (7, c + " x"), (7, c + " x"), (8, None), (8, None), (None, ""), (1, a)]
    out = by_row(simhash.dedup(docs(spark, rows)), "doc_id", "text")
    assert out == sorted([(1, a), (1, b), (7, c + " x"), (8, None), (8, None), (None, "")], key=repr)
    assert simhash.dedup(clashing(spark, rows)).columns == clashing(spark, rows).columns


def test_simhash_null_id_links_its_neighbours(spark, monkeypatch):
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *_, **__: docs.select("doc_id", F.array(F.col("text").cast("long")).alias("fps")))
    rows = [(4, "0"), (None, str(0b1111)), (3, str(0b11111111)), (None, str(0x5555555555555555))]
    got = simhash.simhash_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert by_row(got, "doc_id", "component_id") == sorted([(4, 3), (None, 3), (3, 3), (None, None)], key=repr)


def vectors(spark, n=1500, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 64)).astype(np.float32)
    for i in range(0, n // 2, 2):
        x[i + 1] = x[i] + 0.055 * math.sqrt(64) * rng.standard_normal(64).astype(np.float32)
    x[900:940] = x[900] + 0.1 * rng.standard_normal((40, 64)).astype(np.float32)
    x[940:960] = x[940]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(5000, None), (5001, []), (5002, [0.0] * 64), (5003, [float("nan")] * 64), (5004, [float("inf")] + [1.0] * 63), (5005, [None] + [1.0] * 63), (5006, [1.0, 0.0]), (5007, [1.0, 0.01]), (5007, [1.0, 0.01]), (None, [3.0, 4.0])]
    return x, spark.createDataFrame([(*r, 0, 1) for r in rows + odd], "vec_id long, embedding array<float>, rep int, dim int")


@pytest.mark.parametrize("chunk", [1024, 7])
def test_embedding(spark, monkeypatch, chunk):
    monkeypatch.setattr(embedding, "CHUNK", chunk)
    x, df = vectors(spark)
    got = {r["vec_id"]: r for r in embedding.embedding_neighbours(df).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    found = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (found <= near.sum(axis=1)).all() and found.sum() >= 0.98 * near.sum() > 1000
    assert [got[i]["n_links"] for i in range(5000, 5007)] == [0] * 6 + [2] and got[5007]["component_id"] == 5006
    assert all(got[i]["component_id"] == got[i]["vec_id"] and got[i]["kept"] for i in range(5000, 5006))
    assert {got[i]["component_id"] for i in range(900, 940)} == {900} and not got[901]["kept"]
    assert embedding.embedding_neighbours(df.limit(0)).count() == 0


def test_embedding_null_ids(spark):
    """A row without an id is compared and counted, and links others."""
    at = lambda d: [math.cos(math.radians(d)), math.sin(math.radians(d))]
    rows = [(None, at(0)), (5, at(20)), (3, at(-20)), (None, at(90)), (None, at(91)), (8, at(200)), (9, at(8))]
    for kind in ("float", "double"):
        got = by_row(embedding.embedding_neighbours(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")), "vec_id", "n_links", "component_id")
        assert got == sorted([(None, 3, 3), (5, 2, 3), (3, 1, 3), (9, 2, 3), (None, 1, None), (None, 1, None), (8, 0, 8)], key=repr)


@pytest.mark.parametrize("n", [2000, 10_000, 100_000, 1_000_000])
def test_embedding_recall_at_the_bound(n):
    """Pairs at 0.90 to 0.92 alone, on axes and at random, whatever the number of vectors."""
    code = embedding.ProductCode(64, *embedding.code_shape(n, 24.0), 24.0, 42, 0.9, 0.99)
    rng = np.random.default_rng(5)
    x, y = (np.concatenate(p) for p in zip(*[embedding._pairs_at(rng, 150, 64, c) for c in (0.9, 0.91, 0.92)]))
    found = sum(bool(set(a.tolist()) & set(b.tolist())) for a, b in zip(code.decode(x), code.decode(y)))
    assert found / len(x) >= 0.975
    whole, one = code.decode(x[:50]), [code.decode(v[None])[0] for v in x[:50]]
    assert all((a == b).all() for a, b in zip(whole, one))


def test_html():
    tree = html_text.grow(html_text.labelled_rows())
    page = (
        "<html><head><title>T</title><script>if (a</b>) '</p>'</script><style>p{}</style></head><body class='has-sidebar'>"
        "<header><a href=/>Home</a></header><nav><ul><li><a>x</a><li><a>y</a></ul></nav><div id='cookie-notice'>We use cookies.</div>"
        "<article><header><h1>Title &amp; &lt;more&gt;</h1></header><p>First  para&nbsp;graph,\n <a href='#'>linked</a> &copy &am</p><!-- <p>no</p> -->"
        "<aside>Side</aside><form><input><button>Send</button></form><p>Short.<p>3 < 4 <b>bold</p><div class='ad'>Buy</div>"
        "<p>Be <span class=promo>NOW</span> here</p><section id=comments><p>A reader said a great deal about all of this and more.</p></section>"
        "</article><footer>&copy; f</footer></body>"
    )
    assert html_text.main_text(page, tree) == "Title & <more>\n\nFirst para graph, linked © &am\n\nShort.\n\n3 < 4 bold\n\nBe NOW here"
    for odd in (None, "", "<", "<p", "<!--", "<script>x", "</", "<p>\x00</p>" * 3):
        assert isinstance(html_text.main_text(odd, tree), str)
    long = "<article>" + "<p>" + "word " * 200_000 + "</p></article>"
    assert html_text.main_text(long, tree).count("word") == 200_000
    plain = "<body><ul><li><a>a</a><li><a>b</a></ul><div>" + "text and more of it " * 8 + "</div><div>" + "also this here text " * 9 + "</div><ul><li><a>c</a></ul>"
    assert html_text.main_text(plain, tree).count("\n\n") == 1 and "also" in html_text.main_text(plain, tree)


def test_html_names_inside_a_line_drop_nothing():
    tree = html_text.grow(html_text.labelled_rows())
    page = "<article><p>We used an <span class='ad-hoc'>ad hoc</span> method and a <code class='form'>form</code> here.</p><div id='related-work'>The work that is related is here.</div>"
    assert html_text.main_text(page, tree) == "We used an ad hoc method and a form here.\n\nThe work that is related is here."
    assert html_text.main_text("<article><p>seen <span hidden>not <b>this</b></span>and <i style='display: none'>nor</i> this</article>", tree) == "seen and this"


def test_html_reads_neighbours():
    """Without an article element or names, blocks are told apart by words, link density, neighbours and kinds of tags."""
    rng, tree = random.Random(3), html_text.grow(html_text.labelled_rows())
    used = set()

    def walk(t):
        if len(t) > 1:
            used.add(t[0])
            walk(t[2])
            walk(t[3])

    walk(tree)
    assert used & {2, 3, 4, 5} and 0 in used and 1 in used
    right = total = 0
    for _ in range(60):
        link = lambda: f"<li><a href=/>{words(rng, rng.randrange(1, 4))}</a></li>"
        body = [("h2", words(rng, rng.randrange(3, 9)))] + [("p", words(rng, rng.randrange(12, 120))) for _ in range(rng.randrange(3, 9))]
        menu, foot = "".join(link() for _ in range(6)), "".join(link() for _ in range(4))
        page = f"<body><div><ul>{menu}</ul></div><div>" + "".join(f"<{t}>{x}</{t}>" for t, x in body) + f"</div><ul>{foot}</ul><div>{words(rng, 4)}</div>"
        got = html_text.main_text(page, tree).split("\n\n")
        right += len(set(got) & {x for _, x in body}) - len(set(got) - {x for _, x in body})
        total += len(body)
    assert right >= 0.95 * total


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "x", "<a b='" * 50_000, "<div>" * 50_000 + "</p>" * 50_000, "<p x=\"'>" * 50_000, "<svg>" * 30_000, "<!-- " * 30_000, "</" * 50_000, "<p><span hidden>" * 30_000])
def test_html_takes_linear_time(page):
    import time

    start = time.process_time()
    html_text.main_text(page, html_text.grow(html_text.labelled_rows()))
    assert time.process_time() - start < 2


def test_html_rows(spark):
    df = spark.createDataFrame([(1, "u", None, "x"), (None, None, "<article><p>a b c</article>", "y"), (1, "u", None, "x")], "page_id long, url string, html string, text string")
    assert by_row(html_text.extract_main_text(df), "page_id", "url", "text", "n_chars") == sorted([(1, "u", "", 0), (None, None, "a b c", 5), (1, "u", "", 0)], key=repr)
    assert html_text.extract_main_text(df.limit(0)).count() == 0


def test_html_accuracy(spark, sf_dir):
    import html
    import re

    for r in common.table(spark, sf_dir, "pages").join(queries.op10_html_text(spark, sf_dir), ["page_id", "url"]).collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def toxic_corpus(n=900, seed=4):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = words(rng, rng.randrange(20, 90), 800).split()
        bad = i % 8 == 0
        if bad:
            for _ in range(4):
                w[rng.randrange(len(w))] = rng.choice(["Idiot", "moron", "1d1ot", "mоrоn", "vilbar" + rng.choice("xyz") + "ak"])
        elif i % 31 == 0:
            w[rng.randrange(len(w) - 1) :][:2] = ["idiot", "proof"]
            w += ["idiot", "proof"]
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_corpus()
    df = docs(spark, rows + [(5000, None), (5001, ""), (None, "idiot"), (5001, "")])
    table = spark.createDataFrame([(*x, 1) for x in labels] + [(None, 1, 0), (7000, None, 0), (0, 1, 0)], "doc_id long, toxic int, quality int")
    lexicon = toxicity.learn(df, table)
    out = toxicity.toxicity(df, lexicon)
    assert out.count() == len(rows) + 4
    got = {r["doc_id"]: r for r in out.collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    right = [got[i]["predicted"] == int(i % 8 == 0) for i in held]
    assert sum(right) >= 0.97 * len(right)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    assert not got[5000]["predicted"] and got[5000]["score"] == got[5001]["score"]
    assert any(p.endswith(" idiot proof ") for p in lexicon.phrases)
    kept = toxicity.drop_toxic(df, lexicon)
    assert kept.schema == df.schema and kept.count() == sum(not r["predicted"] for r in out.collect())
    for none in (table.limit(0), table.where("toxic = 0")):
        assert toxicity.toxicity(df, toxicity.learn(df, none)).where("predicted = 1").count() == 0
    assert toxicity.toxicity(df.limit(0), lexicon).count() == 0 and toxicity.learn(df.limit(0), table).weights == {}


def plain_score(text, lexicon):
    """The score from its definition, without an automaton."""
    text = f" {' '.join(toxicity.fold(text or ''))} "
    n = len(text.split())
    at = lambda x: [i for i in range(len(text)) if text.startswith(x, i)]
    spared = [(i, i + len(p)) for p in lexicon.phrases if p not in lexicon.weights for i in at(p)]
    best = {}
    for entry, weight in lexicon.weights.items():
        for i in at(entry):
            best[i] = max(best.get(i, (0, 0.0)), (len(entry), weight))
    got = [w for i, (size, w) in best.items() if not any(a <= i and i + size <= b for a, b in spared)]
    a, b = (math.log1p(sum(got) / math.sqrt(n)), math.log1p(100 * len(got) / n)) if got else (0.0, 0.0)
    z = lexicon.scale[0] + lexicon.scale[1] * a + lexicon.scale[2] * b
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def test_toxicity_by_its_definition(spark):
    rows, labels = toxic_corpus(300)
    rows += [(9001, None), (9002, " "), (9003, "idiot proof " * 300), (9004, "an idiot idiot proof moronic 1d1ot"), (0, "another text of a doc_id that comes twice")]
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = toxicity.learn(docs(spark, rows), table)
    assert lexicon.weights and lexicon.phrases
    got = toxicity.toxicity(docs(spark, rows), lexicon).collect()
    assert sorted((repr(r["doc_id"]), round(r["score"], 9)) for r in got) == sorted((repr(d), round(plain_score(t, lexicon), 9)) for d, t in rows)
    again = toxicity.learn(docs(spark, rows[::-1]).repartition(3), table)
    assert (again.weights, again.phrases) == (lexicon.weights, lexicon.phrases) and again.scale == pytest.approx(lexicon.scale)


def test_toxicity_of_a_very_long_text():
    import time

    lexicon = toxicity.Lexicon({" idiot ": 2.0}, [" idiot proof "])
    start = time.process_time()
    got = toxicity.matches(("idiot proof idiot bad " * 50_000).split(), lexicon.automaton())
    assert len(got) == 50_000 and time.process_time() - start < 3


def test_calibrate_and_verdict(spark):
    """The bound is the best of all mid-points by brute force; URLs that no rule decides are judged by it."""
    rng = random.Random(5)
    scored = [(round(rng.gauss(1 if ok else -1, 1), 1), ok) for ok in (True, False) for _ in range(40)]
    values = sorted({x for x, _ in scored})
    rate = lambda t: sum(x >= t for x, ok in scored if ok) / 40 + sum(x < t for x, ok in scored if not ok) / 40
    best = max(values, key=lambda v: (round(rate(v), 9), -v))
    below = [v for v in values if v < best]
    got = url_filter.calibrate(spark.createDataFrame(scored, "score double, accepted boolean"))
    assert got == pytest.approx((best + below[-1]) / 2 if below else best)
    urls = [f"http://{''.join(rng.choice('abc') for _ in range(8))}.net/de/{i}" for i in range(150)] + [f"http://{''.join(rng.choice('xyz') for _ in range(8))}.com/en/{i}" for i in range(150)]
    fresh = [f"http://{''.join(rng.choice(a) for _ in range(9))}.info/{k}" for a in ("abc", "xyz") for k in range(40)]
    rows = [(i, u) for i, u in enumerate([*urls, *fresh, "http://q.net/de/" + "a" * 5000])]
    out = {r["page_id"]: r for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), queries.URL_RULES).collect()}
    verdicts = [out[len(urls) + k]["verdict"] for k in range(80)]
    assert verdicts[:40].count("allow") >= 36 and verdicts[40:].count("block") >= 36
    bound = {v: [out[len(urls) + k]["score"] for k in range(80) if verdicts[k] == v] for v in ("allow", "block")}
    assert min(bound["allow"]) >= max(bound["block"])


def test_url_models_read_all_labelled_urls(spark):
    """12,000 labelled URLs of either verdict: scores are those of models of all, the bound is the best over all, each scored without
    its fold."""
    rng = random.Random(12)
    say = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randrange(2, 5)))
    urls = [f"http://{say('abcdx')}.net/de/" for _ in range(6000)] + [f"http://{say('wxyza')}.com/en/" for _ in range(6000)]
    fresh = [f"http://{say(a)}.info/" for a in ("abcdx", "wxyza") for _ in range(50)]
    df = spark.createDataFrame(list(enumerate([*urls, *fresh])), "page_id long, url string")
    out = {r["page_id"]: r for r in url_filter.filter_urls(df, queries.URL_RULES).collect()}
    known = spark.createDataFrame([(u, i < 6000) for i, u in enumerate(urls)], "url string, accepted boolean").withColumn("fold", F.expr("pmod(xxhash64(url), 5)")).withColumn("uid", F.monotonically_increasing_id())
    model = url_filter.fit(known.select("url", "accepted"))
    scores = {r["url"]: r["score"] for r in url_filter.ratio(df.select("url").distinct(), model).collect()}
    assert all(out[i]["score"] == pytest.approx(scores[u], abs=1e-9) for i, u in enumerate([*urls, *fresh]))
    held = [r for f in range(5) for r in url_filter.ratio(known.where(F.col("fold") == f), url_filter.fit(known.where(F.col("fold") != f).select("url", "accepted"))).select(F.round("score", 9).alias("score"), "accepted").collect()]
    assert len(held) == len(urls)
    values = sorted({r["score"] for r in held})
    below, most, best = 0, -1, 0
    gains = {v: 0 for v in values}
    for r in held:
        gains[r["score"]] += -1 if r["accepted"] else 1
    for i, v in enumerate(values):
        if below > most:
            most, best = below, i
        below += gains[v]
    bound = (values[best] + values[max(best - 1, 0)]) / 2
    judged = [(scores[u], out[len(urls) + k]["verdict"]) for k, u in enumerate(fresh)]
    assert all(v == ("allow" if s >= bound else "block") for s, v in judged if abs(s - bound) > 1e-8) and len({v for _, v in judged}) == 2


def test_rules_of_equal_length(spark):
    df = spark.createDataFrame([(1, "http://a.com/en/")], "page_id long, url string")
    for rules in ([("allow", "com/en/"), ("block", "com/en/")], [("block", "com/en/"), ("allow", "com/en/")]):
        assert [r["verdict"] for r in url_filter.filter_urls(df, rules).collect()] == ["block"]


def test_fold():
    assert toxicity.fold("1D10T! Ｆｏｏ m\u200boron сlоwn 1234 c@t é") == ["idiot", "foo", "moron", "clown", "cat", "é"]


def test_url_rules(spark):
    urls = ["http://A.Example.COM/en/7x?q", "https://example.com/en/8", "x://com/en/", "ftp://b.com/EN/", "http://de.net/de/1", "http://example.net/de/8", "http://notexample.net/de/8", "http://x.org/es/#a/b", "no scheme", None, "", "http://", "http://h?x", "a://b://c/d", "http://example.com.evil/en/7"]
    expected = {
        urls[0]: ("a.example.com", "/en/7x", "example.com/en/7", "allow"),
        urls[1]: ("example.com", "/en/8", "com/en/", "block"),
        urls[2]: ("com", "/en/", "com/en/", "block"),
        urls[3]: ("b.com", "/EN/", None, None),
        urls[4]: ("de.net", "/de/1", "net/de/", "allow"),
        urls[5]: ("example.net", "/de/8", "example.net/de/8", "block"),
        urls[6]: ("notexample.net", "/de/8", "net/de/", "allow"),
        urls[7]: ("x.org", "/es/", "org/es/", "block"),
        urls[8]: ("", "", None, None),
        None: ("", "", None, None),
        "": ("", "", None, None),
        urls[11]: ("", "", None, None),
        urls[12]: ("h", "", None, None),
        urls[13]: ("b:", "//c/d", None, None),
        urls[14]: ("example.com.evil", "/en/7", None, None),
    }
    df = spark.createDataFrame([(i, u, "x", 1.0) for i, u in enumerate(urls)] + [(None, urls[0], "x", 1.0)], "page_id long, url string, host string, score double")
    got = url_filter.filter_urls(df, queries.URL_RULES).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        host, path, rule, verdict = expected[urls[r["page_id"] or 0]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] in ("allow", "block")
        assert verdict is None or r["verdict"] == verdict
    assert url_filter.filter_urls(df.limit(0), queries.URL_RULES).count() == 0
    assert {r["verdict"] for r in url_filter.filter_urls(df, ()).collect()} == {"allow"}


def test_url_model(spark):
    """The joined tables give the smoothed recursion's probabilities."""
    rng = random.Random(6)
    fitted = [("".join(rng.choice("ab/" if ok else "bc-") for _ in range(rng.randrange(1, 12))), ok) for _ in range(60) for ok in (True, False)]
    model = url_filter.fit(spark.createDataFrame(fitted, "url string, accepted boolean"))
    seen = {}
    for url, ok in fitted:
        for i in range(len(url)):
            for k in range(url_filter.ORDER + 1):
                g = ("\x02" * url_filter.ORDER + url)[i + url_filter.ORDER - k : i + url_filter.ORDER + 1]
                for key in ((ok, k, g), (ok, k, g[:-1], "all")):
                    seen[key] = seen.get(key, 0) + 1

    def p(ok, context, c):
        below = p(ok, context[1:], c) if context else 1 / url_filter.ALPHABET
        k = len(context)
        return (seen.get((ok, k, context + c), 0) + url_filter.CONCENTRATION * below) / (seen.get((ok, k, context, "all"), 0) + url_filter.CONCENTRATION)

    tests = [u for u, _ in fitted[:10]] + ["zzz", "abz/bc-", ""]
    got = {r["url"]: r["score"] for r in url_filter.ratio(spark.createDataFrame([(u,) for u in tests], "url string"), model).collect()}
    for u in tests:
        padded = "\x02" * url_filter.ORDER + u
        each = [math.log(p(True, padded[i : i + url_filter.ORDER], c) / p(False, padded[i : i + url_filter.ORDER], c)) for i, c in enumerate(u)]
        assert got[u] == pytest.approx(sum(each) / len(each) if each else 0.0, abs=1e-9)


@pytest.mark.parametrize("head", [200_000, 40])
def test_brown(spark, head):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["the", "A", "one"]) + f" n{rng.randrange(60)} " + rng.choice(["runs", "sits"]) + f" d{rng.randrange(300)}" for _ in range(rng.randrange(0, 25)))) for i in range(300)]
    rows += [(1000, None), (1001, " \n"), (None, "the n1 runs"), (1002, "unknown-word the\u00c9 n1"), (5, rows[5][1])]
    df = docs(spark, rows)
    got = sorted(brown.brown_scores(df, head=head, clustered=100, classes=8).collect(), key=repr)
    train = [t for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 7 != 2]
    count = {}
    for t in train:
        for w in [*brute.WORD.findall((t or "").translate(brute.LOWER)), None]:
            count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    expected = []
    for d, t in rows:
        tokens = [*brute.WORD.findall((t or "").translate(brute.LOWER)), None]
        base = sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in tokens)
        expected.append((d, d is not None and zlib.crc32(str(d).encode()) % 7 == 2, len(tokens), sum(w in count for w in tokens), n, pytest.approx(base)))
    key = lambda r: (repr(r[0]), r[2])
    assert sorted([tuple(r)[:6] for r in got], key=key) == sorted(expected, key=key)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) and all(r["score"] < 0 for r in got)


def packed(spark, rows):
    held = F.expr("coalesce(pmod(crc32(cast(cast(doc_id as string) as binary)), 7) = 2, false)").alias("held")
    df = docs(spark, rows).select("doc_id", held, "text")
    return df.mapInArrow(brown.pack, "doc_ids array<long>, held array<boolean>, lens array<int>, words binary, seq binary").withColumn("chunk", F.monotonically_increasing_id())


def small_corpus(n=250):
    rng = random.Random(8)
    return [(i, " ".join(rng.choice(["the", "A", "one"]) + f" n{rng.randrange(60)} " + rng.choice(["runs", "sits"]) + f" d{rng.randrange(300)}" for _ in range(rng.randrange(0, 25)))) for i in range(n)]


def test_brown_by_its_definition(spark):
    """Scores are those of a plain class bigram model over the operator's classes, whose probabilities sum to one."""
    rows = small_corpus() + [(1000, None), (1001, "unknown-word the n1")]
    tokens = {d: [*brute.WORD.findall((t or "").translate(brute.LOWER)), None] for d, t in rows}
    train = [d for d, _ in rows if zlib.crc32(str(d).encode()) % 7 != 2]
    model = brown.fit(packed(spark, rows), 30, 8)
    of = {r["word"].decode(): (r["class"], r["n"]) for r in model.words.collect()}
    of[None] = (0, len(train))
    count = {}
    for d in train:
        for w in tokens[d]:
            count[w] = count.get(w, 0) + 1
    assert count == {w: n for w, (_, n) in of.items()} and len({c for c, _ in of.values()}) > 4
    k = model.classes
    joint, mass = np.zeros((k, k)), np.zeros(k)
    of_word = lambda w: of.get(w) or (model.endings.get(w.encode()[-3:], model.spare), 0)
    for d in train:
        for x, y in zip([None, *tokens[d]], tokens[d]):
            joint[of_word(x)[0], of_word(y)[0]] += 1
    for c, n in of.values():
        mass[c] += n + 1
    mass[1:] += 1
    share = (joint.sum(axis=0) + 1) / (joint.sum() + k)
    follow = (1 - brown.MIX) * (joint + 0.5 * share) / (joint.sum(axis=1, keepdims=True) + 0.5) + brown.MIX * share
    p = lambda x, y: follow[of_word(x)[0], of_word(y)[0]] * (of_word(y)[1] + 1) / mass[of_word(y)[0]]
    for before in [None, "the", "n1", "d5"]:  # an unknown word of each class, and the known ones
        assert sum(p(before, w) for w in of) + sum(follow[of_word(before)[0], c] / mass[c] for c in range(1, k)) == pytest.approx(1)
    got = {r["doc_id"]: r["score"] for r in brown.brown_scores(docs(spark, rows), clustered=30, classes=8, head=20).collect()}
    for d, _ in rows:
        assert got[d] == pytest.approx(sum(math.log10(p(x, y)) for x, y in zip([None, *tokens[d]], tokens[d])))


def test_exchange_by_brute_force():
    """The same classes as when the likelihood is computed anew for each class of each unit; it never falls."""
    rng = np.random.default_rng(4)
    size, classes = 24, 6
    table = rng.poisson(1.5, (size, size)) * rng.integers(0, 8, (size, 1))
    pairs = np.flatnonzero(table)
    own, history = brown.exchange(pairs, table.ravel()[pairs].astype(np.int64), size, classes, 4)
    mine = [0, 1] + [2 + i % (classes - 2) for i in range(size - 2)]

    def value():
        joint = np.zeros((classes, classes))
        np.add.at(joint, (np.repeat(mine, size), np.tile(mine, size)), table.ravel())
        h = lambda x: sum(v * math.log(v) for v in np.ravel(x) if v > 0)
        return h(joint) - h(joint.sum(axis=0)) - h(joint.sum(axis=1))

    seen = [value()]
    for _ in range(4):
        for w in range(2, size):
            was, tried = mine[w], {}
            for c in range(2, classes):
                mine[w] = c
                tried[c] = value()
            best = max(tried, key=lambda c: (tried[c], -c))
            mine[w] = best if tried[best] > tried[was] + 1e-6 else was
        seen.append(value())
    assert own.tolist() == mine and history == pytest.approx(seen[: len(history)])
    assert all(a <= b + 1e-9 for a, b in zip(history, history[1:])) and history[-1] > history[0]


def test_brown_of_a_long_text_and_many_words(spark, monkeypatch):
    """Texts of more words than a packed row takes, and of more distinct ones than two bytes tell apart."""
    rows = [(1, " ".join(f"w{i}" for i in range(70_000))), (3, "w1 w2 " * 200_000), (4, "w1"), (5, None)]
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    got = {r["doc_id"]: r for r in brown.brown_scores(docs(spark, rows), clustered=50, classes=8).collect()}
    n = {d: len((t or "").split()) + 1 for d, t in rows}
    assert {d: r["n_tokens"] for d, r in got.items()} == n
    assert all(r["train_tokens"] == sum(n[d] for d in n if not held[d]) and r["held_out"] == held[r["doc_id"]] for r in got.values())


def test_brown_empty(spark):
    assert brown.brown_scores(docs(spark).limit(0)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = brown.brown_scores(docs(spark, [(held, "a b")])).collect()[0]
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (3, 0, 0, 0.0)


def test_empty_tables(spark):
    none = docs(spark).limit(0)
    assert substring.substring_dedup(none).count() == substring.strip_repeats(none).count() == 0
    assert simhash.simhash_groups(none).count() == simhash.dedup(none).count() == 0
    assert decontaminate.decontaminate(none, none.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_beyond_the_broadcast_bounds(spark, monkeypatch):
    """What is joined instead of broadcast gives the same rows."""
    rows = corpus()
    df = docs(spark, rows)
    items = spark.createDataFrame([(1, rows[20][1]), (2, "one")], "item_id long, text string")
    pages = spark.createDataFrame([(i, f"http://{'ab' if i % 2 else 'xy'}{i % 5}.{'net/de' if i % 3 else 'com/en'}/{i}") for i in range(60)] + [(90, "http://q.info/x")], "page_id long, url string")

    def results():
        made = (
            substring.substring_dedup(df),
            simhash.dedup(df).select("doc_id", "text"),
            decontaminate.decontaminate(df, items),
            decontaminate.drop_contaminated(df, items),
            mixing.poisson_mix(df, {"s1": 0.5}, total=300),
            url_filter.filter_urls(pages, queries.URL_RULES).withColumn("score", F.round("score", 9)),
        )
        return [by_row(x, *x.columns) for x in made]

    before = results()
    monkeypatch.setattr(common, "MAX_BROADCAST_IDS", -1)
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_BYTES", -1)
    monkeypatch.setattr(mixing, "MAX_BROADCAST_BYTES", -1)
    monkeypatch.setattr(url_filter, "MAX_BROADCAST_ROWS", -1)
    assert results() == before


def test_chosen_texts_are_broadcast_as_few_bitmaps(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(common.F, "broadcast", lambda df, f=F.broadcast: sent.append(df) or f(df))
    docs = spark.range(20_000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("key"), F.col("id").cast("string").alias("text"))
    chosen = docs.where("cast(text as int) % 4 = 0").select("key", F.col("text").alias("rep"))
    got = common.of_some(docs, chosen)
    assert sorted((r["text"], r["rep"]) for r in got.collect()) == sorted((str(i), str(i)) for i in range(0, 20_000, 4))
    assert sent[0].count() <= 8  # before, a row for each of 5,000
    assert common.of_some(docs, chosen.limit(0)).isEmpty() and common.of_some(docs, chosen.limit(1)).count() == 1


def test_driver_collects_garbage_when_a_third_of_its_heap_is_used():
    class Jvm:
        def __init__(self, used):
            self.java, self.lang, self.Runtime, self.System, self.used, self.gcs = self, self, self, self, used, 0

        getRuntime = lambda self: self
        totalMemory = lambda self: self.used + 50
        freeMemory = lambda self: 50
        maxMemory = lambda self: 750

        def gc(self):
            self.gcs += 1

    for used, gcs in ((200, 0), (300, 1)):
        jvm = Jvm(used)
        common.tidy(type("S", (), {"sparkContext": type("C", (), {"_jvm": jvm})}))
        assert jvm.gcs == gcs


def test_size_guesses_of_components_stay_numbers_of_few_digits(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000 + i * 7 % 50, 1000 + i * 11 % 50) for i in range(90)], "a long, b long")
    labels = common.components(edges)
    assert len(str(labels._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 60
    assert {r["component"] for r in labels.where("node <= 200").collect()} == {0}

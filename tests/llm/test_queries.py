import hashlib
import math
import random
from collections import Counter

import brute
import pytest
from parity import check

import corpus_pipeline
from inkloom.llm import queries, toxicity
from inkloom.llm.common import table


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    check(spark, sf_dir, queries.QUERIES[name], queries.ORACLES[name])


@pytest.mark.parametrize("name", [q for q in queries.QUERIES if q not in queries.ORACLES])
def test_query_runs_over_its_table(spark, sf_dir, name):
    source = {"op1": "pages", "op10": "pages", "op7": "embeddings"}.get(name.split("_")[0], "documents")
    assert queries.QUERIES[name](spark, sf_dir).count() == table(spark, sf_dir, source).count()


def test_pipeline(spark, sf_dir):
    """Each stage against its definition, on what the one before it kept."""
    docs = table(spark, sf_dir, "documents")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    columns = docs.columns
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    automaton = lexicon.automaton()
    expected = {d for d, t in rows.items() if toxicity.score(toxicity.fold(t or ""), automaton, lexicon.scale) < 0.3}
    stages = dict(corpus_pipeline.STAGES)
    docs = stages["toxicity"](spark, docs, sf_dir).checkpoint()
    assert {r["doc_id"] for r in docs.collect()} == expected and docs.columns == columns

    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    docs = stages["simhash"](spark, docs, sf_dir).checkpoint()
    after = {r["doc_id"]: r["text"] for r in docs.collect()}
    first = {}
    for d in sorted(before):
        first.setdefault(before[d], d)
    assert docs.columns == columns and len(after) < len(before)
    assert all(first[t] == d for d, t in after.items() if (t or "").strip())  # no exact copy stays beside its first
    for d in set(before) - set(after):  # what goes is close to something
        shingles = lambda t: {tuple(w[i : i + 5]) for w in [brute.WORD.findall(t.translate(brute.LOWER))] for i in range(max(1, len(w) - 4))}
        mine = shingles(before[d])
        assert max(len(mine & s) / len(mine | s) for k, t in before.items() if k != d and t for s in [shingles(t)]) > 0.6

    docs = stages["substring"](spark, docs, sf_dir).checkpoint()
    cut = {x[0]: x for x in brute.substring(list(after.items()), 35)}
    got = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(got) == {d for d, x in cut.items() if x[2] == 0 or x[2] < x[1]} and docs.columns == columns
    assert all(got[d] == after[d] if not cut[d][2] else brute.sha(got[d]) == cut[d][3] for d in got)

    items = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    docs = stages["decontamination"](spark, docs, sf_dir).checkpoint()
    assert {r["doc_id"] for r in docs.collect()} == {x[0] for x in brute.leaks(list(got.items()), items) if not x[-1]}
    kept = {r["doc_id"] for r in docs.collect()}
    out = stages["mixing"](spark, docs, sf_dir)
    sources = {r["doc_id"]: r["source"] for r in docs.collect()}
    assert set(sources) == kept
    assert Counter((r["doc_id"], r["copy"]) for r in out.collect()) == Counter(mixed(sources, queries.MIX_WEIGHTS))


def mixed(sources, weights):
    """(doc_id, copy) of all copies, by the definition of the mix: a Poisson number at a uniform one from a hash."""
    size = Counter(sources.values())
    given = {s: w for s, w in weights.items() if s in size}
    rest = sum(n for s, n in size.items() if s not in given)
    out = []
    for doc, source in sources.items():
        share = given[source] if source in given else max(0.0, 1 - sum(given.values())) * size[source] / rest
        rate = share / (max(1.0, sum(given.values())) if rest else sum(given.values())) * len(sources) / size[source]
        u = int(hashlib.md5(f"42|{doc}".encode()).hexdigest()[:13], 16) / 2**52
        k, p = 0, math.exp(-rate)
        total = p
        while total <= u:
            k += 1
            p *= rate / k
            total += p
        out += [(doc, c) for c in range(1, k + 1)]
    return out


def test_near_copies_by_brute_force(spark, sf_dir):
    """Of the documents, all and only those go that five-word similarity of 0.8 links to one of a smaller id."""
    docs = table(spark, sf_dir, "documents")
    sets = {}
    for r in docs.collect():
        w = brute.WORD.findall((r["text"] or "").translate(brute.LOWER))
        if w:
            sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    ids = sorted(sets)
    roots = brute.groups(len(ids), lambda i, j: min(len(a := sets[ids[i]]), len(b := sets[ids[j]])) >= 0.8 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b))
    gone = {d for d, r in zip(ids, roots) if ids[r] != d}
    got = set(r["doc_id"] for r in docs.collect()) - {r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, sf_dir).collect()}
    assert got <= gone and len(got) >= 0.9 * len(gone) > 0


def folder_of(spark, path, rows):
    """A scale folder whose documents have further columns, of names that operators use."""
    more = "uid long, _uid long, _key string, _kept string, _n int, key int"
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + more
    spark.createDataFrame([(d, t, "en", s, 0, 7, 8, "k", "x", 9, 10) for d, t, s in rows], schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(d, 1, int(d % 9 == 0)) for d, _, _ in rows if d is not None and d < 200], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10 q11"), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_pipeline_on_odd_rows(spark, tmp_path):
    rng = random.Random(2)
    say = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    rows = [(d, say(60) + (" vile nasty vile" if d % 9 == 0 else ""), f"s{d % 3}") for d in range(150)]
    passage, copied = say(60), say(80)
    rows += [(300, f"{say(20)} {passage}", "a"), (301, f"{passage} {say(20)}", "a"), (302, copied, None), (303, copied, "a"), (303, copied, "a"), (None, copied, "b")]
    rows += [(304, "x q1 q2 q3 q4 q5 q6 q7 q8 q9 q10 y", "a"), (305, None, "a"), (305, None, "a"), (306, "", None), (None, None, "a"), (307, "one", "a"), (307, "another text", "a")]
    sf = folder_of(spark, tmp_path / "odd", rows)
    docs = table(spark, sf, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf).checkpoint()
        seen[name] = [(r["doc_id"], r["text"]) for r in docs.collect()]
        assert docs.columns[: len(columns)] == columns and all((r["uid"], r["_key"], r["_n"]) == (7, "k", 9) for r in docs.collect())
    assert {d for d, _ in seen["toxicity"]} == {d for d, _, _ in rows if d is None or d >= 150 or d % 9}
    near = seen["simhash"]
    assert [d for d, t in near if t == copied] == [302] and sum(d == 305 for d, _ in near) == 2 and sum(d == 307 for d, _ in near) == 2 and (None, None) in near
    cut = dict(seen["substring"])
    assert len(cut[300].split()) == len(cut[301].split()) == 20 and cut[302] == copied
    assert 304 in cut and 304 not in dict(seen["decontamination"]) and {305, 306, 307, None} <= {d for d, _ in seen["decontamination"]}
    assert set(seen["mixing"]) <= set(seen["decontamination"])


def test_pipeline_on_empty_tables(spark, tmp_path):
    sf = folder_of(spark, tmp_path / "none", [])
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and "copy" in out.columns
    assert out.count() > 0  # what it is read from stays

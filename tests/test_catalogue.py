import pytest
from parity import check

from inkloom.plans import catalogue


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_equals_its_sql(spark, sf_dir, name):
    check(spark, sf_dir, catalogue.QUERIES[name], catalogue.ORACLES[name])


def test_entry(spark, sf_dir):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_whole_pages_have_all_lines(spark, sf_dir):
    lines = {r["l_orderkey"]: r["count"] for r in spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey").count().collect()}
    got = {r["page"]: r["n"] for r in catalogue.QUERIES["classify_page"](spark, sf_dir).collect()}
    assert got == {page: lines.get(page, 0) for page in got} and set(lines) <= set(got)


def test_whole_captions_have_all_words(spark, sf_dir):
    said = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r["doc_id"]: r["caption"] for r in catalogue.QUERIES["caption_tags"](spark, sf_dir).collect()}
    for d, t in said.items():
        tags = [w for w in dict.fromkeys(t.split(" ")) if w.lower() != "the"]
        assert got[d] == ", ".join(["The", *tags])

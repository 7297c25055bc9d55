"""A corpus from ``documents``: five stages, each read from what the one before it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from inkloom.llm import decontaminate, mixing, simhash, substring, toxicity
from inkloom.llm.common import remove, scratch, shared_folder, table
from inkloom.llm.queries import MIX_WEIGHTS


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learnt from the labelled ones of this input, doesn't take for toxic."""
    return toxicity.drop_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest doc_id, of each group of near copies."""
    return simhash.dedup(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 35 words and more that occur elsewhere."""
    return substring.strip_repeats(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest, repeated by source and shuffled."""
    return mixing.poisson_mix(docs, MIX_WEIGHTS)


STAGES = [("toxicity", toxic), ("simhash", near_copies), ("substring", repeats), ("decontamination", leaks), ("mixing", mix)]

#: SQL cannot express the learnt lexicon nor the near copies; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder.

    Null, empty and blank texts are clean, no copies of anything and without windows, so they stay. Rows are
    copies where their texts are similar, whatever their doc_ids; of a group the smallest doc_id stays, a null one last.
    Columns of any other names pass through. No rows: no rows. A stage's checkpoints, and the table it read, are deleted once its own
    table is written; the last table stays, as the result is read from it.
    """
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
        docs = spark.read.parquet(before)
    return docs

"""Marked blocks in text files: a start line, ``key: value`` fields, an end line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def extract_blocks(files: DataFrame, start: str, end: str, fields: Sequence[str], required: Sequence[str], status: Sequence[str]) -> DataFrame:
    """``(file, block, fields, errors)`` from ``files(file, text)``.

    Fenced code of ``.md`` files is no place for blocks. A block is what stands between a line with ``start`` alone and
    the next ``end``; one without an id, or on one line, is prose. Missing fields and unknown states are errors.
    """
    body = F.when(F.col("file").endswith(".md"), F.regexp_replace("text", r"(?s)```.*?```", "")).otherwise(F.col("text"))
    pattern = rf"(?s)\Q{start}\E[^\n]*\n(.*?)\Q{end}\E"
    found = files.select("file", F.posexplode(F.regexp_extract_all(body, F.lit(pattern), 1)).alias("block", "raw"))
    lines = F.regexp_extract_all("raw", F.lit(rf"(?im)^[ \t#*/>-]*({'|'.join(fields)})[ \t]*:[ \t]*[^\n]*"), 0)
    pair = F.transform(lines, lambda x: F.struct(F.lower(F.regexp_extract(x, rf"(?i)({'|'.join(fields)})[ \t]*:", 1)).alias("k"), F.trim(F.regexp_replace(x, r"^[^:]*:", "")).alias("v")))
    # The last line of a key holds.
    last = pair
    names = F.array_distinct(F.transform(last, lambda p: p["k"]))
    values = F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(F.filter(last, lambda p: p["k"] == n), -1)["v"]))
    found = found.select("file", "block", values.alias("fields")).where(F.map_contains_key("fields", "id"))
    missing = F.transform(F.array_except(F.array(*map(F.lit, required)), F.map_keys("fields")), lambda k: F.concat(F.lit("missing required field: "), k))
    given = F.col("fields")["status"]
    invalid = F.when(given.isNotNull() & ~given.isin(*status), F.array(F.concat(F.lit("invalid status "), given))).otherwise(F.array().cast("array<string>"))
    return found.withColumn("errors", F.concat(missing, invalid))


#: Folders and files that are not looked into, and what is (fixed values).
SKIPPED_FOLDERS = (".venv", ".git", "node_modules", "__pycache__", ".ruff_cache", ".pytest_cache")
SCANNED = ("*.py", "*.md")


def read_tree(spark: SparkSession, root: str, patterns: Sequence[str] = SCANNED, skip: Sequence[str] = SKIPPED_FOLDERS) -> DataFrame:
    """``(file, text)`` of the text files below a folder, but for those in a folder of a name to skip."""
    glob = patterns[0] if len(patterns) == 1 else "{" + ",".join(patterns) + "}"
    rows = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    rows = rows.select(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("file"), F.col("value").alias("text"))
    return rows.where(F.size(F.array_intersect(F.split("file", "/"), F.array(*map(F.lit, skip)))) == 0)


def marker_counts(blocks: DataFrame) -> DataFrame:
    """One row: blocks, and those with errors."""
    return blocks.agg(F.count(F.lit(1)).alias("markers"), F.count_if(F.size("errors") > 0).alias("errored"))


def marker_json(blocks: DataFrame) -> DataFrame:
    """One JSON object a line for each block: file, block and its fields; to be written as text."""
    return blocks.select(F.to_json(F.map_concat(F.create_map(F.lit("file"), F.col("file").cast("string"), F.lit("block"), F.col("block").cast("string")), "fields")).alias("value"))

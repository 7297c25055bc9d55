"""Image folders as DataFrames: ``(path, stem, height, width, data)``, blue, green, red.

Files that cannot be decoded, and empty ones, stay as rows with null pixels, so that a stage can set them aside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.functions import text
from inkloom.operators import pixels

PIXELS = "height int, width int, data binary"


def list_images(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = text.IMAGE_SUFFIXES) -> DataFrame:
    """``(ord, path, length, modified)`` of the image files directly in a folder, numbered by path; a folder that is not
    there has none. Other ``suffixes`` list other files.

    The listing is Hadoop's own, as Spark's binary source leaves out empty files.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(s.getPath().toString(), s.getLen(), s.getModificationTime() / 1000) for s in (fs.listStatus(path) if fs.exists(path) else []) if s.isFile()]
    found = sorted(f for f in found if f[0].rsplit("/", 1)[-1].lstrip(".").lower().endswith(tuple(f".{x}" for x in suffixes)))
    rows = spark.createDataFrame([(i, *f) for i, f in enumerate(found)], "ord bigint, path string, length bigint, modified double")
    return rows.withColumn("modified", F.timestamp_seconds("modified"))


def read_images(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, stem, height, width, data)`` of the images of a folder; those that can't be decoded have null pixels.

    Pixels stay where they are decoded. Only empty files, which the source leaves out, are added from the listing.
    """
    files = list_images(spark, folder)
    if files.isEmpty():
        return spark.createDataFrame([], f"path string, stem string, {PIXELS}")
    raw = spark.read.format("image").option("dropInvalid", False).load(folder).select("image.*")

    def unify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [pixels.from_source(h, w, c, d) for h, w, c, d in zip(pdf["height"], pdf["width"], pdf["nChannels"], pdf["data"])]
            yield pd.DataFrame({"path": pdf["path"], **_columns(got)})

    origin = F.url_decode(F.replace("origin", F.lit("+"), F.lit("%2B")))
    decoded = raw.withColumn("path", F.regexp_replace(origin, "^file:/+", "file:/")).where(text.is_image(F.col("path"))).mapInPandas(unify, f"path string, {PIXELS}")
    empty = files.where("length = 0").select("path", *[F.lit(None).cast(t).alias(c) for c, t in (f.split() for f in PIXELS.split(", "))])
    return decoded.unionByName(empty).select("path", text.stem(F.col("path")).alias("stem"), "height", "width", "data")


def read_bytes(path: str) -> bytes:
    """A file's bytes, on an executor, from any store that Arrow can reach."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    with store.open_input_stream(name) as f:
        return f.read()


def weights(spark: SparkSession, folder: str) -> DataFrame:
    """``(ord, path, length, modified)`` of the trained weights in a folder."""
    return list_images(spark, folder, ("safetensors",)).where(F.endswith("path", F.lit(".safetensors")))


def prompts(spark: SparkSession, path: str | None = None, defaults: tuple[str, ...] = ()) -> list[str]:
    """The lines of a prompt file that are not blank, trimmed, in order; without a file the defaults."""
    if not path:
        return list(defaults)
    rows = spark.read.text(path, wholetext=True).select(F.explode(text.prompts(F.col("value"))).alias("line"))
    return [r["line"] for r in rows.collect()]


def _columns(images: list[np.ndarray | None]) -> dict:
    return {
        "height": pd.array([None if a is None else a.shape[0] for a in images], dtype="Int32"),
        "width": pd.array([None if a is None else a.shape[1] for a in images], dtype="Int32"),
        "data": [None if a is None else a.tobytes() for a in images],
    }


def array_of(height: int, width: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(int(height), int(width), -1)


def vocabulary(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """Tag names in file order and whether each is general (category 0), from ``tag_id, name, category, count``.

    A model's outputs go by position, so the list, of some thousand tags, is read on the driver.
    """
    rows = spark.read.schema("tag_id bigint, name string, category int, count bigint").csv(path, header=True).coalesce(1)
    return [(r["name"], r["category"] == 0) for r in rows.select("name", "category").collect()]


def sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """``(stem, caption)`` of the text files of a folder."""
    rows = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt").select(F.col("_metadata.file_path").alias("path"), "value")
    return rows.select(text.stem(F.col("path")).alias("stem"), F.trim("value").alias("caption"))

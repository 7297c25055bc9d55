"""Files out of rows: image and caption pairs, quarantine notes, configuration, archives."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.operators import pixels
from inkloom.sources.images import array_of, read_bytes


def write_files(rows: DataFrame, folder: str, column: str = "content") -> int:
    """One file for each row of ``rows(name, content)``, by the executors, in any store that Arrow can reach.

    A file is written under another name and then moved, so a task that runs again leaves the same file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))
        store.create_dir(base, recursive=True)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_output_stream(f"{base}/.{name}.part") as out:
                    out.write(content)
                store.move(f"{base}/.{name}.part", f"{base}/{name}")
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    done = rows.select("name", F.col(column).cast("binary")).mapInArrow(write, "n bigint")
    return done.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).collect()[0]["n"]


def png_rows(images: DataFrame, name: str = "stem") -> DataFrame:
    """``(name, content)`` of images with pixels, as PNG files."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(i).to_pylist() for i in range(4)])
            names, files = [], []
            for stem, h, w, data in rows:
                array = array_of(h, w, data)
                names.append(f"{stem}.png")
                files.append(pixels.encode_png(array if array.shape[2] == 3 else array[:, :, 0]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(files, pa.binary())], names=["name", "content"])

    return images.where("data is not null").select(F.col(name).alias("stem"), "height", "width", "data").mapInArrow(encode, "name string, content binary")


def write_dataset(images: DataFrame, folder: str, repeats: int, trigger: str) -> int:
    """The trainer's layout: ``<repeats>_<trigger>/<stem>.png`` and ``.txt``, a caption on one line."""
    target = f"{folder}/{repeats}_{trigger}"
    notes = images.select(F.concat("stem", F.lit(".txt")).alias("name"), F.concat("caption", F.lit("\n")).alias("content"))
    write_files(notes, target)
    return write_files(png_rows(images), target)


def write_quarantine(aside: DataFrame, folder: str) -> int:
    """A ``<stem>.reason.txt`` for each row of ``(stage, stem, reason)``."""
    return write_files(aside.select(F.concat("stem", F.lit(".reason.txt")).alias("name"), F.concat("reason", F.lit("\n")).alias("content")), folder)


def copy_files(paths: DataFrame, folder: str) -> int:
    """Files of ``paths(path)`` under their own names in a folder, by the executors; only paths are shuffled."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"name": [path.rsplit("/", 1)[-1]], "content": pa.array([read_bytes(path)], pa.binary())})

    return write_files(paths.select("path").mapInArrow(read, "name string, content binary"), folder)


def save_uploads(spark: SparkSession, paths: list[str] | None, folder: str) -> int:
    """Copies the image files among ``paths`` to a folder, which is made if need be; others are passed over."""
    from inkloom.functions import text

    make_folder(spark, folder)
    rows = spark.createDataFrame([(p,) for p in paths or []], "path string").where(text.is_image(F.col("path")))
    return copy_files(rows, folder)


def make_folder(spark: SparkSession, folder: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def delete(spark: SparkSession, path: str) -> bool:
    """Deletes a file or a folder in any Hadoop store; whether it was there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def put_text(spark: SparkSession, path: str, content: str) -> None:
    """A small file from the driver, in any Hadoop store."""
    put_bytes(spark, path, content.encode())


def put_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(content))
    out.close()


def zip_folder(folder: str, archive: str) -> str | None:
    """The files directly in a local folder, by name, without hidden ones; None if there are none."""
    files = [p for p in sorted(Path(folder).glob("*")) if p.is_file() and not p.name.startswith(".")] if Path(folder).is_dir() else []
    if not files:
        return None
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in files:
            z.write(p, p.name)
    return archive

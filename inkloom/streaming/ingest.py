"""Streams: new pages since the last run, and a trainer's log as progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inkloom.functions import text

#: Columns of Spark's binary source (fixed values).
BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def new_pages(spark: SparkSession, folder: str, table: str, checkpoint: str) -> StreamingQuery:
    """Append the image files that came since the last call to ``table(path, stem, length, modified, content)``.

    The checkpoint remembers files, so a call that fails half-way is made up for and no file comes twice. The source
    leaves out empty files; a batch read tells of those.
    """
    files = spark.readStream.format("binaryFile").schema(BINARY).load(folder).where(text.is_image(F.col("path")))
    rows = files.select("path", text.stem(F.col("path")).alias("stem"), "length", F.col("modificationTime").alias("modified"), "content")
    return rows.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def progress_of(lines: DataFrame) -> DataFrame:
    """``lines(value)``, a stream or not, with what each says of a training's progress; others go."""
    parsed = lines.withColumn("p", text.training_progress(F.col("value")))
    return parsed.where("p.step is not null or p.epoch is not null").select("value", "p.*")


def watch_log(spark: SparkSession, folder: str, table: str, checkpoint: str) -> StreamingQuery:
    """The progress lines of the log files of a folder, appended to a table."""
    return progress_of(spark.readStream.text(folder)).writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def saved(lines: DataFrame) -> DataFrame:
    """One row: whether a log says that the model was saved."""
    return lines.agg(F.coalesce(F.bool_or(F.contains("value", F.lit("model saved."))), F.lit(False)).alias("saved"))

"""Tables of a scale folder, and cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage by a checkpoint in the folder that executors share, from ``spark.checkpoint.dir``; on one machine,
    where none is set, in a temporary one. A cluster without the setting is an error."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="inkloom-"))
    return df.checkpoint(eager=True)


def unsized(df: DataFrame) -> DataFrame:
    """``materialize``, without the planner's guess of the size. A join's guess is the product of its sides' and a checkpoint
    keeps it, so in a loop of joins its digits double by the step, until such numbers take the driver minutes and its memory."""
    made = materialize(df)
    rdd = made._jdf.queryExecution().logical().rdd()
    return DataFrame(made.sparkSession._jsparkSession.internalCreateDataFrame(rdd, made._jdf.schema(), False), made.sparkSession)

"""Shared parts: shared-folder checkpoints, ASCII folding, distributed connected components."""

from __future__ import annotations

import string
import tempfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``. Only on one machine, where that is unset, a
    temporary one is made, for this context; a cluster without the setting is an error."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="inkloom-"))
    return sc.getCheckpointDir()


#: Checkpoints made within ``scratch``, innermost last.
_made: list[list[DataFrame]] = []


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage by a checkpoint in the shared folder, which survives the loss of executors."""
    shared_folder(df.sparkSession)
    out = df.checkpoint(eager=True)
    if _made:
        _made[-1].append(out)
    tidy(df.sparkSession)
    return out


def unsized(df: DataFrame) -> DataFrame:
    """``materialize``, without the planner's guess of the size. A join's guess is the product of its sides' and a checkpoint
    keeps it, so in a loop of joins its digits double by the step, until such numbers take the driver minutes and its memory."""
    made = materialize(df)
    rdd = made._jdf.queryExecution().logical().rdd()
    return DataFrame(made.sparkSession._jsparkSession.internalCreateDataFrame(rdd, made._jdf.schema(), False), made.sparkSession)


def tidy(spark: SparkSession) -> None:
    """Let the driver collect garbage if over a third of its heap is used. Plans of many steps are garbage soon, but the
    heap grows to its bound before it is collected; and with it go shuffles and broadcasts that nothing refers to."""
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    if heap.totalMemory() - heap.freeMemory() > heap.maxMemory() / 3:
        spark.sparkContext._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the checkpoints that were made within; for work whose result is a written table."""
    _made.append([])
    try:
        yield
    finally:
        for df in _made.pop():
            file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
            if file.isDefined():
                remove(spark, file.get())


def free_name(base: str, columns: Iterable[str]) -> str:
    """``base``, or ``base`` with as many underscores as it takes to be none of ``columns``, case aside."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def text_key(text: Column) -> Column:
    """What a row is known by across jobs: the SHA-256 of its text (null: of the empty one). Numbers of rows would depend
    on how a job splits its input."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


#: Of texts that hold candidates, so many are broadcast at most, as bitmaps of 16 to 32 bits for each; beyond, they are joined.
MAX_BROADCAST_IDS = 1_000_000


def of_some(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``chosen`` with the texts of their keys, one text a key. All other texts are left out before the shuffle, by a
    broadcast of bitmaps of at most ``MAX_BROADCAST_IDS`` hashes of keys, or, beyond it, by the join alone. The few texts
    that share a bit with a chosen one are left out by the join."""
    texts, n = docs.select("key", "text"), chosen.count()
    if n <= MAX_BROADCAST_IDS:
        # Hashes as rows took the driver some 150 MB for a million; a bitmap is a row for 32,768 bits.
        bit = F.pmod(F.xxhash64("key"), F.lit(1 << max(15, (16 * n).bit_length()))).alias("h")
        maps = chosen.select(bit).groupBy(F.bitmap_bucket_number("h").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("map"))
        byte = "cast(conv(hex(substring(map, cast(bitmap_bit_position(h) div 8 as int) + 1, 1)), 16, 10) as int)"
        known = F.expr(f"bitmap_bucket_number(h) = bucket and shiftright({byte}, cast(bitmap_bit_position(h) % 8 as int)) & 1 = 1")
        texts = texts.select("*", bit).join(F.broadcast(maps), known, "left_semi").drop("h")
    return texts.dropDuplicates(["key"]).join(chosen, "key")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Pure ASCII takes the quick path, where ``lower`` does just that."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def hashed_sample(rows: DataFrame, hash_column: str, size: int) -> DataFrame:
    """``size`` of the rows, those of the smallest hashes, or all if there are no more.

    Where there are many more, a first cut by the hash leaves about twice ``size`` rows, so what meets in one task to
    be ordered doesn't grow with the input or its partitions.
    """
    n = rows.count()
    if n > 4 * size:
        rows = rows.where(F.pmod(F.col(hash_column), F.lit(1 << 30)) < int((1 << 30) * 2 * size / n))
    return rows.orderBy(F.pmod(F.col(hash_column), F.lit(1 << 30)), *sorted(rows.columns)).limit(size)


def commonest(counts: DataFrame, size: int) -> DataFrame:
    """Rows ``(..., n)`` of the greatest ``n``, at most ``size``: all that reach a bound found from a small histogram."""
    step = F.floor(F.log2("n") * 64).cast("int").alias("step")
    total, least = 0, None
    for r in sorted(counts.groupBy(step).agg(F.count(F.lit(1)).alias("rows")).collect(), reverse=True):
        total += r["rows"]
        if total > size:
            break
        least = r["step"]
    return counts.where(F.floor(F.log2("n") * 64) >= least) if least is not None else counts.limit(0)


def byte_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8; ``bytes.split`` splits at just these bytes."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """As ``byte_words``, with A-Z lower-cased (``bytes.lower`` leaves all other bytes alone)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges(a, b)``: rows ``(node, component)``, the smallest node reachable.

    Every round hooks each node to the smallest one next to it, follows the hooks to their ends by doubling, and
    contracts the edges to the nodes that are left, so chains of any length go in one round and edges shrink by the
    round. Labels and edges stay distributed; each step is checkpointed. Aggregation is partial before each shuffle
    and the joins are plain equi-joins that AQE can split, so a node with very many edges does not meet in one task.
    No edges: no rows.
    """
    edges = unsized(_sorted(edges))
    labels = None
    while labels is None or not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = unsized(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("to")))
        moving = True
        while moving:
            jump = hook.select(F.col("node").alias("to"), F.col("to").alias("far"))
            far = unsized(hook.join(jump, "to", "left").select("node", "to", F.coalesce("far", "to").alias("far")))
            moving = not far.where("to <> far").isEmpty()
            hook = far.select("node", F.col("far").alias("to"))
        if labels is None:
            labels = hook.withColumnRenamed("to", "component")
        else:
            moved = hook.withColumnRenamed("node", "component")
            labels = unsized(labels.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")))
        ends = [hook.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to")) for c in ("a", "b")]
        edges = unsized(_sorted(edges.join(ends[0], "a").join(ends[1], "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))))
    return labels


def _sorted(edges: DataFrame) -> DataFrame:
    """Each edge once, the smaller end first, no loops."""
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def runs_of(batches, keys):
    """Whole groups of ``keys`` from sorted pandas batches, as one frame and the groups' bounds at a time.

    The rows of a group must stand together in one partition; what is held is a batch and the last group.
    """
    import numpy as np
    import pandas as pd

    held = None
    for pdf in batches:
        held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        if not len(held):
            continue
        change = np.zeros(len(held), bool)
        for k in keys:
            v = held[k].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        starts = np.flatnonzero(change)
        if len(starts):
            yield held.iloc[: starts[-1]], [0, *starts.tolist()]
            held = held.iloc[starts[-1] :].reset_index(drop=True)
    if held is not None and len(held):
        yield held, [0, len(held)]


#: Rows that are Python values at a time; Arrow's own batches hold far more.
FEW = 256
ARROW = {"long": "int64", "int": "int32", "double": "float64", "boolean": "bool_", "string": "string", "binary": "binary"}


def map_column(df: DataFrame, keep: list[str], column: str, start, fields: str) -> DataFrame:
    """Columns ``keep`` as they are, and those that a Python function makes of one column, in Arrow batches.

    ``start()`` is called once a task and gives the function, from a list of values to lists, one for each of
    ``fields`` ("name type, ..."). Ids don't pass through Python, so nulls and large numbers stay exact.
    """
    names, kinds = zip(*[f.strip().split(" ") for f in fields.split(",")])
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)

    def of(batches):
        import pyarrow as pa

        def kind(k):
            return pa.list_(kind(k[6:-1])) if k.startswith("array<") else getattr(pa, ARROW[k])()

        make = start()
        for batch in (b.slice(i, FEW) for b in batches for i in range(0, b.num_rows, FEW)):
            made = make(batch.column(len(keep)).to_pylist())
            arrays = [batch.column(i) for i in range(len(keep))] + [pa.array(list(v), kind(k)) for v, k in zip(made, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *names])

    return df.select(*keep, F.col(column).alias("_column")).mapInArrow(of, f"{kept}, {fields}")

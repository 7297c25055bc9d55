"""Joins, gates and reports around a captioned data set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.functions import text


def first_match(left: DataFrame, right: DataFrame, key: str, order: str, values: Sequence[str]) -> DataFrame:
    """``left`` with ``values`` of the first row, by ``order`` and then the values, of ``right`` that has its key;
    without one, no row.

    The first row is found by aggregation, so the right side is one row a key before the join.
    """
    first = right.groupBy(key).agg(F.min_by(F.struct(*values), F.struct(order, *[v for v in values if v != order])).alias("_first"))
    return left.join(first, key).select(*[left[c] for c in left.columns], *[F.col(f"_first.{v}").alias(v) for v in values])


def with_sidecar(images: DataFrame, notes: DataFrame, key: str, note: str, fallback: Column) -> DataFrame:
    """``images`` with the trimmed text of its sidecar, or a fallback."""
    return images.join(notes.select(key, F.trim(F.col(note).cast("string")).alias("_note")), key, "left").withColumn("caption", F.coalesce("_note", fallback)).drop("_note")


def without(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
    return rows.join(others.select(key), key, "left_anti")


def chosen(files: DataFrame, names: DataFrame) -> DataFrame:
    """Image files whose name is among ``names(name)``; only the last part of a name counts, so none leads elsewhere."""
    wanted = names.select(text.file_name(F.col("name")).alias("_name")).where(text.is_image(F.col("_name"))).distinct()
    return files.join(wanted, text.file_name(files["path"]) == wanted["_name"], "left_semi")


def grid(prompts: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Each prompt with each weight; the weights are a literal array, so nothing is joined."""
    return prompts.withColumn("weight", F.explode(F.array(*[F.lit(float(w)) for w in weights])))


def recaption_result(replies: DataFrame, keys: list[str], order: str, error: str, most: int = 10) -> DataFrame:
    """Written and failed counts, and the first errors in order: all are counted, ``most`` are shown."""
    bad = F.col(error).isNotNull()
    shown = F.slice(F.array_sort(F.collect_list(F.when(bad, F.struct(F.col(order), F.col(error).alias("e"))))), 1, most)
    return replies.groupBy(*keys).agg(F.count_if(bad).alias("failed"), F.count_if(~bad).alias("written"), F.transform(shown, lambda x: x["e"]).alias("errors"))


def gates(captions: DataFrame, keys: list[str], caption: str, trigger: Column, style_words: Sequence[str]) -> DataFrame:
    """Per group: captions, those that don't start with the trigger, and those that name a style."""
    leak = F.col(caption).rlike(r"(?iu)(?<![\p{L}\p{N}_])(" + "|".join(style_words) + r")(?![\p{L}\p{N}_])")
    return captions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.startswith(F.coalesce(caption, F.lit("")), trigger)).alias("not_leading"),
        F.count_if(leak).alias("leaks"),
    )


def readiness(files: DataFrame, keys: list[str], trigger: Column, style_words: Sequence[str], now: Column, mark: str = ".stage_complete", least: int = 20, quiet_minutes: int = 20) -> DataFrame:
    """Whether a data set can be trained on, from its ``files(path, modified, text)``; one row a group.

    It is complete (its mark is there), has ``least`` images or more and as many captions, all of which begin with
    the trigger, and nothing has changed for a while. Captions that name a style are counted but don't decide.
    """
    name, kind = text.file_name(F.col("path")), text.suffix(F.col("path"))
    is_note = kind.eqNullSafe("txt")
    leak = F.col("text").rlike(r"(?iu)(?<![\p{L}\p{N}_])(" + "|".join(style_words) + r")(?![\p{L}\p{N}_])")
    out = files.groupBy(*keys).agg(
        F.bool_or(name == mark).alias("complete"),
        F.count_if(kind.eqNullSafe("png")).alias("images"),
        F.count_if(is_note).alias("captions"),
        F.count_if(is_note & ~F.startswith(F.coalesce("text", F.lit("")), trigger)).alias("not_leading"),
        F.coalesce(F.max("modified") <= now - F.make_dt_interval(mins=F.lit(quiet_minutes)), F.lit(True)).alias("quiet"),
        F.count_if(is_note & leak).alias("leaks"),
    )
    good = F.col("complete") & (F.col("images") >= least) & (F.col("images") == F.col("captions")) & (F.col("not_leading") == 0) & F.col("quiet")
    return out.withColumn("ready", good)


def newest(files: DataFrame, keys: list[str]) -> DataFrame:
    """Of ``files(path, modified)`` the last one by name and the newest by time, of equals the last by name."""
    return files.groupBy(*keys).agg(F.max("path").alias("last"), F.max_by("path", F.struct("modified", "path")).alias("newest"))


def lacking(files: DataFrame, parts: Sequence[str], needle: str, suffix: str = "py") -> DataFrame:
    """Paths of ``files(path, text)`` that lie in one of the folders named ``parts`` and lack ``needle``."""
    inside = F.size(F.array_intersect(F.split("path", "/"), F.array(*map(F.lit, parts)))) > 0
    mine = inside & (text.suffix(F.col("path")) == suffix) & (text.file_name(F.col("path")) != f"__init__.{suffix}")
    return files.where(mine & ~F.contains(F.coalesce("text", F.lit("")), F.lit(needle))).select("path")


def run_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(label, n)``, labels padded to the widest."""
    wide = max(map(len, tables), default=0)
    parts = [t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label.ljust(wide)).alias("label"), "n") for label, t in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def clean_report(survivors: DataFrame, total: DataFrame, short_side: Column, min_side: int, target: int) -> DataFrame:
    """Counts of a cleaning run and its line: duplicates go before the size is looked at."""
    kept = short_side >= min_side
    counts = survivors.agg(
        F.count(F.lit(1)).alias("unique_rows"),
        F.count_if(kept).alias("kept"),
        F.count_if(~kept).alias("dropped_small"),
        F.count_if(kept & (short_side < target)).alias("upscaled"),
    )
    out = counts.crossJoin(total.agg(F.count(F.lit(1)).alias("rows"))).withColumn("deduped", F.col("rows") - F.col("unique_rows"))
    line = F.format_string("clean: kept %d, deduped %d, dropped-small %d, upscaled %d", "kept", "deduped", "dropped_small", "upscaled")
    return out.select("kept", "deduped", "dropped_small", "upscaled", line.alias("line"))


def all_good(checks: DataFrame) -> DataFrame:
    """One row: whether every check of ``checks(name, ok, detail)`` holds (none: yes), and the widest name."""
    return checks.agg(F.coalesce(F.every("ok"), F.lit(True)).alias("ok"), F.coalesce(F.max(F.char_length("name")), F.lit(0)).alias("width"))


def composite(original: Column, painted: Column, mask: Column, bound: int = 127) -> Column:
    """Element by element: painted where the mask is above the bound, else the original."""
    return F.transform(F.arrays_zip(original.alias("o"), painted.alias("p"), mask.alias("m")), lambda r: F.when(r["m"] > bound, r["p"]).otherwise(r["o"]))

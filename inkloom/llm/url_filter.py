"""Operator 1: URL filters by rules and a character language-model ratio (native)."""

from __future__ import annotations

import string
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

#: Parts of the labelled URLs; each is scored by models of all other parts, to find the bound.
FOLDS = 5
#: Context length, and the weight of the next shorter context in each smoothed probability.
ORDER = 3
CONCENTRATION = 4.0
#: Rows of the model that are broadcast at most (about 60 bytes each); a larger one is joined by shuffles.
MAX_BROADCAST_ROWS = 1_000_000
ALPHABET = 256.0
MAX_RULES = 1000

Rule = tuple[str, str]


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    return F.translate(F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """``(rule, verdict)`` of the longest rule that fits, else null. A rule is (verdict, ``host/path``)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block", r[1])):
        name, slash, rest = rule.partition("/")
        name = name.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _padded(url: Column) -> Column:
    return F.concat(F.lit("\x02" * ORDER), url)


def _grams(rows: DataFrame, key: str) -> DataFrame:
    """Each character's place in ``url`` (``at``, from 1); an empty URL has none, but stays as a row."""
    return rows.withColumn(key, _padded(F.col("url"))).withColumn("at", F.explode_outer(F.when(F.char_length("url") > 0, F.sequence(F.lit(1), F.char_length("url")))))


def fit(labelled: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The two models as one table ``(gram, ratio, escape)``, from ``labelled(url, accepted)``; with columns ``by``, such
    models for each of their values.

    For a character after a context, both models give n(context, character) + C * p(character after the context
    without its first letter), over n(context) + C; the shortest context falls back on a uniform alphabet. ``ratio``
    is the log of accepted over rejected for a gram (context and character) that either model has seen. A gram that
    neither has seen has the ratio of its ending, plus ``escape`` of its context, as the n(context) differ.
    """
    spots = _grams(labelled, "p")
    counts = None
    for k in range(ORDER + 1):
        gram = F.substr("p", F.col("at") + F.lit(ORDER - k), F.lit(k + 1))
        part = spots.select(gram.alias("gram"), F.lit(k).alias("k"), "accepted", *by).where("gram is not null")
        counts = part if counts is None else counts.unionByName(part)
    yes = F.count_if(F.col("accepted")).alias("a")
    counts = materialize(counts.groupBy(*by, "k", "gram").agg(yes, F.count_if(~F.col("accepted")).alias("r")))
    contexts = counts.select(*by, "k", F.expr("substr(gram, 1, k)").alias("context"), "a", "r").groupBy(*by, "k", "context").agg(F.sum("a").alias("na"), F.sum("r").alias("nr"))
    c = F.lit(CONCENTRATION)
    level, levels = None, []
    for k in range(ORDER + 1):
        own = counts.where(F.col("k") == k).select(*by, "gram", "a", "r", F.expr("substr(gram, 1, k)").alias("context"))
        own = own.join(contexts.where(F.col("k") == k).drop("k"), [*by, "context"])
        if level is None:
            own = own.withColumn("pa", F.lit(1 / ALPHABET)).withColumn("pr", F.lit(1 / ALPHABET))
        else:
            own = own.withColumn("_g", F.expr("substr(gram, 2)")).join(level.select(*by, F.col("gram").alias("_g"), "pa", "pr"), [*by, "_g"]).drop("_g")
        level = materialize(own.select(*by, "gram", ((F.col("a") + c * F.col("pa")) / (F.col("na") + c)).alias("pa"), ((F.col("r") + c * F.col("pr")) / (F.col("nr") + c)).alias("pr")))
        levels.append(level)
    ratios = reduce(DataFrame.unionByName, levels).select(*by, "gram", F.log(F.col("pa") / F.col("pr")).alias("ratio"))
    escapes = contexts.select(*by, F.col("context").alias("gram"), F.log((F.col("nr") + c) / (F.col("na") + c)).alias("escape"))
    return materialize(ratios.join(escapes, [*by, "gram"], "full").groupBy(*by, "gram").agg(F.max("ratio").alias("ratio"), F.max("escape").alias("escape")))


def ratio(rows: DataFrame, model: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``rows(url, ...)`` with ``score``: the mean log-likelihood ratio per character, zero for an empty URL. Columns ``by``
    name the models of a row.

    Each character is looked up with its contexts of all lengths in the broadcast model; the sum by URL is
    pre-aggregated where the URL is read, so one row per URL is shuffled.
    """
    small = model.count() <= MAX_BROADCAST_ROWS
    keys = list(rows.columns)
    out = _grams(rows, "_p")
    for k in range(ORDER + 1):
        for gram, of, letters in (("g", "ratio", k + 1), ("c", "escape", k)):
            look = model.select(*by, F.col("gram").alias(f"_{gram}{k}"), F.col(of).alias(f"_{of[0]}{k}")).where(f"_{of[0]}{k} is not null")
            out = out.withColumn(f"_{gram}{k}", F.substr("_p", F.col("at") + F.lit(ORDER - k), F.lit(letters)))
            out = out.join(F.broadcast(look) if small else look, [*by, f"_{gram}{k}"], "left")
    value = F.lit(0.0)
    for k in range(ORDER + 1):
        value = F.when(F.col(f"_r{k}").isNotNull(), F.col(f"_r{k}")).otherwise(value + F.coalesce(F.col(f"_e{k}"), F.lit(0.0)))
    return out.groupBy(*keys).agg(F.coalesce(F.avg(F.when(F.col("at").isNotNull(), value)), F.lit(0.0)).alias("score"))


def calibrate(scored: DataFrame) -> float | None:
    """The score that best tells ``scored(score, accepted)`` apart: accepted at or above it, rejected below.

    The mid-point below the score with the greatest sum of both rates; of equals the lowest. Null if a class is missing.
    Sums run within ranges of scores, from the sums of the ranges below, so no task holds all scores.
    """
    grouped = scored.groupBy("score").agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r"))
    ranged = materialize(grouped.repartitionByRange("score").withColumn("part", F.spark_partition_id()))
    parts = ranged.groupBy("part").agg(F.sum("a").alias("a"), F.sum("r").alias("r"), F.max("score").alias("top")).orderBy("part").collect()
    na, nr = sum(p["a"] for p in parts), sum(p["r"] for p in parts)
    if not na or not nr:
        return None
    a, r, top, starts = 0, 0, None, []
    for p in parts:
        starts.append((p["part"], a, r, top))
        a, r, top = a + p["a"], r + p["r"], p["top"]
    starts = scored.sparkSession.createDataFrame(starts, "part int, sa long, sr long, top double")
    within = Window.partitionBy("part").orderBy("score")
    below = within.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranged.join(F.broadcast(starts), "part").select(
        "score",
        F.coalesce(F.lag("score").over(within), "top", "score").alias("prior"),
        (F.col("sa") + F.coalesce(F.sum("a").over(below), F.lit(0))).alias("la"),
        (F.col("sr") + F.coalesce(F.sum("r").over(below), F.lit(0))).alias("lr"),
    )
    gain = (F.col("lr").cast("decimal(19,0)") * F.lit(na).cast("decimal(19,0)") - F.col("la").cast("decimal(19,0)") * F.lit(nr).cast("decimal(19,0)")).desc()
    return ranked.orderBy(gain, "score").select(((F.col("score") + F.col("prior")) / 2).alias("t")).first()["t"]


def filter_urls(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)`` for each row of ``pages(page_id, url)``; other columns are ignored.

    The longest rule that fits the host (or a parent domain) and starts the path decides. URLs that rules decide are
    the labelled ones: character models of accepted and rejected URLs are fitted on all of them. The bound on the
    length-normalised log ratio is calibrated on all of them too, each scored by models of the four fifths (by a hash of
    the URL) that it isn't in. All other URLs are judged by that. A null URL, or one without ``://``, has an empty host and path, no
    rule, and the method's verdict on its text; an empty text scores zero and is allowed. If there are no accepted or
    no rejected URLs to learn from, the method allows. Repeated rows and null ids stay. No rows: no rows.
    """
    urls = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.monotonically_increasing_id().alias("uid"))
    urls = urls.select("uid", "page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = urls.withColumn("_m", match_rule(F.col("host"), F.col("path"), rules)).select("uid", "page_id", "url", "host", "path", F.col("_m.rule").alias("rule"), F.col("_m.verdict").alias("given"))
    known = materialize(urls.where(F.col("given").isNotNull()).select("uid", "url", (F.col("given") == "allow").alias("accepted"), F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int").alias("fold")))
    model = fit(known.select("url", "accepted"))
    others = known.select("url", "accepted", F.explode(F.array_remove(F.array(*map(F.lit, range(FOLDS))), F.col("fold"))).alias("fold"))
    bound = calibrate(ratio(known, fit(others, ["fold"]), ["fold"]))
    scored = ratio(urls, model)
    judged = F.lit("allow") if bound is None else F.when((F.col("score") >= bound) | (F.col("url") == ""), "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("given", judged).alias("verdict"), "score")

"""Pages to panels: boxes trimmed, filtered, ordered and numbered; pages set aside with a reason; content spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkloom.functions import geometry
from inkloom.settings import Settings


def panel_boxes(boxes: DataFrame, settings: Settings) -> DataFrame:
    """``(page, idx, x, y, w, h)`` from ``boxes(page, box_no, x, y, w, h, page_w, page_h)``.

    Boxes are cut to the page and trimmed, those below the least area go, the rest are numbered from zero in reading
    order: by y, then x, ties by box_no.
    """
    b = geometry.shrink_box(geometry.box(*map(F.col, "xywh")), settings.panel_border, F.col("page_w"), F.col("page_h"))
    trimmed = boxes.select("page", "box_no", b.alias("b")).where(F.col("b").isNotNull() & (geometry.area(F.col("b")) >= settings.min_panel_area))
    order = Window.partitionBy("page").orderBy("b.y", "b.x", "box_no")
    return trimmed.select("page", (F.row_number().over(order) - 1).alias("idx"), "b.*")


def classify_pages(pages: DataFrame, boxes: DataFrame, settings: Settings) -> DataFrame:
    """``(page, n, reason)`` of every page of ``pages(page, page_w, page_h)``; pages without boxes have a reason too."""
    found = boxes.groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("w") * F.col("h")).alias("largest"))
    n = F.coalesce("n", F.lit(0))
    reason = geometry.page_reason(n, F.col("largest"), F.col("page_w") * F.col("page_h"), settings.max_panels, settings.splash_area_ratio)
    return pages.join(found, "page", "left").select("page", n.alias("n"), reason.alias("reason"))


def route(rows: DataFrame, stage: str, key: str = "page") -> tuple[DataFrame, DataFrame]:
    """Rows without a reason, and the others as quarantine ``(stage, stem, reason)``."""
    aside = rows.where("reason is not null").select(F.lit(stage).alias("stage"), F.col(key).cast("string").alias("stem"), "reason")
    return rows.where("reason is null").drop("reason"), aside


def content_spans(axis: DataFrame, keys: list[str], min_run: int, min_side: int) -> DataFrame:
    """Half-open spans ``(*keys, start, stop)`` of the content places ``axis(*keys, i)``.

    A gap of at least ``min_run`` between places ends a span; shorter gaps are thin lines and belong to it. Spans
    shorter than ``min_side`` go.
    """
    order = Window.partitionBy(*keys).orderBy("i")
    new = F.coalesce((F.col("i") - F.lag("i").over(order) - 1 >= min_run).cast("int"), F.lit(0))
    numbered = axis.withColumn("new", new).withColumn("span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = numbered.groupBy(*keys, "span").agg(F.min("i").alias("start"), (F.max("i") + 1).alias("stop"))
    return spans.where(F.col("stop") - F.col("start") >= min_side).drop("span")


#: Grid rows of a page, in words, that are aggregated as columns of one row; of larger grids each is a row.
WIDE = 64


def mask_rows(boxes: DataFrame, step: int, page_w: int, page_h: int) -> DataFrame:
    """The union of a page's boxes ``(page, x, y, w, h)`` on a grid: ``(page, gy, word, bits)``, 64 cells a word.

    A cell is set if its corner lies in a box. Boxes are dealt by page, which is all that is shuffled; each grid row of a
    box is a few words of bits, joined by ``bit_or`` where the page's boxes are, so neither cells nor overlaps are ever rows.
    """

    def span(low: str, size: str, limit: int):
        first = F.greatest(F.lit(0), F.ceil(F.col(low) / step)).cast("int")
        return first, F.least(F.lit(limit // step - 1), F.ceil((F.col(low) + F.col(size)) / step) - 1).cast("int")

    def bits(word) -> Column:
        return F.expr(f"shiftleft(-1L, cast(greatest(a - {word} * 64, 0) as int)) & shiftrightunsigned(-1L, cast(63 - least(b - {word} * 64, 63) as int))")

    (a, b), (c, d) = span("x", "w", page_w), span("y", "h", page_h)
    cut = boxes.select("page", a.alias("a"), b.alias("b"), c.alias("c"), d.alias("d")).where("a <= b and c <= d").repartition("page")
    places = [(gy, word) for gy in range(page_h // step) for word in range(-(-(page_w // step) // 64))] if page_h // step <= WIDE else []
    if 0 < len(places) <= WIDE:
        here = [F.bit_or(F.when(F.expr(f"{gy} between c and d and {word} between a div 64 and b div 64"), bits(word))) for gy, word in places]
        rows = [F.struct(F.lit(gy).alias("gy"), F.lit(word).alias("word"), F.col(f"_{n}").alias("bits")) for n, (gy, word) in enumerate(places)]
        return cut.groupBy("page").agg(*[v.alias(f"_{n}") for n, v in enumerate(here)]).select("page", F.inline(F.array(*rows))).where("bits is not null")
    rows = cut.withColumn("word", F.explode(F.expr("sequence(a div 64, b div 64)"))).withColumn("gy", F.explode(F.sequence("c", "d")))
    return rows.select("page", "gy", F.col("word").cast("int").alias("word"), bits("word").alias("bits")).groupBy("page", "gy", "word").agg(F.bit_or("bits").alias("bits"))


def coverage(rows: DataFrame, total: int) -> DataFrame:
    """Set cells, and their share, for each page of ``mask_rows``; no cells in all: zero."""
    counted = rows.groupBy("page").agg(F.sum(F.bit_count("bits")).alias("cells"))
    return counted.select("page", "cells", F.coalesce(F.try_divide("cells", F.lit(total)), F.lit(0.0)).alias("coverage"))

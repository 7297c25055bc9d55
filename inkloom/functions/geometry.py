"""Boxes, masks and sizes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h"))


def shrink_box(b: Column, border: int, page_w: Column, page_h: Column) -> Column:
    """The part of a box on its page, less a border on each side; null if nothing is left."""

    def side(low: Column, size: Column, page: Column) -> tuple[Column, Column]:
        start = F.greatest(low, F.lit(0)) + border
        return start, F.least(low + size, page) - border - start

    (left, width), (top, height) = side(b["x"], b["w"], page_w), side(b["y"], b["h"], page_h)
    return F.when((width > 0) & (height > 0), box(left, top, width, height))


def area(b: Column) -> Column:
    return b["w"] * b["h"]


def page_reason(count: Column, largest: Column, page_area: Column, max_panels: int, splash_ratio: float) -> Column:
    """Why a page is set aside, or null: no boxes, too many, or a lone one that covers the page."""
    many = F.concat(F.lit("too many panels ("), count.cast("string"), F.lit(f" > {max_panels})"))
    splash = (count == 1) & (page_area > 0) & (largest >= page_area * splash_ratio)
    return F.when(count == 0, "no panels detected").when(count > max_panels, many).when(splash, "splash page (single full-page panel)")


def percent(ratio: Column) -> Column:
    """Whole per cents, halves to the even number."""
    return F.concat(F.bround(ratio * 100, 0).cast("bigint").cast("string"), F.lit("%"))


def mask_reason(coverage: Column, most: float) -> Column:
    """Why a mask is set aside, or null: it covers more than ``most``."""
    return F.when(coverage > most, F.concat(F.lit("excessive mask coverage ("), percent(coverage), F.lit(" > "), percent(F.lit(most)), F.lit(")")))


def upscaled(width: Column, height: Column, target: int) -> Column:
    """Size with a short side of ``target``, halves to the even number; one that is large enough stays."""
    scale = F.lit(float(target)) / F.least(width, height)
    large = F.least(width, height) >= target
    grown = [F.when(large, v.cast("bigint")).otherwise(F.bround(v * scale, 0).cast("bigint")) for v in (width, height)]
    return F.struct(grown[0].alias("width"), grown[1].alias("height"))


def sorted_corners(b: Column) -> Column:
    """Corners with the smaller first."""
    return F.struct(*[f(b[p], b[q]).alias(n) for f, p, q, n in ((F.least, "x1", "x2", "x1"), (F.least, "y1", "y2", "y1"), (F.greatest, "x1", "x2", "x2"), (F.greatest, "y1", "y2", "y2"))])


def at_least(value: Column, least: int) -> Column:
    """A number cut to a whole one, and raised to the least allowed."""
    return F.greatest(F.lit(least), value.cast("int"))

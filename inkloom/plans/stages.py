"""The stages: pages to panels to masks to painted panels to a clean, captioned set.

Each takes DataFrames and gives ``(output, quarantine)``; nothing is written here. Detectors, painters and taggers are
plain callables that run inside Arrow batches, so tests pass their own. Pixels are shuffled where they are joined by
stem with crops, masks or what stays; boxes, paths and hashes go alone otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.functions import geometry, text
from inkloom.operators import dedup, panels, pixels
from inkloom.settings import Settings
from inkloom.sources.images import PIXELS, array_of, list_images, read_bytes
from inkloom.sources.tables import materialize

Boxes = Sequence[tuple[int, int, int, int]]
NONE_ASIDE = "stage string, stem string, reason string"


def _aside(rows: DataFrame, stage: str, reason) -> DataFrame:
    return rows.select(F.lit(stage).alias("stage"), "stem", reason.alias("reason"))


def panels_stage(pages: DataFrame, settings: Settings, detect: Callable[[np.ndarray, bool], Boxes] = pixels.detect_panels) -> tuple[DataFrame, DataFrame]:
    """``(stem, page_stem, idx, height, width, data)``: a page's panels in reading order, ``<page>_<idx, two digits>``."""
    resplit = settings.panel_resplit

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(s, w, h, i, *map(int, b)) for s, h, w, d in zip(pdf["stem"], pdf["height"], pdf["width"], pdf["data"]) for i, b in enumerate(detect(array_of(h, w, d), resplit))]
            yield pd.DataFrame(rows, columns=["page", "page_w", "page_h", "box_no", *"xywh"])

    good = pages.where("data is not null")
    # Written once, so that a detector sees each page once and both outputs agree.
    raw = materialize(good.select("stem", "height", "width", "data").mapInPandas(find, "page string, page_w int, page_h int, box_no int, x int, y int, w int, h int"))
    boxes = panels.panel_boxes(raw, settings)
    sizes = good.select(F.col("stem").alias("page"), F.col("width").alias("page_w"), F.col("height").alias("page_h"))
    judged = panels.classify_pages(sizes, boxes, settings)
    kept, aside = panels.route(judged, "panels")
    cuts = boxes.join(kept.select("page"), "page", "left_semi").groupBy("page").agg(F.sort_array(F.collect_list(F.struct("idx", "x", "y", "w", "h"))).alias("cuts"))

    def crop(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for s, h, w, d, cut in zip(pdf["stem"], pdf["height"], pdf["width"], pdf["data"], pdf["cuts"]):
                page = array_of(h, w, d)
                rows += [(f"{s}_{c['idx']:02d}", s, c["idx"], c["h"], c["w"], page[c["y"] : c["y"] + c["h"], c["x"] : c["x"] + c["w"]].tobytes()) for c in cut]
            yield pd.DataFrame(rows, columns=["stem", "page_stem", "idx", "height", "width", "data"])

    out = good.join(cuts, good["stem"] == cuts["page"]).select("stem", "height", "width", "data", "cuts").mapInPandas(crop, f"stem string, page_stem string, idx int, {PIXELS}")
    return out, aside.unionByName(_aside(pages.where("data is null"), "panels", F.lit("unreadable page")))


def bubbles_stage(images: DataFrame, settings: Settings, bubbles: Callable[[np.ndarray], Sequence[Sequence[tuple[int, int]]]], lettering: Callable[[np.ndarray], Boxes]) -> tuple[DataFrame, DataFrame]:
    """``(stem, width, height, bits, coverage)``: masks of bubbles (polygons) and lettering (x1, y1, x2, y2), grown."""
    radius = settings.mask_dilation_px

    def mask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for s, h, w, d in zip(pdf["stem"], pdf["height"], pdf["width"], pdf["data"]):
                image = array_of(h, w, d)
                parts = [pixels.polygons_mask(bubbles(image), w, h), pixels.boxes_mask(lettering(image), w, h)]
                grown = pixels.dilate(pixels.union(parts, w, h), radius)
                rows.append((s, w, h, grown.tobytes(), pixels.coverage(grown)))
            yield pd.DataFrame(rows, columns=["stem", "width", "height", "bits", "coverage"])

    made = materialize(images.where("data is not null").select("stem", "height", "width", "data").mapInPandas(mask, "stem string, width int, height int, bits binary, coverage double"))
    judged = made.withColumn("reason", geometry.mask_reason(F.col("coverage"), settings.max_mask_coverage))
    kept, aside = panels.route(judged, "bubbles", "stem")
    return kept, aside.unionByName(_aside(images.where("data is null"), "bubbles", F.lit("unreadable panel")))


def flat_fill(image: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """A painter without a model: masked places take the mean colour of the others."""
    off = mask <= pixels.MASK_ON
    return np.broadcast_to(np.rint(image[off].mean(axis=0) if off.any() else np.full(3, 255)).astype(np.uint8), image.shape)


#: Painters by name.
PAINTERS: dict[str, Callable[[np.ndarray, np.ndarray], np.ndarray]] = {"flat": flat_fill}


def backend(table: dict, name: str, what: str):
    """The entry of a name, in any case and with blanks; an unknown name fails before any row is read."""
    got = table.get(name.strip().lower())
    if got is None:
        raise ValueError(f"unknown {what} {name!r}; there are: {', '.join(sorted(table)) or 'none'}")
    return got


def inpaint_stage(images: DataFrame, masks: DataFrame, paint: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[DataFrame, DataFrame]:
    """``(stem, height, width, data)``: panels that have a mask, painted where it is set.

    Of several panels of one stem the first by path counts. Empty masks never reach the painter.
    """
    first = images
    if "path" in images.columns:  # paths alone are compared
        first = images.join(images.groupBy("stem").agg(F.min("path").alias("path")).select("path"), "path", "left_semi")
    both = first.select("stem", "height", "width", "data").where("data is not null").join(masks.select("stem", "bits", "coverage"), "stem")

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = []
            for h, w, d, b in zip(pdf["height"], pdf["width"], pdf["data"], pdf["bits"]):
                image, mask = array_of(h, w, d), np.frombuffer(b, np.uint8).reshape(h, w)
                done.append(pixels.composite(image, paint(image, mask), mask).astype(np.uint8).tobytes())
            yield pd.DataFrame({"stem": pdf["stem"], "height": pdf["height"], "width": pdf["width"], "data": done})

    painted = both.where("coverage > 0").drop("coverage").mapInPandas(fill, f"stem string, {PIXELS}")
    out = both.where("coverage = 0").select("stem", "height", "width", "data").unionByName(painted)
    return out, images.sparkSession.createDataFrame([], NONE_ASIDE)


def clean_stage(images: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """``(stem, phash, height, width, data, upscaled)``: near-duplicates go, then small images are set aside, the
    others brought to size. Only hashes and sizes take part in the search; pixels are joined for those that stay."""
    good = images.where("data is not null")

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"stem": pdf["stem"], "h": [pixels.phash(array_of(h, w, d)) for h, w, d in zip(pdf["height"], pdf["width"], pdf["data"])]})

    hashes = good.select("stem", "height", "width", "data").mapInPandas(hashed, "stem string, h bigint")
    # Numbered by stem: positions within range partitions, offset by the rows before each, so no task sees all rows.
    ordered = dedup.materialize(hashes.orderBy("stem").withColumn("k", F.monotonically_increasing_id()))
    numbered = ordered.select("stem", "h", F.col("k").alias("ord"))
    kept = materialize(dedup.greedy_dedup(numbered.select("ord", "h"), settings.dedup_hamming_distance).join(numbered.select("ord", "stem"), "ord"))
    survivors = good.select("stem", "height", "width", "data").join(kept.select("stem", F.col("h").alias("phash")), "stem")
    small = F.least("height", "width") < settings.min_side_px
    target, smooth = settings.target_side, pixels.denoise if settings.clean_denoise else (lambda image: image)

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [pixels.upscale(smooth(array_of(h, w, d)), target) for h, w, d in zip(pdf["height"], pdf["width"], pdf["data"])]
            grown = [a.shape[0] != h or a.shape[1] != w for a, h, w in zip(got, pdf["height"], pdf["width"])]
            yield pd.DataFrame({"stem": pdf["stem"], "phash": pdf["phash"], "height": [a.shape[0] for a in got], "width": [a.shape[1] for a in got], "data": [a.tobytes() for a in got], "upscaled": grown})

    out = survivors.where(~small).select("stem", "phash", "height", "width", "data").mapInPandas(grow, f"stem string, phash bigint, {PIXELS}, upscaled boolean")
    return out, _aside(survivors.where(small), "clean", F.lit("too small after inpaint"))


def caption_stage(images: DataFrame, settings: Settings, tag: Callable[[np.ndarray], Sequence[float]], vocabulary: Sequence[tuple[str, bool]]) -> tuple[DataFrame, DataFrame]:
    """``(stem, height, width, data, caption)``; ``tag`` gives a probability for each entry of the vocabulary."""

    def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(p=[[float(v) for v in tag(array_of(h, w, d))] for h, w, d in zip(pdf["height"], pdf["width"], pdf["data"])])

    rated = images.where("data is not null").select("stem", "height", "width", "data").mapInPandas(rate, f"stem string, {PIXELS}, p array<double>")
    names, general = F.array(*[F.lit(n) for n, _ in vocabulary]), F.array(*[F.lit(g) for _, g in vocabulary])
    tags = text.select_tags(F.col("p"), names, general, settings.caption_threshold)
    same = F.assert_true(F.size("p") == len(vocabulary), F.lit("one probability a tag is needed"))
    out = rated.select("stem", "height", "width", "data", F.coalesce(same.cast("string"), text.build_caption(F.lit(settings.trigger_token), tags)).alias("caption"))
    return out, images.sparkSession.createDataFrame([], NONE_ASIDE)


def promote(aside: DataFrame, names: DataFrame, settings: Settings) -> DataFrame:
    """Chosen quarantined images ``(path, stem, height, width, data)``, brought to size; neither deduplicated nor
    measured against the least size."""
    from inkloom.operators.dataset import chosen

    target, smooth = settings.target_side, pixels.denoise if settings.clean_denoise else (lambda image: image)

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [pixels.upscale(smooth(array_of(h, w, d)), target) for h, w, d in zip(pdf["height"], pdf["width"], pdf["data"])]
            yield pd.DataFrame({"stem": pdf["stem"], "height": [a.shape[0] for a in got], "width": [a.shape[1] for a in got], "data": [a.tobytes() for a in got]})

    return chosen(aside, names).where("data is not null").select("stem", "height", "width", "data").mapInPandas(grow, f"stem string, {PIXELS}")


def model_inputs(run: Callable[[np.ndarray, np.ndarray], np.ndarray], size: tuple[int, int]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A painter from a model that takes square inputs of ``size`` (width, height): letterboxed, run, and undone."""

    def paint(image: np.ndarray, mask: np.ndarray) -> np.ndarray:
        small, on, undo = pixels.letterbox(image, mask, *size)
        return pixels.unletterbox(run(small, on), undo)

    return paint


def input_size(shape: Sequence, default: int = 512) -> tuple[int, int]:
    """Width and height that a model asks for, by its input's shape (n, channels, height, width); what it leaves open is
    the default."""
    height, width = (n if isinstance(n, int) and n > 0 else default for n in list(shape)[2:4])
    return width, height


def tagger(run: Callable[[np.ndarray], Sequence], size: int = 448) -> Callable[[np.ndarray], list[float]]:
    """A tagger from a model that takes 1 x size x size x 3 floats."""
    return lambda image: [float(v) for v in np.ravel(run(pixels.tagger_input(image, size)))]


def lettering_boxes(read: Callable[[np.ndarray], tuple[Sequence, Sequence]]) -> Callable[[np.ndarray], Boxes]:
    """A detector of x1, y1, x2, y2 boxes from a reader that gives upright boxes as (x1, x2, y1, y2) and slanted ones as
    four points, of which the box around them counts."""

    def find(image: np.ndarray) -> Boxes:
        upright, slanted = read(image)
        boxes = [(int(a), int(c), int(b), int(d)) for a, b, c, d in upright]
        return boxes + [(int(min(x for x, _ in q)), int(min(y for _, y in q)), int(max(x for x, _ in q)), int(max(y for _, y in q))) for q in slanted]

    return find


def overlays(images: DataFrame, masks: DataFrame) -> DataFrame:
    """``(stem, height, width, data)``: panels with their masks tinted, to look at."""
    both = images.where("data is not null").select("stem", "height", "width", "data").join(masks.select("stem", "bits"), "stem")

    def tint(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = [pixels.overlay(array_of(h, w, d), np.frombuffer(b, np.uint8).reshape(h, w)).tobytes() for h, w, d, b in zip(pdf["height"], pdf["width"], pdf["data"], pdf["bits"])]
            yield pd.DataFrame({"stem": pdf["stem"], "height": pdf["height"], "width": pdf["width"], "data": done})

    return both.mapInPandas(tint, f"stem string, {PIXELS}")


def _asked(ask: Callable[[bytes], dict], retries: int, pause: float) -> Callable[[bytes], tuple[str, str | None]]:
    """Caption and error for an image's bytes; a call that raises, or fails in a way that may pass, is made again after a
    growing pause."""

    def call(image: bytes) -> tuple[str, str | None]:
        import time

        error, said = "not_run", ""
        for attempt in range(max(1, retries)):
            try:
                reply = ask(image)
                error, said = str(reply.get("error") or ""), str(reply.get("caption") or "")
            except Exception:  # a service may fail in any way; all are tried again
                error, said = "exception", ""
            if not text.may_pass(error):
                break
            if attempt < retries - 1:
                time.sleep(pause * (attempt + 1))
        return said, error or (None if said.strip() else "empty_caption")

    return call


def recaption(images: DataFrame, ask: Callable[[bytes], dict], trigger: str, retries: int = 5, pause: float = 2.0, concurrency: int = 8) -> DataFrame:
    """``(stem, caption, error)``: captions from a service, ``concurrency`` calls at a time in all.

    A call that raises, or fails in a way that may pass, is made again after a growing pause; an empty caption is not.
    """
    asked = _asked(ask, retries, pause)

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(stem, *asked(pixels.encode_png(array_of(h, w, d)))) for stem, h, w, d in zip(pdf["stem"], pdf["height"], pdf["width"], pdf["data"])]
            yield pd.DataFrame(rows, columns=["stem", "caption", "error"])

    # One call at a time in each of as many partitions as calls may run.
    done = images.where("data is not null").select("stem", "height", "width", "data").repartition(concurrency).mapInPandas(call, "stem string, caption string, error string")
    return done.withColumn("caption", F.when(F.col("error").isNull(), text.normalize_caption(F.col("caption"), F.lit(trigger))))


def recaption_folder(spark, folder: str, ask: Callable[[bytes], dict], trigger: str, retries: int = 5, pause: float = 2.0, concurrency: int = 8) -> DataFrame:
    """``(ord, name, stem, caption, error)`` of the images of a folder in the order of their paths; the service is sent the
    files as they are, and only paths are dealt to its callers."""
    asked = _asked(ask, retries, pause)

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [asked(read_bytes(p)) for p in pdf["path"]]
            yield pd.DataFrame({"ord": pdf["ord"], "path": pdf["path"], "caption": [c for c, _ in got], "error": [e for _, e in got]})

    files = list_images(spark, folder).select("ord", "path").repartition(concurrency)
    done = files.mapInPandas(call, "ord bigint, path string, caption string, error string")
    said = F.when(F.col("error").isNull(), text.normalize_caption(F.col("caption"), F.lit(trigger)))
    return done.select("ord", text.file_name(F.col("path")).alias("name"), text.stem(F.col("path")).alias("stem"), said.alias("caption"), "error")

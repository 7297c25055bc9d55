"""Dense kernels on one image: uint8 arrays in blue, green, red order, masks of 0 and 255.

They run inside Arrow-batched functions; nothing here knows of Spark. OpenCV is not needed, so values that depend on
its fixed-point resampling can differ in the last place.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Sequence
from functools import lru_cache

import numpy as np

#: Gray levels up to INK are ink for the outline pass; LIGHT and above are light for the gutter pass (fixed values).
INK = LIGHT = 220
GUTTER_SHARE, GUTTER_RUN, SIDE, DEPTH = 0.97, 8, 32, 4
PHASH_EDGE, PHASH_KEEP = 32, 8
MASK_ON = 127


def encode_png(image: np.ndarray) -> bytes:
    """A PNG of a gray or a blue, green, red image."""
    rows = image[:, :, ::-1] if image.ndim == 3 else image
    height, width = image.shape[:2]
    raw = np.concatenate([np.zeros((height, 1), np.uint8), np.ascontiguousarray(rows).reshape(height, -1)], axis=1).tobytes()

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, height, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def from_source(height: int, width: int, channels: int, data: bytes) -> np.ndarray | None:
    """Three channels of a row of Spark's image source, which has one, three or four; None if it is invalid."""
    if height is None or height <= 0 or channels not in (1, 3, 4):
        return None
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.repeat(a, 3, axis=2) if channels == 1 else np.ascontiguousarray(a[:, :, :3])


def gray(image: np.ndarray) -> np.ndarray:
    if image.ndim == 2:
        return image
    b, g, r = (image[:, :, i].astype(np.int64) for i in range(3))
    return ((1868 * b + 9617 * g + 4899 * r + 8192) >> 14).astype(np.uint8)


@lru_cache(maxsize=16)
def _area_weights(size: int, to: int) -> np.ndarray:
    """How much each of ``size`` cells counts in each of ``to``: the share of the covered length."""
    edges = np.linspace(0, size, to + 1)
    low, high = np.arange(size), np.arange(1, size + 1)
    cover = np.clip(np.minimum(high[None, :], edges[1:, None]) - np.maximum(low[None, :], edges[:-1, None]), 0, None)
    return cover / cover.sum(axis=1, keepdims=True)


@lru_cache(maxsize=16)
def _lanczos_weights(size: int, to: int, taps: int = 4) -> np.ndarray:
    """Windowed sinc weights over eight cells, the edge cells repeated."""
    at = (np.arange(to) + 0.5) * size / to - 0.5
    cells = np.floor(at)[:, None].astype(int) + np.arange(1 - taps, taps + 1)[None, :]
    x = at[:, None] - cells
    w = np.sinc(x) * np.sinc(x / taps) * (np.abs(x) < taps)
    out = np.zeros((to, size))
    np.add.at(out, (np.arange(to)[:, None], np.clip(cells, 0, size - 1)), w / w.sum(axis=1, keepdims=True))
    return out


def _resample(image: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    planes = image[:, :, None] if image.ndim == 2 else image
    out = np.stack([rows @ planes[:, :, c].astype(np.float64) @ cols.T for c in range(planes.shape[2])], axis=2)
    out = np.clip(np.rint(out), 0, 255).astype(np.uint8)
    return out[:, :, 0] if image.ndim == 2 else out


def area_resize(image: np.ndarray, width: int, height: int) -> np.ndarray:
    h, w = image.shape[:2]
    return _resample(image, _area_weights(h, height), _area_weights(w, width))


def lanczos_resize(image: np.ndarray, width: int, height: int) -> np.ndarray:
    h, w = image.shape[:2]
    return image.copy() if (h, w) == (height, width) else _resample(image, _lanczos_weights(h, height), _lanczos_weights(w, width))


def nearest_resize(image: np.ndarray, width: int, height: int) -> np.ndarray:
    h, w = image.shape[:2]
    return image[(np.arange(height) * h // height)[:, None], (np.arange(width) * w // width)[None, :]]


@lru_cache(maxsize=4)
def _cosines(n: int) -> np.ndarray:
    k = np.arange(n)
    out = np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / (2 * n)) * np.sqrt(2 / n)
    out[0] /= np.sqrt(2)
    return out


def phash(image: np.ndarray) -> int:
    """64 bits, as a signed integer: low cosine coefficients above their median, row by row from the highest bit."""
    small = area_resize(gray(image), PHASH_EDGE, PHASH_EDGE).astype(np.float32).astype(np.float64)
    c = _cosines(PHASH_EDGE)
    low = (c @ small @ c.T)[:PHASH_KEEP, :PHASH_KEEP].astype(np.float32)
    return int.from_bytes(np.packbits((low > np.median(low)).ravel()).tobytes(), "big", signed=True)


def upscale(image: np.ndarray, target: int) -> np.ndarray:
    """A short side of ``target``; an image that has it already stays."""
    h, w = image.shape[:2]
    if min(h, w) >= target:
        return image
    return lanczos_resize(image, round(w * target / min(h, w)), round(h * target / min(h, w)))


def _square_pads(h: int, w: int) -> tuple[tuple[int, int], tuple[int, int]]:
    edge = max(h, w)
    return ((edge - h) // 2, edge - h - (edge - h) // 2), ((edge - w) // 2, edge - w - (edge - w) // 2)


def letterbox(image: np.ndarray, mask: np.ndarray, width: int, height: int) -> tuple[np.ndarray, np.ndarray, tuple[int, int, int, int, int]]:
    """Model inputs of a square made by mirrored borders (the mask's are empty), and what undoes it:
    edge, top, left, height, width. The image is 1 x 3 x h x w in red, green, blue from 0 to 1, the mask 1 x 1 x h x w of 0 and 1."""
    h, w = image.shape[:2]
    (top, bottom), (left, right) = _square_pads(h, w)
    square = np.pad(image, ((top, bottom), (left, right), (0, 0)), mode="symmetric")
    on = np.pad((mask > MASK_ON).astype(np.uint8), ((top, bottom), (left, right)))
    small = area_resize(square, width, height)[:, :, ::-1].astype(np.float32) / 255
    return small.transpose(2, 0, 1)[None], nearest_resize(on, width, height).astype(np.float32)[None, None], (max(h, w), top, left, h, w)


def unletterbox(raw: np.ndarray, undo: tuple[int, int, int, int, int]) -> np.ndarray:
    """A model's output, red, green, blue from 0 to 255, as an image of the original size."""
    edge, top, left, h, w = undo
    planes = np.asarray(raw).reshape(np.asarray(raw).shape[-3:])
    image = np.clip(planes.transpose(1, 2, 0), 0, 255).astype(np.uint8)[:, :, ::-1]
    return lanczos_resize(image, edge, edge)[top : top + h, left : left + w]


def tagger_input(image: np.ndarray, size: int) -> np.ndarray:
    """1 x size x size x 3 floats from 0 to 255, padded to a square with white."""
    h, w = image.shape[:2]
    square = np.pad(image, (*_square_pads(h, w), (0, 0)), constant_values=255)
    resize = area_resize if max(h, w) > size else lanczos_resize
    return resize(square, size, size).astype(np.float32)[None]


def composite(original: np.ndarray, painted: np.ndarray, mask: np.ndarray) -> np.ndarray:
    return np.where((mask > MASK_ON)[:, :, None], painted, original)


def overlay(image: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Masked places tinted red, six parts to four."""
    tint = (0.4 * image + 0.6 * np.array([0, 0, 255])).astype(np.uint8)
    return np.where((mask > 0)[:, :, None], tint, image)


def boxes_mask(boxes: Sequence[Sequence[int]], width: int, height: int) -> np.ndarray:
    """Boxes x1, y1, x2, y2, corners in any order, cut to the image; empty ones are skipped."""
    out = np.zeros((height, width), np.uint8)
    for x1, y1, x2, y2 in boxes:
        (a, b), (c, d) = sorted((x1, x2)), sorted((y1, y2))
        out[max(c, 0) : max(min(d, height), 0), max(a, 0) : max(min(b, width), 0)] = 255
    return out


def polygons_mask(polygons: Sequence[Sequence[tuple[int, int]]], width: int, height: int) -> np.ndarray:
    """Filled polygons of three points and more, edges included, by the even-odd rule along each row."""
    out = np.zeros((height, width), np.uint8)
    for points in polygons:
        if len(points) < 3:
            continue
        p = np.array(points, float)
        q = np.roll(p, -1, axis=0)
        for y in range(max(0, int(np.ceil(p[:, 1].min()))), min(height - 1, int(np.floor(p[:, 1].max()))) + 1):
            crosses = (np.minimum(p[:, 1], q[:, 1]) <= y) & (np.maximum(p[:, 1], q[:, 1]) > y)
            at = np.sort(p[crosses, 0] + (y - p[crosses, 1]) * (q[crosses, 0] - p[crosses, 0]) / (q[crosses, 1] - p[crosses, 1]))
            for a, b in zip(at[::2], at[1::2]):
                out[y, max(0, int(np.floor(a + 0.5))) : max(0, min(width, int(np.floor(b + 0.5)) + 1))] = 255
        steps = np.maximum(np.abs(q - p).max(axis=1), 1).astype(int)
        for (x, y), (u, v), n in zip(p, q, steps):
            t = np.linspace(0, 1, n + 1)
            xs, ys = np.rint(x + t * (u - x)).astype(int), np.rint(y + t * (v - y)).astype(int)
            ok = (xs >= 0) & (xs < width) & (ys >= 0) & (ys < height)
            out[ys[ok], xs[ok]] = 255
    return out


def union(masks: Sequence[np.ndarray], width: int, height: int) -> np.ndarray:
    return np.maximum.reduce([np.zeros((height, width), np.uint8), *masks])


def dilate(mask: np.ndarray, radius: int) -> np.ndarray:
    """Grown by an ellipse of ``2 * radius + 1``: each row of it is a run, so rows are widened and shifted."""
    if radius <= 0:
        return mask.copy()
    h, w = mask.shape
    sums = np.zeros((h, w + 1), np.int64)
    np.cumsum(mask > 0, axis=1, out=sums[:, 1:])
    out = np.zeros((h, w), bool)
    for dy in range(-radius, radius + 1):
        dx = round(radius * np.sqrt(1 - (dy / radius) ** 2))
        low, high = np.clip(np.arange(w) - dx, 0, w), np.clip(np.arange(w) + dx + 1, 0, w)
        wide = sums[:, high] > sums[:, low]
        out[max(0, dy) : h + min(0, dy)] |= wide[max(0, -dy) : h + min(0, -dy)]
    return out.astype(np.uint8) * 255


def coverage(mask: np.ndarray) -> float:
    return float(np.count_nonzero(mask)) / mask.size if mask.size else 0.0


def content_spans(gutter: np.ndarray, min_run: int, min_side: int) -> list[tuple[int, int]]:
    """Half-open spans of what is no gutter; gutters shorter than ``min_run`` belong to a span."""
    places = np.flatnonzero(~np.asarray(gutter, bool))
    if not len(places):
        return []
    cuts = np.flatnonzero(np.diff(places) > min_run)
    starts, stops = places[np.concatenate([[0], cuts + 1])], places[np.concatenate([cuts, [len(places) - 1]])] + 1
    return [(int(a), int(b)) for a, b in zip(starts, stops) if b - a >= min_side]


def cut_by_gutters(level: np.ndarray, box: tuple[int, int, int, int], light: int = LIGHT, share: float = GUTTER_SHARE, min_run: int = GUTTER_RUN, min_side: int = SIDE, depth: int = DEPTH) -> list[tuple[int, int, int, int]]:
    """A box x, y, w, h cut along its light rows or columns, whichever has more pieces (rows if equal), and so on."""
    x, y, w, h = box
    if depth <= 0 or max(w, h) < 2 * min_side:
        return [box]
    bright = level[y : y + h, x : x + w] >= light
    rows, cols = (content_spans(bright.mean(axis=a) >= share, min_run, min_side) for a in (1, 0))
    if len(rows) > 1 and len(rows) >= len(cols):
        parts = [(x, y + a, w, b - a) for a, b in rows]
    elif len(cols) > 1:
        parts = [(x + a, y, b - a, h) for a, b in cols]
    else:
        return [box]
    return [piece for p in parts for piece in cut_by_gutters(level, p, light, share, min_run, min_side, depth - 1)]


def _label_runs(on: np.ndarray, reach: int) -> tuple[list[tuple[int, int, int]], list[int]]:
    """Runs (row, first, stop) and the component of each; ``reach`` 1 joins diagonal neighbours, 0 does not."""
    runs: list[tuple[int, int, int]] = []
    parent: list[int] = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    before: list[int] = []
    for y, line in enumerate(on):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], line.view(np.int8), [0]])))
        here, k = [], 0
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            i = len(runs)
            runs.append((y, a, b))
            parent.append(i)
            here.append(i)
            while k < len(before) and runs[before[k]][2] + reach <= a:
                k += 1
            m = k
            while m < len(before) and runs[before[m]][1] < b + reach:
                p, q = root(before[m]), root(i)
                parent[max(p, q)] = min(p, q)
                m += 1
        before = here
    return runs, [root(i) for i in range(len(runs))]


def outer_boxes(ink: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Bounding boxes of the ink components that border on the outer background: none inside another's hole."""
    h, w = ink.shape
    open_field = np.pad(~ink, 1, constant_values=True)
    runs, names = _label_runs(open_field, 0)
    outside = np.zeros((h + 2, w + 2), bool)
    for (y, a, b), n in zip(runs, names):
        if n == names[0]:
            outside[y, a:b] = True
    beside = outside[:-2, 1:-1] | outside[2:, 1:-1] | outside[1:-1, :-2] | outside[1:-1, 2:]
    found: dict[int, list[int]] = {}
    runs, names = _label_runs(ink, 1)
    for (y, a, b), n in zip(runs, names):
        box = found.setdefault(n, [a, y, b, y + 1, 0])
        box[:] = [min(box[0], a), min(box[1], y), max(box[2], b), max(box[3], y + 1), box[4] | int(beside[y, a:b].any())]
    return [(a, c, b - a, d - c) for a, c, b, d, touches in found.values() if touches]


def detect_panels(image: np.ndarray, resplit: bool = True) -> list[tuple[int, int, int, int]]:
    """Boxes x, y, w, h of a page's panels: outlines of its ink, each cut again along inner gutters."""
    level = gray(image)
    boxes = outer_boxes(level <= INK)
    return [piece for b in boxes for piece in cut_by_gutters(level, b)] if resplit else boxes


def denoise(image: np.ndarray, strength: float = 3.0, patch: int = 3, reach: int = 5) -> np.ndarray:
    """Non-local means: each place becomes the mean of those around it, weighted by how alike their surroundings are.

    Shifted copies of the whole image are weighed at once; ``reach`` and ``patch`` are half widths.
    """
    h, w = image.shape[:2]
    pad = reach + patch
    wide = np.pad(image.astype(np.float32), ((pad, pad), (pad, pad), (0, 0)), mode="symmetric")
    centre = wide[reach : reach + h + 2 * patch, reach : reach + w + 2 * patch]
    total, weights = np.zeros(image.shape, np.float32), np.zeros((h, w, 1), np.float32)
    for dy in range(2 * reach + 1):
        for dx in range(2 * reach + 1):
            other = wide[dy : dy + h + 2 * patch, dx : dx + w + 2 * patch]
            sums = np.pad(((centre - other) ** 2).mean(axis=2), ((1, 0), (1, 0))).cumsum(axis=0, dtype=np.float64).cumsum(axis=1)
            n = 2 * patch + 1
            apart = (sums[n:, n:] - sums[:-n, n:] - sums[n:, :-n] + sums[:-n, :-n]) / n**2
            weight = np.exp(-np.maximum(apart, 0) / strength**2).astype(np.float32)[:, :, None]
            total += weight * other[patch : patch + h, patch : patch + w]
            weights += weight
    return np.clip(np.rint(total / weights), 0, 255).astype(np.uint8)


def contact_sheet(cells: dict[tuple[int, int], np.ndarray | None], rows: int, columns: int, side: int = 320) -> np.ndarray:
    """Images by (row, column) in a grid, each shrunk to fit its cell; a cell without one has a red frame."""
    sheet = np.full((rows * side, columns * side, 3), 245, np.uint8)
    for r in range(rows):
        for c in range(columns):
            image, y, x, room = cells.get((r, c)), r * side + 2, c * side + 2, side - 4
            if image is None:
                sheet[y : y + room, x : x + room] = (60, 60, 200)
                sheet[y + 1 : y + room - 1, x + 1 : x + room - 1] = 245
                continue
            share = min(1.0, room / max(image.shape[:2]))
            h, w = (max(1, round(n * share)) for n in image.shape[:2])
            small = area_resize(image, w, h) if share < 1 else image
            sheet[y : y + h, x : x + w] = small
    return sheet

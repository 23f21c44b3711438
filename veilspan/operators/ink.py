"""Regions of ink on page images: threshold, dilation, and boxes of what hangs together.

Images are raw pixels, a row after the other, with one byte each (gray) or three (red,
green, blue). It is numpy work on Arrow batches; decoding files is the caller's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from veilspan.operators.regions import LEAST_AREA, MOST_SHARE

#: Width, height and passes of the dilation; the threshold where the automatic one isn't wanted.
KERNEL, PASSES, MANUAL = (15, 9), 2, 180
#: Weights of red, green and blue in 1/16384.
GRAY = (4899, 9617, 1868)
SCHEMA = "path string, page_index int, x int, y int, w int, h int, page_width int, page_height int"


def gray(pixels: bytes, width: int, height: int) -> np.ndarray:
    """height x width of brightness; the number of bytes says whether it is colour."""
    raw = np.frombuffer(pixels, np.uint8)
    if len(raw) == width * height:
        return raw.reshape(height, width)
    if len(raw) != 3 * width * height:
        raise ValueError(f"{len(raw)} bytes are no image of {width} x {height}")
    rgb = raw.reshape(height, width, 3).astype(np.int64)
    return ((rgb @ np.array(GRAY) + 8192) >> 14).astype(np.uint8)


def automatic_threshold(image: np.ndarray) -> int:
    """Otsu's: the brightness up to which pixels are ink so that the classes' means are furthest apart, by weight. 0 for an image of one brightness."""
    count = np.bincount(image.ravel(), minlength=256).astype(np.float64)
    share = count / max(1.0, count.sum())
    low = np.cumsum(share)
    mean = np.cumsum(share * np.arange(256))
    both = np.minimum(low, 1 - low) > 1e-7
    apart = np.zeros(256)
    dark, bright = mean[both] / low[both], (mean[-1] - mean[both]) / (1 - low[both])
    apart[both] = low[both] * (1 - low[both]) * (dark - bright) ** 2
    return int(apart.argmax())


def dilated(mask: np.ndarray, kernel: tuple[int, int] = KERNEL, passes: int = PASSES) -> np.ndarray:
    """Each pixel with ink within reach: passes of a centred box are one box of that many times its reach."""
    for axis, size in ((1, kernel[0]), (0, kernel[1])):
        reach = size // 2 * passes
        n = mask.shape[axis]
        total = np.insert(np.cumsum(mask, axis=axis, dtype=np.int64), 0, 0, axis=axis)
        hi = np.minimum(np.arange(n) + reach + 1, n)
        lo = np.maximum(np.arange(n) - reach, 0)
        mask = np.take(total, hi, axis=axis) > np.take(total, lo, axis=axis)
    return mask


def joined(mask: np.ndarray, diagonal: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of each row of a mask: row, first and last column (exclusive), and a number for what hangs together, also over corners if ``diagonal``."""
    edge = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, lo = np.nonzero(edge == 1)
    hi = np.nonzero(edge == -1)[1]
    up = np.arange(len(row))

    def find(k: int) -> int:
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    # the runs of the row before that touch each run, by place in the order of rows and columns
    wide = mask.shape[1] + 3
    reach = 1 if diagonal else 0
    first = np.searchsorted((row * wide) + hi, (row - 1) * wide + lo - reach, "right")
    last = np.searchsorted((row * wide) + lo, (row - 1) * wide + hi + reach, "left")
    for k in np.flatnonzero(last > first).tolist():
        for j in range(int(first[k]), int(last[k])):
            a, b = find(k), find(j)
            if a != b:
                up[max(a, b)] = min(a, b)
    return row, lo, hi, np.array([find(k) for k in range(len(row))], np.int64)


def boxes(mask: np.ndarray) -> list[tuple[int, int, int, int]]:
    """x, y, w, h of what hangs together and isn't inside a hole of something else, by the first pixel's row and column."""
    row, lo, hi, part = joined(mask, True)
    if not len(row):
        return []
    # the background that reaches the edge, with a frame around the image
    frow, flo, fhi, fpart = joined(np.pad(~mask, 1, constant_values=True), False)
    outside = np.zeros((mask.shape[0] + 2, mask.shape[1] + 2), bool)
    for r, a, b in zip(frow[fpart == fpart[0]].tolist(), flo[fpart == fpart[0]].tolist(), fhi[fpart == fpart[0]].tolist(), strict=True):
        outside[r, a:b] = True
    beside = outside[1:-1, :-2] | outside[1:-1, 2:] | outside[:-2, 1:-1] | outside[2:, 1:-1]
    reached = np.array([beside[r, a:b].any() for r, a, b in zip(row.tolist(), lo.tolist(), hi.tolist(), strict=True)])
    out = []
    for k in np.unique(part[reached]).tolist():
        own = part == k
        x, y = int(lo[own].min()), int(row[own].min())
        out.append((x, y, int(hi[own].max()) - x, int(row[own].max()) + 1 - y))
    return out


def page_regions(image: np.ndarray, threshold: int | None = None) -> list[tuple[int, int, int, int]]:
    """Boxes of ink on a gray page, without specks and frames. The threshold is found by itself unless one is given."""
    ink = image <= (automatic_threshold(image) if threshold is None else threshold)
    most = MOST_SHARE * image.shape[0] * image.shape[1]
    return [b for b in boxes(dilated(ink)) if LEAST_AREA <= b[2] * b[3] <= most]


def ink_regions(images: DataFrame, threshold: int | None = None) -> DataFrame:
    """Regions of page images (path, page_index, image, width, height), a row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):  # an image at a time
                r = batch.slice(k, 1).to_pylist()[0]
                found = page_regions(gray(r["image"], r["width"], r["height"]), threshold)
                if found:
                    n = len(found)
                    cells = [[r["path"]] * n, [r["page_index"]] * n, *map(list, zip(*found, strict=True)), [r["width"]] * n, [r["height"]] * n]
                    kinds = [pa.string(), *[pa.int32()] * 7]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, kinds, strict=True)], ["path", "page_index", "x", "y", "w", "h", "page_width", "page_height"])

    return images.select("path", "page_index", "image", "width", "height").mapInArrow(run, SCHEMA)

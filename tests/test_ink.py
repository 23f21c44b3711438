"""Regions of ink against flood fills, pixel by pixel."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veilspan.operators import ink


def flood(mask, start, corners):
    """All pixels that hang together with one."""
    steps = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0) and (corners or a == 0 or b == 0)]
    seen, todo = {start}, [start]
    while todo:
        r, c = todo.pop()
        for a, b in steps:
            p = (r + a, c + b)
            if 0 <= p[0] < mask.shape[0] and 0 <= p[1] < mask.shape[1] and mask[p] and p not in seen:
                seen.add(p)
                todo.append(p)
    return seen


def outer_boxes(mask):
    paper = np.pad(~mask, 1, constant_values=True)
    outside = flood(paper, (0, 0), False)
    left, out = {tuple(map(int, p)) for p in np.argwhere(mask)}, []
    while left:
        own = flood(mask, min(left), True)
        left -= own
        if any((r + 1 + a, c + 1 + b) in outside for r, c in own for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0))):
            rows, cols = [r for r, _ in own], [c for _, c in own]
            out.append((min(cols), min(rows), max(cols) - min(cols) + 1, max(rows) - min(rows) + 1))
    return sorted(out)


masks = st.integers(1, 9).flatmap(lambda h: st.integers(1, 9).flatmap(lambda w: st.lists(st.booleans(), min_size=h * w, max_size=h * w).map(lambda x: np.array(x).reshape(h, w))))


@settings(max_examples=300, deadline=None)
@given(masks)
def test_boxes(mask):
    assert sorted(ink.boxes(mask)) == outer_boxes(mask)


def test_what_lies_in_a_hole_is_no_region():
    mask = np.zeros((9, 9), bool)
    mask[1:8, 1:8] = True
    mask[3:6, 3:6] = False
    mask[4, 4] = True
    assert ink.boxes(mask) == [(1, 1, 7, 7)]
    mask[1, 4], mask[2, 4] = False, False  # the ring is open: what is inside is reached
    assert sorted(ink.boxes(mask)) == [(1, 1, 7, 7), (4, 4, 1, 1)]


@settings(max_examples=100, deadline=None)
@given(masks, st.sampled_from([(3, 1), (1, 3), (3, 3), (5, 3)]), st.integers(1, 2))
def test_dilation(mask, kernel, passes):
    want = mask
    for _ in range(passes):
        now = np.zeros_like(want)
        for r, c in np.argwhere(want):
            now[max(0, r - kernel[1] // 2) : r + kernel[1] // 2 + 1, max(0, c - kernel[0] // 2) : c + kernel[0] // 2 + 1] = True
        want = now
    assert (ink.dilated(mask, kernel, passes) == want).all()


def test_threshold_parts_two_brightnesses_best():
    rng = np.random.default_rng(0)
    image = np.where(rng.random((40, 50)) < 0.2, rng.integers(10, 60, (40, 50)), rng.integers(170, 250, (40, 50))).astype(np.uint8)

    def apart(t):
        dark, bright = image[image <= t], image[image > t]
        return len(dark) * len(bright) * (dark.mean() - bright.mean()) ** 2 if len(dark) and len(bright) else 0

    best = max(range(256), key=apart)
    assert ink.automatic_threshold(image) == best and 59 <= best < 170
    assert ink.automatic_threshold(np.full((3, 3), 200, np.uint8)) == 0


def test_pages(spark):
    page = np.full((300, 400), 255, np.uint8)
    page[100:110, 50:90] = 0
    page[105:110, 100:130] = 30  # near enough to be one region
    page[200:290, 300:340] = 0
    page[0, 0] = 0  # a speck
    colour = np.repeat(page[:, :, None], 3, 2)
    rows = [("gray", 0, bytearray(page.tobytes()), 400, 300), ("colour", 1, bytearray(colour.tobytes()), 400, 300), ("blank", 0, bytearray(b"\xff" * 12), 4, 3), ("frame", 0, bytearray(np.pad(np.full((90, 90), 255, np.uint8), 5).tobytes()), 100, 100)]
    df = spark.createDataFrame(rows, "path string, page_index int, image binary, width int, height int")
    got = {}
    for r in ink.ink_regions(df).collect():
        got.setdefault(r.path, set()).add((r.x, r.y, r.w, r.h))
    want = {(36, 92, 108, 26), (286, 192, 68, 106)}
    assert got == {"gray": want, "colour": want}
    with pytest.raises(Exception, match="no image of"):
        ink.ink_regions(spark.createDataFrame([("bad", 0, bytearray(b"123"), 4, 4)], df.schema)).collect()

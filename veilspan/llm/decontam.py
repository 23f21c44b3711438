"""Benchmark decontamination by greedy string tiling.

Words are compared in lower case (A-Z) without ASCII punctuation; in scripts that put no
spaces between words each character is a word. Documents and test
items that share a seed, ``least`` words in a row, are tiled: the longest common runs of
unmarked words are marked one after the other, found by running Karp-Rabin hashes of
falling lengths and checked word by word, until none of at least ``least`` words is left.
Where repetitive texts have very many equal runs, their words are compared along diagonals
instead, some at a time, so that memory goes with the maximal runs and not with the pairs of
places. Tiles don't overlap and may come in any order, so a reordered passage is covered as well. A document leaks an
item when its tiles cover at least ``coverage`` of the item's words, or when one tile has
``long`` words or more, however little of a long item that is.

The items are broadcast up to ``BROADCAST_BYTES`` of text. Beyond that, a bitmap of fixed
size picks the documents' seeds, these are joined to the items' seeds by shuffle, and the
pairs that share as many seeds as a leak has at least are tiled with both texts joined to
them.

Defined results:

* null and empty texts leak nothing
* an item of fewer than ``least`` words is its own seed: it is leaked by what has all of its
  words in a row, and by nothing less; an item without words is never leaked
* among equally long runs, the one that is first in the item, then in the document, is
  marked first
* rows with a null or repeated doc_id are looked at one by one; repeated items count each
* no document and no item gives an empty result
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspan import scratch
from veilspan.llm.arrow import get, slices, text_bytes
from veilspan.llm.near_dedup import mix, powers

LEAST, COVERAGE, LONG, BROADCAST_BYTES, BITMAP_BITS = 5, 0.5, 16, 32 << 20, 24
SCHEMA = "doc_id long, text_hash long, item_id long, coverage double, n_tiles int, longest int"

#: Pairs of equal runs that are listed at once; and words that are compared at once, where there are more.
MOST_PAIRS = 1 << 21

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Code points of scripts without spaces: Thai to Tibetan, Myanmar, Khmer, Tai, Chinese and Japanese.
ALONE = ((0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x2E80, 0x312F), (0x31A0, 0x9FFF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF))
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def alone(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where characters of scripts without spaces begin in UTF-8, and where they end."""
    begin, end = [], []
    for size, lo, hi, mask in ((3, 0xE0, 0xEF, 15), (4, 0xF0, 0xF7, 7)):
        at = np.flatnonzero((data >= lo) & (data <= hi))
        at = at[at + size <= len(data)]
        code = (data[at] & mask).astype(np.int64)
        for k in range(1, size):
            code = code << 6 | data[at + k] & 63
        at = at[np.any([(code >= x) & (code <= y) for x, y in ALONE], axis=0)]
        begin.append(at)
        end.append(at + size)
    return np.concatenate(begin), np.concatenate(end)


class Texts:
    """Words of some texts: their hashes, their places in the lower-cased bytes, and the texts' places among them."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.low = _LOWER[data]
        word = _WORD[data]
        bounds = np.zeros(len(data) + 1, bool)
        bounds[at] = True
        for cut in alone(data):
            bounds[cut] = True
        self.starts = np.flatnonzero(word & (~np.concatenate([[False], word])[:-1] | bounds[:-1]))
        self.ends = np.flatnonzero(word & (~np.concatenate([word[1:], [False]])[: len(word)] | bounds[1:])) + 1
        up, down = powers(len(data))
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((self.low.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        self.h = mix((total[self.ends] - total[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(np.uint64))
        self.at = np.searchsorted(self.starts, at)

    def words(self, k: int) -> Words:
        own = slice(self.at[k], self.at[k + 1])
        return Words(self.h[own], self.low, self.starts[own], self.ends[own])


class Words:
    """The words of one text."""

    def __init__(self, h: np.ndarray, low: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.h, self.low, self.starts, self.ends = h, low, starts, ends

    def __len__(self) -> int:
        return len(self.h)

    def word(self, k: int) -> bytes:
        return self.low[self.starts[k] : self.ends[k]].tobytes()


def tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the documents' places among them."""
    t = Texts(data, at)
    return t.h, t.at


def rolling(h: np.ndarray, s: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of s words."""
    if len(h) < s:
        return np.zeros(0, np.uint64)
    up, down = powers(len(h))
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[:-1], out=total[1:])
    return (total[s:] - total[:-s]) * down[: len(h) - s + 1]


def matches(a: np.ndarray, b: np.ndarray, free_a: np.ndarray, free_b: np.ndarray, s: int) -> list[tuple[int, int, int]]:
    """All maximal common runs of at least s free words: (-length, place in a, place in b)."""

    def open_(free: np.ndarray) -> np.ndarray:
        taken = np.concatenate([[0], np.cumsum(~free)])
        return taken[s:] == taken[:-s]

    ra, rb = rolling(a, s), rolling(b, s)
    if not len(ra) or not len(rb):
        return []
    ia, ib = np.flatnonzero(open_(free_a)), np.flatnonzero(open_(free_b))
    ib = ib[np.isin(rb[ib], ra[ia])]
    if not len(ib):
        return []
    order = ia[np.argsort(ra[ia], kind="stable")]
    lo, hi = np.searchsorted(ra[order], rb[ib], "left"), np.searchsorted(ra[order], rb[ib], "right")
    count = hi - lo
    if count.sum() > MOST_PAIRS:
        return diagonals(a, b, free_a, free_b, s)
    j = np.repeat(ib, count)
    i = order[np.repeat(lo, count) + np.arange(len(j)) - np.repeat(np.cumsum(count) - count, count)]
    by = np.lexsort((i, j - i))
    i, j = i[by], j[by]
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(i) != 1) | (np.diff(j) != 1)]))
    size = np.diff(np.append(cut, len(i))) + s - 1
    return list(zip((-size).tolist(), i[cut].tolist(), j[cut].tolist(), strict=True))


def diagonals(a: np.ndarray, b: np.ndarray, free_a: np.ndarray, free_b: np.ndarray, s: int) -> list[tuple[int, int, int]]:
    """The same runs, from the words themselves, for some differences of places at a time."""
    n = len(a)
    view = np.lib.stride_tricks.sliding_window_view
    padded = np.concatenate([np.zeros(n - 1, np.uint64), b, np.zeros(n - 1, np.uint64)])
    open_ = np.concatenate([np.zeros(n - 1, bool), free_b, np.zeros(n - 1, bool)])
    words, frees = view(padded, n), view(open_, n)  # row d: the words of b that face those of a when b begins at d - (n - 1)
    out: list[tuple[int, int, int]] = []
    step = max(1, MOST_PAIRS // n)
    for d in range(0, len(words), step):
        same = (words[d : d + step] == a[None, :]) & frees[d : d + step] & free_a[None, :]
        edge = np.diff(np.pad(same, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, lo = np.nonzero(edge == 1)
        hi = np.nonzero(edge == -1)[1]
        long = hi - lo >= s
        row, lo, hi = row[long] + d, lo[long], hi[long]
        out += zip((lo - hi).tolist(), lo.tolist(), (lo + row - (n - 1)).tolist(), strict=True)
    return out


Same = Callable[[int, int, int], np.ndarray]


def tile(a: np.ndarray, b: np.ndarray, least: int = LEAST, same: Same | None = None) -> list[tuple[int, int, int]]:
    """Greedy tiles of a (item) by b (document): (place in a, place in b, length), longest first. ``same`` tells from place in a, place in b and length which words are equal indeed."""
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    out: list[tuple[int, int, int]] = []
    s = max(least, min(len(a), len(b)))
    while True:
        heap = matches(a, b, free_a, free_b, s)
        heapq.heapify(heap)
        while heap:
            size, i, j = heapq.heappop(heap)
            free = free_a[i : i - size] & free_b[j : j - size]
            if free.all() and same is not None:
                free = same(i, j, -size)
            if free.all():
                free_a[i : i - size] = free_b[j : j - size] = False
                out.append((i, j, -size))
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]).astype(np.int8)))
            for lo, hi in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True):  # what is left of the run
                if hi - lo >= s:
                    heapq.heappush(heap, (lo - hi, i + lo, j + lo))
        if s == least:
            return out
        s = max(least, s // 2)


class Items:
    """The benchmark in a worker: each item's words, and its seeds."""

    def __init__(self, ids: list[int | None], texts: list[str | None], least: int):
        self.least, self.ids = least, ids
        all_ = Texts(*text_bytes(pa.array(texts, pa.string())))
        self.words = [all_.words(k) for k in range(len(texts))]
        seeds = [own_seeds(w.h, least) for w in self.words]
        self.lengths = sorted({min(least, len(w)) for w in self.words if len(w)})
        flat = np.concatenate([*seeds, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds])
        order = np.argsort(flat, kind="stable")
        self.seeds, self.owner = flat[order], owner[order]
        self.bitmap = np.zeros(1 << BITMAP_BITS, bool)
        self.bitmap[(flat >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)] = True

    def leaks(self, words: Words, shared: np.ndarray, coverage: float, long: int = LONG) -> Iterator[tuple[int, float, int, int]]:
        """shared: seeds of the document that may be the items'. Yields item number, coverage, tiles, longest tile."""
        got = np.unique(shared)
        lo, hi = np.searchsorted(self.seeds, got, "left"), np.searchsorted(self.seeds, got, "right")
        some = hi > lo
        near = np.unique(np.concatenate([self.owner[x:y] for x, y in zip(lo[some], hi[some], strict=True)])) if some.any() else []
        for k in near:
            found = leak(self.words[k], words, self.least, coverage, long)
            if found:
                yield (int(k), *found)


def own_seeds(item: np.ndarray, least: int) -> np.ndarray:
    """The distinct seeds of an item: of fewer than ``least`` words, the whole of it."""
    return np.unique(rolling(item, min(least, len(item)))) if len(item) else np.zeros(0, np.uint64)


def leak(item: Words, words: Words, least: int, coverage: float, long: int = LONG) -> tuple[float, int, int] | None:
    """Coverage, number of tiles and longest tile, if the document leaks the item."""
    if not len(item):
        return None
    if len(item) < least:
        least, coverage = len(item), 1.0
    seeds = rolling(item.h, least)
    hit = np.flatnonzero(np.isin(seeds, rolling(words.h, least)))
    reach = np.zeros(len(item) + 1, np.int64)
    np.add.at(reach, hit, 1)
    np.add.at(reach, hit + least, -1)
    held = np.cumsum(reach)[:-1] > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], held, [False]]).astype(np.int8)))
    if held.sum() < coverage * len(item) and np.diff(edge)[::2].max(initial=0) < long:  # tiles can't cover more than shared seeds do
        return None
    tiles = tile(item.h, words.h, least, lambda i, j, n: np.array([item.word(i + k) == words.word(j + k) for k in range(n)]))
    covered = sum(t[2] for t in tiles) / len(item)
    return (covered, len(tiles), tiles[0][2]) if tiles and (covered >= coverage or tiles[0][2] >= long) else None


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def leaks(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE, broadcast_bytes: int = BROADCAST_BYTES, long: int = LONG) -> DataFrame:
    """A row for each document and item that it leaks: doc_id, text_hash, item_id, coverage, n_tiles, longest."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("item"))
    size = items.agg(F.sum(F.octet_length("item") + 16)).first()[0] or 0
    if size > broadcast_bytes:
        return _leaks_by_join(_rows(docs), items, least, coverage, long)
    shared = spark.sparkContext.broadcast([(r["item_id"], r["item"]) for r in items.collect()])
    held: dict[int, Items] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if 0 not in held:
            held[0] = Items([r[0] for r in shared.value], [r[1] for r in shared.value], least)
        own = held[0]
        for batch in slices(batches, "text"):
            texts = Texts(*text_bytes(get(batch, "text")))
            h, at = texts.h, texts.at
            of, shared_seeds = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for length in own.lengths:
                seeds = rolling(h, length)
                maybe = np.flatnonzero(own.bitmap[(seeds >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)])
                doc = np.searchsorted(at, maybe, "right") - 1
                inside = maybe + length <= at[doc + 1]
                of.append(doc[inside])
                shared_seeds.append(seeds[maybe[inside]])
            doc, seeds = np.concatenate(of), np.concatenate(shared_seeds)
            out = [(int(d), *found) for d in np.unique(doc) for found in own.leaks(texts.words(int(d)), seeds[doc == d], coverage, long)]
            if out:
                d = pa.array([x[0] for x in out])
                yield pa.RecordBatch.from_arrays([get(batch, "doc_id").take(d), get(batch, "text_hash").take(d), pa.array([own.ids[x[1]] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.float64()), pa.array([x[3] for x in out], pa.int32()), pa.array([x[4] for x in out], pa.int32())], ["doc_id", "text_hash", "item_id", "coverage", "n_tiles", "longest"])

    return _rows(docs).mapInArrow(run, SCHEMA)


def _seeds(rows: DataFrame, key: list[str], text: str, lengths: list[int], bitmap: np.ndarray | None) -> DataFrame:
    """key columns, seed, its length and weight (at how many places it is), and words of the text, for each distinct seed of each row: of these lengths and in the bitmap, or where there is none, an item's own seeds with one length as the least."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            h, at = tokens(*text_bytes(get(batch, text)))
            own, weight, count, row, size, words = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], [], [], []
            for k, (x, y) in enumerate(zip(at[:-1], at[1:], strict=True)):
                for length in lengths:
                    if shared.value is None:
                        length = min(length, int(y - x))
                    s, n = np.unique(rolling(h[x:y], length) if length else np.zeros(0, np.uint64), return_counts=True)
                    if shared.value is not None:
                        bit = (s >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
                        some = (shared.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
                        s, n = s[some], n[some]
                    own.append(s.view(np.int64))
                    weight.append(n)
                    count.append(len(s))
                    row.append(k)
                    size.append(length)
                    words.append(int(y - x))
            each = lambda x: np.repeat(np.array(x, np.int64), count)
            take = pa.array(each(row))
            yield pa.RecordBatch.from_arrays([*[get(batch, k).take(take) for k in key], pa.array(np.concatenate(own)), pa.array(each(size)), pa.array(np.concatenate(weight)), pa.array(each(words))], [*key, "seed", "length", "weight", "words"])

    return rows.mapInArrow(run, ", ".join(f"{k} {kinds[k]}" for k in key) + ", seed long, length long, weight long, words long")


def _leaks_by_join(rows: DataFrame, items: DataFrame, least: int, coverage: float, long: int) -> DataFrame:
    items = items.withColumn("item_hash", F.xxhash64("item"))
    item_seeds = scratch.written(_seeds(items, ["item_id", "item_hash"], "item", [least], None), "decontam-seeds")
    byte = F.expr(f"cast(shiftrightunsigned(seed, {64 - BITMAP_BITS + 3}) as int)")
    bits = item_seeds.groupBy(byte.alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1, cast(shiftrightunsigned(seed, {64 - BITMAP_BITS}) & 7 as int))")).alias("b"))
    bitmap = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for r in bits.toLocalIterator():  # at most 2 MB of bits, whatever the benchmark's size
        bitmap[r["at"]] = r["b"]
    lengths = sorted(r["length"] for r in item_seeds.select("length").distinct().collect())  # at most as many as least
    met = _seeds(rows, ["doc_id", "text_hash"], "text", lengths, bitmap).drop("weight", "words").join(item_seeds, ["seed", "length"])
    pairs = met.groupBy("doc_id", "text_hash", "item_id", "item_hash").agg(F.sum("weight").alias("weight"), F.max("words").alias("words"))
    # a tile of n words holds n - least + 1 seeds, which is n / least at the least
    enough = F.least(F.ceil(F.col("words") * coverage / least - 1e-6), F.lit(long - least + 1))
    pairs = pairs.where(F.col("weight") >= enough).drop("weight", "words")
    a, b = pairs.alias("p"), rows.alias("r")
    same = F.expr("p.doc_id <=> r.doc_id and p.text_hash = r.text_hash")
    texts = a.join(b, same).select("p.*", "r.text")
    both = texts.alias("t").join(items.alias("i"), F.expr("t.item_id <=> i.item_id and t.item_hash = i.item_hash")).select("t.doc_id", "t.text_hash", "t.item_id", "t.text", "i.item")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, own = Texts(*text_bytes(get(batch, "text"))), Texts(*text_bytes(get(batch, "item")))
            found = [leak(own.words(k), texts.words(k), least, coverage, long) for k in range(batch.num_rows)]
            take = pa.array([k for k, x in enumerate(found) if x], pa.int64())
            got = [x for x in found if x]
            yield pa.RecordBatch.from_arrays([*[get(batch, k).take(take) for k in ("doc_id", "text_hash", "item_id")], pa.array([x[0] for x in got], pa.float64()), pa.array([x[1] for x in got], pa.int32()), pa.array([x[2] for x in got], pa.int32())], ["doc_id", "text_hash", "item_id", "coverage", "n_tiles", "longest"])

    return both.mapInArrow(run, SCHEMA)


def clean(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that leak no item."""
    mine, h = "leak_id", "leak_hash"
    while mine in docs.columns or h in docs.columns:
        mine, h = mine + "_", h + "_"
    found = scratch.written(leaks(docs, benchmark, least, coverage).select(F.col("doc_id").alias(mine), F.col("text_hash").alias(h)).distinct(), "decontam-leaks")
    small = found.limit(1_000_001).count() <= 1_000_000
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(mine)) & (F.xxhash64(F.col("text").cast("string")) == F.col(h))
    return docs.join(F.broadcast(found) if small else found, same, "left_anti")

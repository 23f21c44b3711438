r"""Maximal runs of periodically repeated words, by branching tandem repeats in a suffix tree.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical), at least ``LEAST_LENGTH`` words and ``LEAST_TIMES`` periods long, that no
neighbouring word extends keeping the period. For each text:

1. Each word of a run occurs ``LEAST_TIMES`` times in it. So words that are found less often
   cut the text; what is left between cuts is cut again in the same way, until little
   changes. Only what is left then goes on; mostly it is what is periodic.
2. The suffix tree of the rest, as suffix array and intervals of common prefixes. At each
   inner node of depth q the leaves of all children but the largest are gone through: a
   leaf i whose i + q (or i - q) lies in another child begins (or ends) a tandem repeat of
   length 2q that the next word breaks. As each leaf comes into a child at least twice
   as large each time, all leaf lists together have at most n log n entries.
3. Such a repeat is rotated to the left as long as its words allow, which gives the run that
   ends with it. Of the repeats that end at one word, those inside a run of a smaller period
   repeat that period; they are merged into it.

Texts are worked on about 1 MB at a time, a longer one by itself; its words are read in
windows. A worker needs about 5 bytes for each byte of the longest text and about 120 for
each word of it that step 1 leaves (a text that is one single run leaves all its words).

Defined results:

* a null text, and one without words, has no runs and collapses to the empty text
* collapsing drops each word that a run holds after its first q words and joins the others
  by one space, whatever white space was there
* a null doc_id stays null; rows with equal doc_ids are worked on each by itself
* other columns of the input don't matter, whatever their names; an empty table gives none
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspan import scratch
from veilspan.llm.arrow import get, slices, small_batches, spread, text_bytes

LEAST_LENGTH, LEAST_TIMES = 6, 4
#: Bytes of a text that are split into words at a time; leaves that are looked at together.
WINDOW, LEAVES = 1 << 20, 1 << 21
SCHEMA = "doc_id long, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Takes a doc_id and its number of words; gives the numbers of the words to read instead, or None for the words as they are.
Reading = Callable[[int | None, int], np.ndarray | None]


class Numbers(dict):
    """The number of each word, in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def numbered(data: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The words of a text as numbers, and the word of each number."""
    known, out, lo = Numbers(), [], 0
    while lo < len(data):
        hi = min(len(data), lo + WINDOW)
        while hi < len(data) and not _SPACE[data[hi]]:  # to the end of the word
            ahead = np.flatnonzero(_SPACE[data[hi : hi + WINDOW]])
            hi += int(ahead[0]) if len(ahead) else min(WINDOW, len(data) - hi)
        words = data[lo:hi].tobytes().split()  # at these bytes of white space and no others
        out.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
        lo = hi
    return np.concatenate(out) if out else np.zeros(0, np.int32), list(known)


def uncut(w: np.ndarray, length: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that runs can hold, and the words there, numbered so that those of different pieces differ. ``w``: words of texts, those of different texts with different numbers."""
    pos = np.flatnonzero(np.bincount(w)[w] >= times) if len(w) else np.zeros(0, np.int64)
    while True:
        piece = np.cumsum(np.diff(pos, prepend=-2) != 1)
        _, inverse, count = np.unique(piece * (np.int64(w.max()) + 1) + w[pos] if len(pos) else pos, return_inverse=True, return_counts=True)
        keep = count[inverse] >= times
        keep &= np.bincount(piece, minlength=1)[piece] >= length
        if keep.mean() > 0.98 if len(keep) else True:  # what is left in excess costs time only
            return pos, inverse
        pos = pos[keep]


def suffix_array(t: np.ndarray) -> np.ndarray:
    """By doubling of the length that is compared, for suffixes that aren't told apart yet."""
    n = len(t)
    sa = np.argsort(t, kind="stable")
    new = np.flatnonzero(np.diff(t[sa], prepend=-1))
    size = np.diff(new, append=n)
    rank = np.full(n + 1, -1, np.int64)
    rank[sa] = np.repeat(new, size)
    slots, k = np.flatnonzero(np.repeat(size > 1, size)), 1
    while len(slots):
        at = sa[slots]
        key = rank[at] * (n + 1) + rank[np.minimum(at + k, n)] + 1
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
        sa[slots] = at
        new = np.flatnonzero(np.diff(key, prepend=-1))
        size = np.diff(new, append=len(key))
        rank[at] = np.repeat(slots[new], size)
        slots, k = slots[np.repeat(size > 1, size)], 2 * k
    return sa


def common(t: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from places a and b on are equal. ``t`` ends with a number that is nowhere else; a < b or b < a."""
    out = np.zeros(len(a), np.int64)
    open_ = np.arange(len(a))
    for k in range(32):
        open_ = open_[t[np.minimum(a[open_] + k, len(t) - 1)] == t[np.minimum(b[open_] + k, len(t) - 1)]]
        out[open_] = k + 1
        if not len(open_):
            return out
    for j in open_.tolist():
        x, y, m = int(a[j]) + 32, int(b[j]) + 32, 64
        while True:
            size = min(m, len(t) - max(x, y))
            differ = np.flatnonzero(t[x : x + size] != t[y : y + size])
            if len(differ):
                out[j] = x + differ[0] - a[j]
                break
            x, y, m = x + size, y + size, min(2 * m, 1 << 16)
    return out


def common_prefixes(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each place of the suffix array after the first, what its suffix has in common with the one before it. Only where the words before both differ it is counted; elsewhere it is one less than at the place before in the text."""
    n = len(sa)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    at = np.arange(n)
    counted = (before <= 0) | (at == 0)
    counted |= t[at - 1] != t[before - 1]
    pick = np.flatnonzero(counted & (before >= 0))
    length = np.zeros(n, np.int64)
    length[pick] = common(t, pick, before[pick])
    last = np.maximum.accumulate(np.where(counted, at, 0))
    return (length[last] - (at - last))[sa]


def nodes(depth: list[int]) -> tuple[list[int], list[int]]:
    """For each place of the suffix array the first place of its node's leaves before it, and the end of those from it on. Where children are of one node, the leftmost is split off first."""
    left, right, open_ = [0] * len(depth), [len(depth)] * len(depth), []
    for r in range(1, len(depth)):
        d = depth[r]
        while open_ and depth[open_[-1]] > d:
            right[open_.pop()] = r
        if open_:
            left[r] = open_[-1]
        open_.append(r)
    return left, right


def branching(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends and periods of all tandem repeats that the word after them breaks, sorted. ``t``: words, a number that is nowhere else at the end."""
    n = len(t) - 1
    sa = suffix_array(t[:-1])
    depth = common_prefixes(t, sa)
    depth[0] = 0
    left, right = (np.array(x, np.int64) for x in nodes(depth.tolist()))
    slot = np.empty(n, np.int64)
    slot[sa] = np.arange(n)
    r = np.flatnonzero(depth > 0)
    q, left, right = depth[r], left[r], right[r]
    small_left = r - left < right - r
    begin, end = np.where(small_left, left, r), np.where(small_left, r, right)  # the smaller side, and the other one
    lo, hi = np.where(small_left, r, left), np.where(small_left, right, r)
    upto = np.cumsum(end - begin)
    ends, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    first = 0
    while first < len(r):
        last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + LEAVES, "right")))
        size = (end - begin)[first:last]
        node = np.repeat(np.arange(first, last), size)
        leaf = sa[np.arange(len(node)) + np.repeat(begin[first:last] - np.cumsum(size) + size, size)]
        for other, start in ((leaf + q[node], leaf), (leaf - q[node], leaf - q[node])):
            fits = np.flatnonzero((other >= 0) & (other < n))
            at = slot[other[fits]]
            fits = fits[(at >= lo[node[fits]]) & (at < hi[node[fits]])]
            ends.append(start[fits] + 2 * q[node[fits]])
            periods.append(q[node[fits]])
        first = last
    ends, periods = np.concatenate(ends), np.concatenate(periods)
    order = np.lexsort((periods, ends))
    return ends[order], periods[order]


def merged(t: np.ndarray, ends: np.ndarray, periods: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and periods of the maximal runs of the branching repeats, sorted by end and period."""
    n = len(t) - 1
    back = np.append(t[-2::-1], -1)
    out = []
    while len(ends):
        head = np.flatnonzero(np.diff(ends, prepend=-1))  # the smallest period of each end
        e, q = ends[head], periods[head]
        start = e - 2 * q - common(back, n - (e - 2 * q), n - (e - q))
        out.append((start, e, q))
        own = np.repeat(start, np.diff(head, append=len(ends)))
        rest = ends - 2 * periods < own  # others lie in a run that ends there too, and repeat its period
        ends, periods = ends[rest], periods[rest]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (ends, ends, ends)


def runs_of(w: np.ndarray, length: int = LEAST_LENGTH, times: int = LEAST_TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of the runs, by start and period."""
    pos, t = uncut(w, length, times)
    if not len(pos):
        return (np.zeros(0, np.int64),) * 3
    t = np.append(t, -1).astype(np.int64)
    start, end, q = merged(t, *branching(t))
    good = end - start >= np.maximum(length, times * q)
    start, size, q = pos[start[good]], (end - start)[good], q[good]
    order = np.lexsort((q, start))
    return start[order], size[order], q[order]


def found(batch: pa.RecordBatch, length: int, times: int, reading: Reading | None) -> pa.RecordBatch:
    data, at = text_bytes(get(batch, "text"))
    ids, texts, words = get(batch, "doc_id").to_pylist(), [], []
    offset = 0
    for i, a, b in zip(ids, at[:-1].tolist(), at[1:].tolist(), strict=True):
        w, vocabulary = numbered(data[a:b])
        other = reading(i, len(w)) if reading else None
        w = w if other is None else w[other]
        texts.append((w, vocabulary))
        words.append(w.astype(np.int64) + offset)
        offset += len(vocabulary)
    bounds = np.cumsum([0] + [len(w) for w in words])
    start, size, q = runs_of(np.concatenate(words), length, times)
    del words
    gone = np.zeros(bounds[-1] + 1, np.int32)
    np.add.at(gone, start + q, 1)
    np.add.at(gone, start + size, -1)
    kept = np.cumsum(gone[:-1]) == 0
    doc = np.searchsorted(bounds, start, "right") - 1
    collapsed = []
    for k, (w, vocabulary) in enumerate(texts):
        left = w[kept[bounds[k] : bounds[k + 1]]]
        blocks = (b" ".join(map(vocabulary.__getitem__, left[x : x + WINDOW].tolist())) for x in range(0, len(left), WINDOW))
        collapsed.append(b" ".join(blocks))
        texts[k] = None
    spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start - bounds[doc], size, q)], ["start", "length", "period"])
    places = np.searchsorted(doc, np.arange(len(ids) + 1))
    runs = pa.ListArray.from_arrays(pa.array(places, pa.int32()), spans)
    return pa.RecordBatch.from_arrays([get(batch, "doc_id"), pa.array(np.diff(bounds)), runs, pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, length: int = LEAST_LENGTH, times: int = LEAST_TIMES, reading: Reading | None = None) -> DataFrame:
    """For each row of ``docs``: doc_id, n_words, runs (start, length, period, by start and period), collapsed. See the module for the cases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            yield found(batch, length, times, reading)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    with small_batches(docs.sparkSession):
        return scratch.written(spread(rows).mapInArrow(run, SCHEMA), "periodic-runs")


def digest(rows: DataFrame) -> DataFrame:
    """For each row of what ``periodic_runs`` gives: the longest run and hashes of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less"))))
    said = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    rows = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(said, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    rows = rows.withColumns({"start": -F.col("best.back"), "length": F.col("best.length"), "period": -F.col("best.less")})
    return rows.select("doc_id", "n_runs", "start", "length", "period", F.expr("(1000 * length) div period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")

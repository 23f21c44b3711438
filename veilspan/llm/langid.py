"""Language identification: multinomial naive Bayes over hashed character n-grams.

The n-grams of 1 to 3 code points of the lower-cased text are hashed into ``BUCKETS``
columns. Training adds up their counts by language over a bounded sample: the distinct
(doc_id, text, lang) rows among the eligible ones with the ``SAMPLE`` smallest hashes, whole
texts, with their copies. So there are at most ``SAMPLE`` languages. The counts that aren't
zero are broadcast, and make the matrix of log probabilities (languages x buckets) in the
worker, ``LANGS`` languages at a time; a batch is scored as sparse rows, by gathering the
matrix columns of its n-grams and summing them for each document, on top of the logarithm of
the language's share of the sample's rows. The score is the posterior probability of the
language that is predicted, tempered by ``TEMPERATURE`` so that long texts don't all score 1.

Defined results:

* a text that is null or has no letter (``str.isalpha``) is ``und`` with score 0
* rows with a null or repeated doc_id are predicted like others; a null id isn't held out
* without any training text each prediction is ``und`` with score 0
* ties go to the language that is first by code point
* a text of any length is read in pieces; beside the batch it comes in it takes some 250 MB
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspan.llm.arrow import get, slices, text_bytes
from veilspan.llm.quality import remainder

BUCKETS, SAMPLE, ALPHA, TEMPERATURE = 1 << 15, 8000, 0.5, 0.1
#: Languages whose part of the matrix is made at once (8 MB), and parts that a worker keeps.
LANGS, KEPT = 64, 8
#: Numbers gathered at once: a long text is scored in windows of so many by the number of languages.
WINDOW = 1 << 23
#: Bytes of a text that are made into code points at once; longer texts go in pieces.
LONG = 4 << 20
_tables: list[np.ndarray] = []


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point of the first plane: is it a letter, and its lower case."""
    if not _tables:
        chars = [chr(i) if not 0xD800 <= i < 0xE000 else " " for i in range(0x10000)]
        _tables.append(np.array([c.isalpha() for c in chars]))
        _tables.append(np.array([ord(low) if len(low := c.lower()) == 1 else ord(c) for c in chars], dtype=np.uint32))
    return _tables[0], _tables[1]


def code_points(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes to code points, and the documents' places among them."""
    lead = (data & 0xC0) != 0x80
    upto = np.concatenate([[0], np.cumsum(lead)])
    return np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32), upto[at]


def pieces(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Code points of texts, the texts' places among them, and how many of the first ones were there before. A text of more than LONG bytes comes by itself, in pieces that begin with the two code points before them."""
    if len(data) <= LONG or len(at) != 2:
        yield *code_points(data, at), 0
        return
    lo, tail = 0, np.zeros(0, np.uint32)
    while lo < len(data):
        hi = min(len(data), lo + LONG)
        while hi < len(data) and data[hi] & 0xC0 == 0x80:
            hi += 1
        points, _ = code_points(data[lo:hi], np.array([0, hi - lo]))
        points = np.concatenate([tail, points])
        yield points, np.array([0, len(points)]), len(tail)
        lo, tail = hi, points[-2:]


def grams(points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, their documents' places among them, and whether each document has a letter. The buckets come by n-gram length within windows of the batch."""
    alpha, lower = _letters()
    first_plane = points < 0x10000
    small = np.where(first_plane, points, 0)
    is_letter = alpha[small]
    if not first_plane.all():
        far = ~first_plane
        is_letter = is_letter.copy()
        is_letter[far] = [chr(c).isalpha() for c in points[far].tolist()]
    low = np.where(first_plane, lower[small], points)
    low = np.where(is_letter, low, 32).astype(np.uint32)
    n = len(low)
    has = np.add.reduceat(np.append(is_letter, False).astype(np.int64), at[:-1]) if n else np.zeros(len(at) - 1, np.int64)
    has[np.diff(at) == 0] = 0
    one = low * np.uint32(0x9E3779B1)
    two = np.zeros(n, np.uint32)
    two[1:] = (low[:-1] * np.uint32(0x85EBCA6B)) ^ one[1:]
    three = np.zeros(n, np.uint32)
    three[2:] = (low[:-2] * np.uint32(0xC2B2AE35)) ^ (two[2:] * np.uint32(0x27D4EB2F))
    own = np.arange(n) - np.repeat(at[:-1], np.diff(at))
    out = np.empty((n, 3), np.int32)
    for k, h in enumerate((one, two, three)):
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        out[:, k] = (h >> np.uint32(17)).astype(np.int32)
        if k:
            out[own < k, k] = BUCKETS  # reaches over the document's start: the empty column
    return out, at, has > 0


class Model:
    def __init__(self, langs: list[str], rows: np.ndarray, lang: np.ndarray, bucket: np.ndarray, n: np.ndarray):
        """rows: how many the sample has of each language; lang, bucket, n: the counts that aren't zero, by language."""
        self.langs, self.prior = langs, np.log(np.maximum(rows, 1) / max(1, rows.sum()))
        self.first = np.searchsorted(lang, np.arange(len(langs) + 1))
        self.bucket, self.n = bucket.astype(np.int32), n.astype(np.float64)
        self.parts: dict[int, np.ndarray] = {}

    def logs(self, lo: int) -> np.ndarray:
        """Log probabilities of LANGS languages from ``lo`` on, with a column of zeros for what isn't an n-gram."""
        if lo not in self.parts:
            if len(self.parts) == KEPT:
                self.parts.pop(next(iter(self.parts)))
            hi = min(lo + LANGS, len(self.langs))
            counts = np.full((hi - lo, BUCKETS), ALPHA)
            for k in range(lo, hi):
                own = slice(self.first[k], self.first[k + 1])
                counts[k - lo, self.bucket[own]] += self.n[own]
            logs = np.log(counts / counts.sum(1, keepdims=True))
            self.parts[lo] = np.vstack([logs.T, np.zeros((1, hi - lo))]).astype(np.float32)
        return self.parts[lo]

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return ["und"] * len(column), np.zeros(len(column))
        texts = text_bytes(column)
        has = np.zeros(len(column), bool)
        best, top = np.zeros(len(column), np.int64), np.full(len(column), -np.inf)
        weight = np.zeros(len(column))  # of all languages so far, as a multiple of the best one's
        for first in range(0, len(self.langs), LANGS):
            logs = self.logs(first)
            sums = np.repeat(self.prior[None, first : first + logs.shape[1]], len(column), 0)
            window = max(1, WINDOW // logs.shape[1])
            for points, at, skip in pieces(*texts):
                ids, at, some = grams(points, at)
                has |= some.astype(bool)
                for lo in range(skip, len(ids), window):
                    hi = min(len(ids), lo + window)
                    got = logs[ids[lo:hi, 0]]
                    got += logs[ids[lo:hi, 1]]
                    got += logs[ids[lo:hi, 2]]
                    d0, d1 = int(np.searchsorted(at, lo, "right")) - 1, int(np.searchsorted(at, hi, "left"))
                    inside = np.arange(d0, d1)
                    inside = inside[(at[inside] < at[inside + 1])]
                    marks = np.maximum(at[inside], lo) - lo
                    sums[inside] += np.add.reduceat(got.astype(np.float64), marks, axis=0)
            own = sums.argmax(1)
            high = sums[np.arange(len(own)), own]
            new = np.maximum(top, high)
            weight = weight * np.exp((top - new) * TEMPERATURE) + np.exp((sums - new[:, None]) * TEMPERATURE).sum(1)
            best, top = np.where(high > top, first + own, best), new
        score = np.where(has, 1 / weight, 0.0)
        return [self.langs[b] if h else "und" for b, h in zip(best.tolist(), has.tolist(), strict=True)], score


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of one task: a row for each language and bucket that occurs, and the number of texts as bucket -1. A language may come several times."""
    total: dict[str, np.ndarray] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, own in total.items():
            some = np.append(np.flatnonzero(own[:BUCKETS]), -1)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(own[some])], ["lang", "bucket", "n"])
        total.clear()

    for batch in slices(batches, "text"):
        langs = get(batch, "lang").to_pylist()
        for points, at, skip in pieces(*text_bytes(get(batch, "text"))):
            ids, at, _ = grams(points, at)
            for d, lang in enumerate(langs):
                own = total.setdefault(lang, np.zeros(BUCKETS + 2, np.int64))  # the last two: no n-gram, texts
                own[: BUCKETS + 1] += np.bincount(ids[max(skip, at[d]) : at[d + 1]].ravel(), minlength=BUCKETS + 1)
                own[-1] += not skip
                if len(total) > LANGS:
                    yield from out()
    yield from out()


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from text and lang of documents whose crc32(doc_id) mod 4 isn't 2. The driver gets at most BUCKETS + 1 counts for each language of the sample, as Arrow columns."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where("doc_id is not null and text is not null and lang is not null").where(remainder(4) != 2)
    h = F.xxhash64("doc_id", "text", "lang")
    limit = rows.select(h.alias("h")).distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if limit is None:
        none = np.zeros(0, np.int64)
        return Model([], none, none, none, none)
    counts = rows.where(h <= limit).mapInArrow(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    langs = sorted(found["lang"].unique().to_pylist(), key=lambda s: s.encode("utf-8", "surrogatepass"))
    code = found["lang"].combine_chunks().dictionary_encode()
    code = code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code
    place = {s: k for k, s in enumerate(langs)}
    lang = np.array([place[s] for s in code.dictionary.to_pylist()], np.int64)[code.indices.to_numpy(zero_copy_only=False)]
    bucket, n = found["bucket"].to_numpy(), found["n"].to_numpy()
    texts = bucket < 0
    each = np.zeros(len(langs), np.int64)
    each[lang[texts]] = n[texts]
    lang, bucket, n = lang[~texts], bucket[~texts], n[~texts]
    by = np.lexsort((bucket, lang))
    return Model(langs, each, lang[by], bucket[by], n[by])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """For each row: doc_id, held_out, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, "text"):
            langs, score = own.predict(get(batch, "text"))
            yield pa.RecordBatch.from_arrays([get(batch, "doc_id"), get(batch, "held_out"), pa.array(langs, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")

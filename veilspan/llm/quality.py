"""Quality classifier: a convolutional network over bytes, in numpy.

A whole text is cut into chunks of ``CHUNK`` bytes that overlap by the filters' width
less one, so that each place where a filter fits lies in exactly one chunk. Learned
filters (an embedding of the byte at each of ``WIDTH`` places, summed) run over every
place; each filter is max-pooled within each chunk; the means and the maxima over the
document's chunks are combined by a logistic layer into one probability.

Training takes a bounded sample of labelled rows that have a document: at most ``SAMPLE``
distinct ones with the smallest hash of their id, as long as their texts fit into
``SAMPLE_BYTES``, with all chunks of their whole texts. Scoring has no bounds.

Defined results:

* a null or empty text is one chunk of zero bytes and has a score like any other
* a text shorter than a filter is padded by zero bytes
* rows with a null or repeated doc_id are scored like others; a null id isn't held out
* without any usable label, or with one class only, each score is the share of label 1
  (0.5 without labels)
* where a document has several labels, or an id several texts, each pair of them teaches;
  null labels and labels without a document don't, nor do they take up the sample
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspan.llm.arrow import get, slices, text_bytes
from veilspan.llm.sample import sampled

WIDTH, FILTERS, CHUNK = 4, 8, 512
#: Places that begin in a chunk.
STEP = CHUNK - WIDTH + 1
SAMPLE, SAMPLE_BYTES, STEPS, RATE, SEED = 3000, 24 << 20, 900, 0.01, 5
#: Chunks whose places are computed at once in training.
BLOCK = 1024
THRESHOLD = 0.3


def pieces(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all chunks in ``data``, and for each document its first chunk's number. Every document has one chunk at least."""
    sizes = np.diff(at)
    count = np.maximum(1, -(-np.maximum(sizes - WIDTH + 1, 1) // STEP))
    first = np.concatenate([[0], np.cumsum(count)])
    inner = np.arange(first[-1]) - np.repeat(first[:-1], count)
    return np.repeat(at[:-1], count) + inner * STEP, first


def pooled(data: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each filter's maximum in each chunk, and the documents' first chunks. ``table``: WIDTH x 256 x FILTERS."""
    starts, first = pieces(data, at)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(first))
    padded = np.concatenate([data, np.zeros(WIDTH, np.uint8)])
    pair = padded[:-1].astype(np.int32) * 256 + padded[1:]
    head = (table[0][:, None, :] + table[1][None, :, :]).reshape(65536, -1)
    tail = (table[2][:, None, :] + table[3][None, :, :]).reshape(65536, -1)
    n = len(data)
    if not n:
        return np.repeat((head[0] + tail[0])[None, :], len(starts), 0), first
    out = np.empty((len(starts), table.shape[2]), np.float32)
    ends = np.minimum(starts + STEP, np.maximum(at[1:][owner] - WIDTH + 1, at[:-1][owner] + 1))
    block = 1 << 17
    plain = np.diff(at)[owner] >= WIDTH
    # whole chunks follow each other, so that one pass over the places gives their maxima
    k = 0
    while k < len(starts):
        j = max(k + 1, int(np.searchsorted(starts, starts[k] + block, side="left")))
        lo, hi = int(starts[k]), int(ends[k:j].max())
        hi = max(hi, lo + 1)
        hi = min(hi, n)
        if lo >= n:  # empty documents at the very end
            out[k:j] = head[0] + tail[0]
        else:
            act = head[pair[lo:hi]]
            act += tail[pair[lo + 2 : hi + 2]]
            s, e = starts[k:j], ends[k:j]
            good = plain[k:j] & (s < n)
            if good.any():
                marks = np.empty(2 * int(good.sum()), np.int64)
                marks[0::2], marks[1::2] = s[good] - lo, e[good] - lo
                inside = marks < len(act)
                marks = marks[inside] if inside.all() else marks[: int(np.argmin(inside))]
                out[k:j][good] = np.maximum.reduceat(act, marks, axis=0)[0::2]
        k = j
    for k in np.flatnonzero(~plain):  # shorter than a filter
        text = data[at[owner[k]] : at[owner[k] + 1]]
        own = np.zeros(WIDTH, np.uint8)
        own[: len(text)] = text
        out[k] = sum(table[p][own[p]] for p in range(WIDTH))
    return out, first


def combined(chunk_max: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A document's features: the mean and the maximum over its chunks of each filter, after a rectifier."""
    act = np.maximum(chunk_max, 0)
    count = np.diff(first)[:, None]
    return np.concatenate([np.add.reduceat(act, first[:-1], axis=0) / count, np.maximum.reduceat(act, first[:-1], axis=0)], axis=1)


class Network:
    def __init__(self, table: np.ndarray, weight: np.ndarray, bias: float):
        self.table, self.weight, self.bias = table.astype(np.float32), weight, bias

    def scores(self, column: pa.Array) -> np.ndarray:
        data, at = text_bytes(column)
        z = combined(*pooled(data, at, self.table)).astype(np.float64) @ self.weight + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def constant(p: float) -> Network:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return Network(np.zeros((WIDTH, 256, FILTERS)), np.zeros(2 * FILTERS), float(np.log(p / (1 - p))))


def chunk_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CHUNK bytes from each start on, zero from the text's end on."""
    place = starts[:, None] + np.arange(CHUNK)[None, :]
    return np.where(place < ends[:, None], data[np.minimum(place, len(data) - 1)], 0).astype(np.uint8)


def train(texts: list[bytes], labels: np.ndarray) -> Network:
    """Learn from whole texts."""
    if not len(labels) or labels.min() == labels.max():
        return constant(float(labels.mean()) if len(labels) else 0.5)
    rng = np.random.default_rng(SEED)
    sizes = np.array([len(t) for t in texts], np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    starts, first = pieces(np.zeros(0, np.uint8), at)
    places = np.clip(np.repeat(at[1:], np.diff(first)) - starts - WIDTH + 1, 1, STEP)
    data = np.frombuffer(b"".join(texts) + bytes(CHUNK), np.uint8)
    ends = np.repeat(at[1:], np.diff(first))
    chunks = np.concatenate([chunk_bytes(data, starts[k : k + BLOCK], ends[k : k + BLOCK]) for k in range(0, len(starts), BLOCK)])
    table = rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
    weight, bias = rng.normal(0, 0.3, 2 * FILTERS), 0.0
    params = [table, weight, np.zeros(1)]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    order = np.arange(len(labels))
    while step < STEPS:
        rng.shuffle(order)
        for part in np.array_split(order, max(1, len(order) // 64)):
            take = np.concatenate([np.arange(first[d], first[d + 1]) for d in part])
            own = np.concatenate([[0], np.cumsum(first[part + 1] - first[part])])
            best, top = np.empty((len(take), FILTERS), np.int64), np.empty((len(take), FILTERS), np.float32)
            for lo in range(0, len(take), BLOCK):
                some = take[lo : lo + BLOCK]
                x = chunks[some]
                act = sum(table[p][x[:, p : STEP + p]] for p in range(WIDTH))
                act[np.arange(STEP)[None, :] >= places[some][:, None]] = -1e9
                best[lo : lo + BLOCK] = act.argmax(1)
                top[lo : lo + BLOCK] = act.max(1)
            relu, count = np.maximum(top, 0), np.diff(own)
            peak = np.maximum.reduceat(relu, own[:-1], axis=0)
            feats = np.concatenate([np.add.reduceat(relu, own[:-1], axis=0) / count[:, None], peak], 1)
            prob = 1 / (1 + np.exp(-np.clip(feats @ weight + params[2][0], -30, 30)))
            err = (prob - labels[part]) / len(part)
            g_feat = err[:, None] * weight[None, :]
            doc = np.repeat(np.arange(len(part)), count)
            g_top = g_feat[doc, :FILTERS] / count[doc][:, None]
            is_peak = relu == peak[doc]
            g_top = (g_top + g_feat[doc, FILTERS:] * is_peak / np.maximum(np.add.reduceat(is_peak, own[:-1], axis=0), 1)[doc]) * (top > 0)
            g_table = np.zeros_like(table)
            f = np.arange(FILTERS)[None, :].repeat(len(take), 0)
            for p in range(WIDTH):
                byte = chunks[take[:, None], best + p]
                np.add.at(g_table[p], (byte.ravel(), f.ravel()), g_top.ravel())
            step += 1
            for k, g in enumerate((g_table + 1e-5 * table, feats.T @ err + 1e-4 * weight, np.array([err.sum()]))):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                params[k] -= (RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(params[k].dtype)
    return Network(table, weight, float(params[2][0]))


def remainder(modulus: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Network:
    """Learn from ``labels`` of documents whose crc32(doc_id) mod 5 isn't 0."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)").where(remainder(5) != 0)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def rows(below: Column) -> DataFrame:
        return texts.where(below).join(usable.where(below), "doc_id").select("doc_id", "quality", "text")

    some = sampled(rows, usable.count(), sample, sample_bytes)
    found = [] if some is None else sorted(some.select("doc_id", "quality", "text").collect())
    return train([r["text"].encode("utf-8", "replace") for r in found], np.array([r["quality"] for r in found], float))


def score(docs: DataFrame, network: Network, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a column ``out``: the probability of label 1 for the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast((network.table, network.weight, network.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network(*shared.value)
        for batch in slices(batches, text):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.scores(get(batch, text)), pa.float64())], [*batch.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def classify(docs: DataFrame, network: Network) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return score(rows, network).drop("text").withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

import zlib

import numpy as np
import pyarrow as pa
import pytest

from veilspan.llm import quality as q


def naive(text: bytes, table):
    """Maxima by chunk, from the definition."""
    text = text.ljust(q.WIDTH, b"\0") if len(text) < q.WIDTH else text
    act = np.array([sum(table[p][text[i + p]] for p in range(q.WIDTH)) for i in range(len(text) - q.WIDTH + 1)])
    return np.array([act[k : k + q.STEP].max(0) for k in range(0, len(act), q.STEP)])


def test_pooling_covers_the_whole_text():
    rng = np.random.default_rng(0)
    table = rng.normal(size=(q.WIDTH, 256, q.FILTERS)).astype(np.float32)
    texts = ["", "a", "abc", "abcd", "é" * 300, "x" * 508 + "é", "ab" * 5000, "", "z" * q.STEP, "y" * (q.STEP + q.WIDTH - 1), "w" * (q.STEP + q.WIDTH), "end", ""]
    from veilspan.llm.arrow import text_bytes

    data, at = text_bytes(pa.array(texts))
    out, first = q.pooled(data, at, table)
    for d, t in enumerate(texts):
        np.testing.assert_allclose(out[first[d] : first[d + 1]], naive(t.encode(), table), rtol=1e-4, atol=1e-4)


def test_scores_are_those_of_the_definition():
    rng = np.random.default_rng(7)
    net = q.Network(rng.normal(size=(q.WIDTH, 256, q.FILTERS)), rng.normal(size=2 * q.FILTERS), 0.3)
    texts = ["", "a", "plain prose", "é" * 900, "ab" * 3000, None]
    for t, score in zip(texts, net.scores(pa.array(texts)), strict=True):
        top = np.maximum(naive((t or "").encode(), net.table), 0)
        want = 1 / (1 + np.exp(-(np.concatenate([top.mean(0), top.max(0)]) @ net.weight + net.bias)))
        assert abs(score - want) < 1e-4


def test_training_sees_what_scoring_sees():
    """Chunks, ends and padding in training give the maxima of the definition."""
    from veilspan.llm.arrow import text_bytes

    texts = ["", "a", "abc", "é" * 700, "x" * 508 + "é", "z" * q.STEP, "end"]
    data, at = text_bytes(pa.array(texts))
    starts, first = q.pieces(data, at)
    padded, ends = np.append(data, np.zeros(q.CHUNK, np.uint8)), np.repeat(at[1:], np.diff(first))
    x = q.chunk_bytes(padded, starts, ends)
    for k, (s, e) in enumerate(zip(starts, ends, strict=True)):
        assert x[k].tobytes() == data[s : min(e, s + q.CHUNK)].tobytes().ljust(q.CHUNK, b"\0")


def test_gradient_is_that_of_the_loss(monkeypatch):
    """A signal that only the last chunk of long texts has is learned."""
    monkeypatch.setattr(q, "STEPS", 120)
    monkeypatch.setattr(q, "BLOCK", 7)
    rng = np.random.default_rng(3)
    body = lambda n: bytes(rng.integers(97, 105, n).astype(np.uint8))
    texts = [body(20_000 if k % 7 == 0 else 300) + (b"WXYZ" if k % 2 else b"") for k in range(60)]
    net = q.train(texts, np.arange(60) % 2.0)
    scores = net.scores(pa.array([t.decode() for t in texts]))
    assert ((scores > 0.5) == (np.arange(60) % 2 == 1)).mean() > 0.95


def test_labels_without_documents_take_up_no_sample(spark, make_docs):
    docs = make_docs([(k, ("good prose here " if k % 2 else "x#!? ") * 9) for k in range(1, 60)], clash=False)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(1, 20_000)], "doc_id long, quality int, toxic int")
    net = q.fit(docs, labels, sample=40)
    out = {r.doc_id: r.score for r in q.classify(docs, net).collect()}
    assert np.mean([out[k] > 0.5 for k in out if k % 2]) > 0.9 > 0.1 > np.mean([out[k] > 0.5 for k in out if k % 2 == 0])


def test_sample_is_bounded_and_of_distinct_rows(spark, make_docs):
    from pyspark.sql import functions as F

    from veilspan.llm.sample import sampled

    docs = make_docs([(k % 40, "same") for k in range(4000)] + [(k, "y" * k) for k in range(100, 200)] + [(7, "z" * 50_000)], clash=False)
    pick = lambda n, size, d=docs: sampled(lambda below: d.where(below).select("doc_id", "text"), d.count(), n, size)
    a = {(r.doc_id, r.text) for r in pick(30, 10_000).collect()}
    assert len(a) == 30 == pick(30, 10_000).count() and a == {(r.doc_id, r.text) for r in pick(30, 10_000, docs.repartition(5)).collect()}
    assert pick(10_000, 1 << 20).count() == 141 and pick(10_000, 49_999).where(F.length("text") > 1000).count() == 0
    assert sum(len(r.text) for r in pick(10_000, 3000).collect()) <= 3000 and pick(10, 0) is None


def test_learns_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = {r.doc_id: r for r in q.classify(docs, q.fit(docs, labels)).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for i, r in out.items())
    held = [(r.quality, out[r.doc_id].score) for r in labels.collect() if out[r.doc_id].held_out]
    good, bad = [s for y, s in held if y], [s for y, s in held if not y]
    assert np.mean([a > b for a in good for b in bad]) > 0.95
    assert np.mean([s >= 0.3 for s in good]) > 0.95


def test_cases(spark, make_docs):
    rows = [(1, None), (2, ""), (3, "a"), (None, "text"), (4, "same"), (4, "same"), (5, "long " * 100_000)]
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    docs = make_docs(rows)
    out = q.classify(docs, q.fit(docs, labels)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out) and not [r for r in out if r.doc_id is None][0].held_out
    none = q.classify(docs, q.fit(docs, labels.limit(0))).collect()
    assert all(r.score == pytest.approx(0.5) for r in none)
    assert q.classify(make_docs([]), q.fit(make_docs([]), labels)).count() == 0

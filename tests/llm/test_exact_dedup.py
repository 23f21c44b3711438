import hashlib
import re

import pyspark.sql.functions as F
import pytest

from veilspan.llm.exact_dedup import DigestIndex, exact_dedup


def brute(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    out = []
    for i, t in norm:
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(5, "a b"), (3, "a\t\n b"), (9, "a b "), (4, ""), (2, None), (7, None), (None, "a b"), (8, "x" * 200_000), (6, "x" * 200_000), (1, "é b"), (10, "é b"), (10, "é b"), (None, "lone"), (None, "lone")]


def got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()], key=str)


def test_cases(make_docs):
    assert got(exact_dedup(make_docs(ROWS))) == brute(ROWS)


def test_equal_digests_are_told_apart_by_their_bytes(make_docs):
    weak = got(exact_dedup(make_docs(ROWS), digest=lambda norm: F.unhex(F.substring(F.sha2(norm, 256), 1, 1))))
    assert [r[:4] for r in weak] == [r[:4] for r in brute(ROWS)]


def test_hot_group(make_docs):
    rows = [(i, "same text") for i in range(3000)] + [(3000 + i, f"other {i % 50}") for i in range(100)]
    assert got(exact_dedup(make_docs(rows))) == brute(rows)


def test_empty(make_docs):
    assert exact_dedup(make_docs([])).count() == 0


def test_index_takes_several_memtables(spark, make_docs):
    index = DigestIndex(spark)
    index.flush(make_docs([(4, "p q"), (5, "r")]))
    index.flush(make_docs([(1, "p  q"), (6, "s")]))
    index.compact()
    assert sorted((r.keep_id, r.n) for r in index.level().collect()) == [(1, 2), (5, 1), (6, 1)]
    assert index.contains("p\nq") and not index.contains("t")
    index.compact()  # nothing new
    index.flush(make_docs([(0, "r"), (7, "t"), (None, "s")]))
    index.compact()
    assert sorted((r.keep_id, r.n) for r in index.level().collect()) == [(0, 2), (1, 2), (6, 2), (7, 1)]
    assert index.contains("t")


def test_the_level_decides_and_texts_confirm_it(make_docs, monkeypatch):
    """A level with another identifier than the texts have is an error, not a result."""
    level = DigestIndex.level
    monkeypatch.setattr(DigestIndex, "level", lambda self: level(self).withColumn("keep_id", F.col("keep_id") - 1))
    with pytest.raises(Exception, match="the index and the texts differ"):
        exact_dedup(make_docs([(4, "p q"), (5, "p q")])).collect()


def test_against_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(exact_dedup(docs)) == brute(rows)

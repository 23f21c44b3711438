"""Order statistics against sorted lists; headers carried by verdicts."""

import random

import pytest
from pyspark.sql import functions as F

from veilspan.operators import layout, ranks

def places():
    return {"p50": F.floor(F.col("n") * 50 / F.lit(100.0)), "p99": F.floor(F.col("n") * 99 / F.lit(100.0)), "third": F.lit(2)}


@pytest.mark.parametrize("bucket", [1, 10, 4096])
def test_against_sorted_lists(spark, monkeypatch, bucket):
    monkeypatch.setattr(ranks, "BUCKET", bucket)
    rng = random.Random(bucket)
    rows = [(d, rng.choice([None, rng.randrange(-50, 50), rng.randrange(-10**6, 10**6), 7])) for d in range(12) for _ in range(rng.choice([1, 2, 3, 100, 101]))]
    df = spark.createDataFrame(rows, "doc int, v int")

    def want(values):
        s = sorted(values)
        return (len(s), s[0], s[-1], s[int(len(s) * 50 / 100)], s[int(len(s) * 99 / 100)], s[2] if len(s) > 2 else None)

    by = {}
    for d, v in rows:
        if v is not None:
            by.setdefault(d, []).append(v)
    got = {r.doc: tuple(r)[1:] for r in ranks.order_statistics(df, ["doc"], "v", places()).collect()}
    assert got == {d: want(v) for d, v in by.items()}
    assert [tuple(r) for r in ranks.order_statistics(df, [], "v", places()).collect()] == [want([v for _, v in rows if v is not None])]
    assert ranks.order_statistics(df.where("v is null"), [], "v", places()).count() == 0


@pytest.mark.parametrize("k", [1, 4, 15, 1000])
def test_largest_gaps_with_ties(spark, k):
    rng = random.Random(k)
    rows = [(d, p, n, i, rng.choice([10, 20, 30]) if i else None, rng.choice("abc")) for d in range(3) for p in range(3) for n in range(6) for i in range(4)]
    said = {(d, p, n): " ".join(r[5] for r in rows if r[:3] == (d, p, n)) for d, p, n, *_ in rows}
    want = sorted(((g, d, p, said[d, p, n]) for d, p, n, _, g, _ in rows if g), reverse=True)[:k]
    df = spark.createDataFrame(rows, "doc int, page int, line int, seq int, gap int, text string").withColumn("y", F.lit(0))
    assert [tuple(r) for r in layout.largest_gaps(df, ["doc", "page", "line"], k).collect()] == want


def test_headers_are_carried_until_a_verdict_ends_the_table(spark):
    pages = [(1, 0, ["a", "b"]), (1, 1, None), (1, 2, None), (1, 3, None), (1, 4, ["c"]), (1, 7, None), (2, 0, None), (2, 1, None), (3, 0, ["x"]), (3, 1, ["y"]), (3, 2, None)]
    goes = {(1, 0, 1): True, (1, 1, 2): True, (1, 2, 3): False, (1, 3, 4): True, (1, 4, 7): True, (2, 0, 1): True, (3, 0, 1): True, (3, 1, 2): True}
    p = spark.createDataFrame(pages, "doc int, page_index int, header array<string>")
    v = spark.createDataFrame([(*k, f) for k, f in goes.items()], "doc int, page_index int, next_page_index int, fires boolean")
    got = {(r.doc, r.page_index): r.header for r in layout.carried_headers(p, v, ["doc"]).collect()}
    # page 3 of document 1 ends its table, and page 4 goes on with one that has no header
    assert got == {(1, 1): ["a", "b"], (1, 2): ["a", "b"], (1, 7): ["c"], (3, 1): ["x"], (3, 2): ["y"]}

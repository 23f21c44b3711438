import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veilspan.llm import decontam as dc
from veilspan.llm.arrow import text_bytes


def greedy(a, b, least):
    """Longest common run of unmarked words, first in a, then in b, again and again."""
    ma, mb, out = [False] * len(a), [False] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not ma[i + k] and not mb[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < least:
            return out
        k, i, j = best
        out.append((i, j, k))
        ma[i : i + k] = [True] * k
        mb[j : j + k] = [True] * k


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=18), st.lists(st.integers(0, 3), max_size=24), st.integers(1, 4))
def test_tiles_are_the_greedy_ones(a, b, least):
    code = np.array([11400714819323198485, 14029467366897019727, 1609587929392839161, 9650029242287828579], np.uint64)
    got = dc.tile(code[np.array(a, int)], code[np.array(b, int)], least)
    assert sum(t[2] for t in got) == sum(t[2] for t in greedy(a, b, least))
    assert sorted(got) == sorted(greedy(a, b, least))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=18), st.lists(st.integers(0, 2), min_size=1, max_size=24), st.integers(1, 4), st.integers(1, 60))
def test_diagonals_give_the_same_tiles(a, b, least, most):
    before, dc.MOST_PAIRS = dc.MOST_PAIRS, most
    try:
        test_tiles_are_the_greedy_ones.hypothesis.inner_test(a, b, least)
    finally:
        dc.MOST_PAIRS = before


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=18), st.lists(st.integers(0, 5), max_size=24), st.integers(1, 4))
def test_words_are_checked_after_their_hashes(a, b, least):
    """With hashes that many words share, the words themselves decide."""
    weak = lambda x: np.array([v % 2 + 1 for v in x], np.uint64)
    got = dc.tile(weak(a), weak(b), least, lambda i, j, n: np.array([a[i + k] == b[j + k] for k in range(n)]))
    assert sorted(got) == sorted(greedy(a, b, least))


def test_repetitive_texts_take_memory_in_proportion():
    import tracemalloc

    item, text = (dc.Texts(*text_bytes(pa.array([t]))) for t in ("la la la la " * 500, "la " * 18_000))
    tracemalloc.start()
    found = dc.leak(item.words(0), text.words(0), 5, 0.5)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == (1.0, 1, 2000) and most < 120 << 20


def passage(rng, n):
    return [f"w{rng.randrange(10**7)}" for _ in range(n)]


@pytest.fixture
def case(spark, make_docs):
    rng = random.Random(4)
    items = [passage(rng, 40) for _ in range(30)]
    rows, want = [], set()
    for k, it in enumerate(items[:10]):
        body = passage(rng, 200)
        halves = it[20:] + passage(rng, 30) + it[:20]
        rows += [(k, " ".join(body + it + body)), (100 + k, " ".join(body + halves)), (200 + k, " ".join(body + it[:15] + body[::-1])), (300 + k, ", ".join(w.upper() for w in it))]
        want |= {(k, k), (100 + k, k), (300 + k, k)}
    rows += [(900, None), (901, ""), (902, "short"), (903, " ".join(passage(rng, 30_000))), (None, " ".join(items[11])), (904, " ".join(items[12])), (904, " ".join(items[12]))]
    want |= {(None, 11), (904, 12)}
    bench = spark.createDataFrame([(k, " ".join(it)) for k, it in enumerate(items)] + [(77, None), (78, "too short"), (79, "")], "item_id long, text string")
    return make_docs(rows), bench, want


def test_reordered_passages_are_found(case):
    docs, bench, want = case
    assert {(r.doc_id, r.item_id) for r in dc.leaks(docs, bench).collect()} == want


def test_join_finds_the_same(case):
    docs, bench, want = case
    a = sorted(map(tuple, dc.leaks(docs, bench).collect()), key=str)
    assert sorted(map(tuple, dc.leaks(docs, bench, broadcast_bytes=0).collect()), key=str) == a


def test_clean_keeps_the_rest(case):
    docs, bench, want = case
    kept = dc.clean(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()} - {d for d, _ in want}


@pytest.mark.parametrize("broadcast_bytes", [dc.BROADCAST_BYTES, 0])
def test_a_long_passage_of_a_longer_item(spark, make_docs, broadcast_bytes):
    rng = random.Random(8)
    items = [passage(rng, 59), passage(rng, 2000), passage(rng, 300)]
    copies = [items[0][20:48], items[1][300:1200], items[2][100:200], items[2][:16], items[2][:15], items[2][:10] + ["x"] + items[2][50:60]]
    rows = [(k, " ".join(passage(rng, 50) + c + passage(rng, 50))) for k, c in enumerate(copies)]
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    found = dc.leaks(make_docs(rows), bench, broadcast_bytes=broadcast_bytes).collect()
    assert sorted((r.doc_id, r.item_id, r.longest) for r in found) == [(0, 0, 28), (1, 1, 900), (2, 2, 100), (3, 2, 16)]


@pytest.mark.parametrize("broadcast_bytes", [dc.BROADCAST_BYTES, 0])
def test_short_items_and_scripts_without_spaces(spark, make_docs, broadcast_bytes):
    items = ["Paris, France!", "who", "one two three four", "東京は日本の首都です", "กรุงเทพ", "", "...", "𠀀𠀁", "no one has it"]
    texts = ["paris france", "in Paris -- France, we", "Paris in France", "WHO?", "whoever", "one two three", "zero one two three four five", "x東京は日本の首都y", "首都は京都", "ไปกรุงเทพแล้ว", "กรุง", "", None, "a𠀀𠀁b", "𠀁𠀀"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = dc.leaks(make_docs(list(enumerate(texts))), bench, broadcast_bytes=broadcast_bytes).collect()
    want = [(0, 0, 1.0), (1, 0, 1.0), (3, 1, 1.0), (6, 2, 1.0), (7, 3, 0.8), (9, 4, 1.0), (13, 7, 1.0)]
    assert sorted((r.doc_id, r.item_id, r.coverage) for r in found) == want


def test_empty(spark, make_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert dc.leaks(make_docs([(1, "a b c d e f")]), bench).count() == 0
    assert dc.leaks(make_docs([]), bench).count() == 0


def test_whole_table_against_all_pairs(spark, small):
    docs, bench = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/benchmark.parquet")
    d, b = docs.collect(), bench.collect()
    (h, at), (g, to) = (dc.tokens(*text_bytes(pa.array([r.text for r in rows]))) for rows in (d, b))
    want = set()
    for i, r in enumerate(d):
        for j, s in enumerate(b):
            item, words = g[to[j] : to[j + 1]], h[at[i] : at[i + 1]]
            if np.isin(item, words).mean() >= dc.COVERAGE and sum(t[2] for t in dc.tile(item, words)) >= dc.COVERAGE * len(item):
                want.add((r.doc_id, s.item_id))
    assert {(r.doc_id, r.item_id) for r in dc.leaks(docs, bench).collect()} == want and want

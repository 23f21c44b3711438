import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veilspan.llm import periodic_runs as pr
from veilspan.llm.queries import op13_periodic_runs, planted


def brute(w, length=6, times=4):
    """All stretches of each period that can't be made longer; of equal stretches the smallest period."""
    best = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(length, times * q):
                best.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((a, n, q) for (a, n), q in best.items())


def got(w, length=6, times=4):
    return [tuple(map(int, x)) for x in zip(*pr.runs_of(np.array(w, np.int64), length, times), strict=True)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.sampled_from([(2, 2), (6, 4), (5, 3), (3, 2)]))
def test_small_alphabets(w, least):
    assert got(w, *least) == brute(w, *least)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(1, 9)), max_size=8))
def test_repeated_blocks(blocks):
    w = [x for b, n in blocks for x in b * n]
    assert got(w) == brute(w)
    assert got(w, 2, 2) == brute(w, 2, 2)


@pytest.mark.parametrize("seed", range(6))
def test_long_periods(seed):
    rng = random.Random(seed)
    unit = [rng.randrange(40) for _ in range(rng.randrange(40, 200))]
    w = [rng.randrange(1000) for _ in range(300)] + (unit * 6)[: 5 * len(unit) + 7] + [rng.randrange(30) for _ in range(300)] + [5] * 200
    assert got(w) == brute(w)


def test_one_word_and_fibonacci_words_take_little_time():
    n = 200_000
    assert got([7] * n) == [(0, n, 1)]
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    assert got(b, 2, 2) == brute(b, 2, 2)
    unit = list(range(1000))
    assert got(unit * 200) == [(0, 200_000, 1000)]


def test_words_of_a_text_are_read_in_windows(monkeypatch):
    text = b"a  bb\tccc\n a \x0b\x0cdddddddddddddddd " * 3 + b"\xc2\xa0x\x1cy"
    for window in (1, 2, 5, 1 << 20):
        monkeypatch.setattr(pr, "WINDOW", window)
        ids, vocabulary = pr.numbered(np.frombuffer(text, np.uint8))
        assert [vocabulary[i] for i in ids] == re.findall(rb"[^\x20\x09-\x0D]+", text)
    assert pr.numbered(np.zeros(0, np.uint8))[1] == []


def expected(doc_id, text, reading=None):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if reading is not None and (other := reading(doc_id, len(words))) is not None:
        words = [words[i] for i in other]
    runs = brute(words)
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return (doc_id, len(words), runs, " ".join(x for i, x in enumerate(words) if i not in gone))


def rows_of(df):
    return sorted([(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in df.collect()], key=str)


def test_cases(make_docs):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "no no no no no"), (5, "no " * 6), (None, "a b " * 4), (7, "x " + "a b c " * 4 + "a b y z z z z z z"), (7, "A a A a A a A a"), (8, "é ü " * 9), (9, "w" * 300_000 + " z" * 9)]
    assert rows_of(pr.periodic_runs(make_docs(rows))) == sorted([expected(*r) for r in rows], key=str)


def test_empty(make_docs):
    assert pr.periodic_runs(make_docs([])).count() == 0


def test_a_long_text(make_docs):
    rng = random.Random(3)
    words = [f"w{rng.randrange(500)}" for _ in range(300_000)]
    words[1000:1000] = [f"p{i}" for i in range(20_000)] * 5
    (row,) = pr.periodic_runs(make_docs([(1, " ".join(words))])).collect()
    assert (1000, 100_000, 20_000) in [tuple(r) for r in row.runs]
    assert len(row.collapsed.split()) <= len(words) - 80_000


def by_formula(doc_id, n):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [i if i < a else a + (i - a) % p for i in range(n)]


def test_planted_words():
    for i in range(300):
        for n in (0, 1, 7, 100):
            want, other = by_formula(i, n), planted(i, n)
            assert (other is None and want is None) or other.tolist() == want
    assert planted(None, 5) is None


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    want = []
    for d in docs:
        i, _, runs, text = expected(d.doc_id, d.text, by_formula)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if runs else None
        said = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        want.append((i, len(runs), *best, milli, hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    out = op13_periodic_runs(spark, small)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(tuple(r) for r in out.collect()) == sorted(want)
    assert sum(r[1] > 0 for r in want) > 10

import random
import re
import string

import pytest

from veilspan.llm import near_dedup as nd

LOW = {ord(a): a.lower() for a in string.ascii_uppercase}


def sets(rows, words):
    out = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        out[i] = frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])
    return out


def brute(rows, words=5, percent=80):
    s = sets(rows, words)
    up = {i: i for i in s}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    ids = sorted(s)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if s[a] and s[b]:
                same = len(s[a] & s[b])
                if 100 * same >= percent * (len(s[a]) + len(s[b]) - same):
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
    return sorted((i, len(s[i]), find(i), find(i) == i) for i in ids)


def got(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


@pytest.mark.parametrize("words", [2, 5])
def test_whole_table(spark, small, words):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert got(nd.near_dedup(docs, words)) == brute([(r.doc_id, r.text) for r in docs.collect()], words)


def edited(rng, base, share):
    return " ".join(w if rng.random() > share else f"q{rng.randrange(10**6)}" for w in base)


@pytest.mark.parametrize("length", [12, 60, 400])
def test_long_lists_with_chains_of_links(make_docs, length, monkeypatch):
    monkeypatch.setattr(nd, "SHORT", 3)
    monkeypatch.setattr(nd, "BLOCK_ROWS", 7)
    rng = random.Random(length)
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    rows = [(i, edited(rng, base, share)) for i, share in enumerate([0.0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.08] * 8)]
    rows += [(100 + i, " ".join(base[: length - 3 * i]) + f" only{i}") for i in range(3)]
    assert got(nd.near_dedup(make_docs(rows), 2)) == brute(rows, 2)


def test_cases(make_docs):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one two three"), (8, "É a"), (9, "é a"), (10, "x y " * 20_000), (11, "x y " * 30_000), (12, "a b c d e"), (13, "a b c d e f")]
    assert got(nd.near_dedup(make_docs(rows), 2)) == brute(rows, 2)


def test_null_and_repeated_ids(make_docs):
    text = " ".join(f"w{i}" for i in range(50))
    out = nd.near_dedup(make_docs([(None, text), (7, text), (3, text + " z"), (7, "quite another one"), (9, "quite another one")]), 2).collect()
    by = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in out}
    assert by[(None, 49)] == (None, True)
    assert by[(7, 49)] == (3, False) and by[(7, 2)] == (3, False) and by[(9, 2)] == (3, False) and by[(3, 50)] == (3, True)


@pytest.mark.parametrize("short", [24, 2])
def test_all_texts_of_a_repeated_id_link_it(make_docs, monkeypatch, short):
    monkeypatch.setattr(nd, "SHORT", short)
    x, y, u, v = ([f"{name}{i}" for i in range(200)] for name in "xyuv")
    near = [[*t[:90], "other", *t[91:]] for t in (x, y, u, v)]
    rows = [(2, x), (7, x), (7, y), (7, y), (3, near[1]), (5, near[1][:-1]), (20, u), (20, v), (15, near[2]), (11, near[3]), (30, ["lone", "words"]), (30, ["lone", "words"])]
    out = nd.near_dedup(make_docs([(i, " ".join(t)) for i, t in rows]), 2).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in out) == sorted((i, c, i == c) for i, _ in rows for c in [2 if i < 10 else 11 if i < 30 else 30])


def test_empty(make_docs):
    assert nd.near_dedup(make_docs([])).count() == 0


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101)], "a long, b long")
    assert {(r.id, r.comp) for r in nd.components(links).collect()} == {(i, 1) for i in range(1, 61)} | {(100, 100), (101, 100)}


def test_sql_gives_the_same(small):
    import duckdb

    from veilspan.llm.queries import OP4_SQL

    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    rows = c.execute("SELECT doc_id, text FROM documents").fetchall()
    got = c.execute(OP4_SQL)
    assert [d[0] for d in got.description] == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(got.fetchall()) == brute(rows, 2)


def thue_morse(n, a, b):
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))


def test_words_that_sums_of_powers_do_not_tell_apart(make_docs):
    """Such a word and its complement have equal polynomial hashes modulo 2**64, whatever the multiplier."""
    t = [(thue_morse(n, *ab), thue_morse(n, *reversed(ab))) for n in (1024, 2048, 4096) for ab in ("ab", "xy")]
    rows = [(2 * i + k, f"{w} tail{i}" if i % 2 else w) for i, pair in enumerate(t) for k, w in enumerate(pair)]
    rows += [(100 + i, " ".join(thue_morse(64, *p) + str(j) for j in range(30))) for i, p in enumerate(("ab", "ba"))]
    assert got(nd.near_dedup(make_docs(rows), 2)) == brute(rows, 2)


def test_word_places_and_hashes(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from veilspan.llm.arrow import text_bytes

    rng = random.Random(4)
    texts = ["".join(rng.choice("aAb \n\u00e9\x0b") for _ in range(rng.randrange(30))) for _ in range(300)] + ["q" * 255, "q" * 256, "q" * 257, "Q" * 257 + " r", ""]
    want = [re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOW)) for t in texts]
    for size in (1, 7, 1 << 22):
        monkeypatch.setattr(nd, "SEARCHED", size)
        h, at = nd.word_hashes(*text_bytes(pa.array(texts)), (5, 6))
        assert np.diff(at).tolist() == [len(w) for w in want]
        by = {}
        for word, x in zip([x for w in want for x in w], h.tolist(), strict=True):
            assert by.setdefault(word, x) == x
        assert len(set(by.values())) == len(by)
    other, _ = nd.word_hashes(*text_bytes(pa.array(texts)), (5, 7))
    assert not set(other.tolist()) & set(h.tolist())


def test_one_very_long_text(make_docs):
    words = [f"w{i}" for i in range(400_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-9])), (3, "y" * 5_000_000), (4, "y" * 5_000_001)]
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_dedup(make_docs(rows), 2).collect()}
    assert out == {1: (399_999, 1), 2: (399_990, 1), 3: (1, 3), 4: (1, 4)}

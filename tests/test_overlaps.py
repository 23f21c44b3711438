"""Overlap islands against the plain fold of tests/test_spans.py, and chains that are long."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tests.test_spans import e, fold, run
from veilspan.operators import overlaps

COLUMNS = "page int, entity_type string, start int, end int, score double, text string"


def frame(spark, cases):
    return spark.createDataFrame([(i, *x) for i, case in enumerate(cases) for x in case], COLUMNS).repartition(4)


def random_case(rng, n, width, longest):
    return [e(rng.choice("ABC"), s := rng.randrange(width), s + rng.randrange(0, longest), rng.choice([0.3, 0.5, 0.9])) for _ in range(n)]


def check(spark, cases):
    rows = frame(spark, cases)
    kept, said = {}, {}
    for r in overlaps.resolved(rows, ["page"]).collect():
        kept.setdefault(r.page, []).append((r.entity_type, r.start, r.end, r.score))
    for r in overlaps.exposures(rows, ["page"]).orderBy("page", "pos").collect():
        said.setdefault(r.page, []).append((r.dropped_type, r.dropped_start, r.dropped_end, r.winner_type, r.winner_start, r.winner_end, tuple((x.start, x.end) for x in r.exposed)))
    for i, case in enumerate(cases):
        want, notes = fold(case)
        assert sorted(kept.get(i, [])) == sorted(w[:4] for w in want)
        assert said.get(i, []) == notes


def test_random_pages(spark):
    rng = random.Random(5)
    check(spark, [random_case(rng, rng.randrange(1, 40), width, longest) for width in (10, 60, 400) for longest in (2, 9, 40) for _ in range(25)])


def test_islands(spark):
    rows = frame(spark, [[e("A", 0, 20, 0.5), e("B", 2, 4, 0.9), e("C", 19, 21, 0.4), e("D", 21, 22, 0.4), e("E", 30, 30, 0.4), e("F", 30, 31, 0.4)]])
    got = {r.entity_type: r.island for r in overlaps.islands(rows, ["page"]).collect()}
    assert got == {"A": 1, "B": 1, "C": 1, "D": 2, "E": 3, "F": 4} or got == {"A": 1, "B": 1, "C": 1, "D": 2, "F": 3, "E": 3}


def test_floor_and_missing_scores(spark):
    rows = frame(spark, [[e("A", 0, 9, 0.29), e("B", 1, 2, None), e("C", 3, 4, 0.3)]])
    assert [r.entity_type for r in overlaps.resolved(rows, ["page"]).collect()] == ["C"]
    assert overlaps.resolved(rows.where("page < 0"), ["page"]).count() == 0


def test_a_page_of_200_000_entities(spark):
    """Half of them in chains of overlaps, one of which has 2,000 members; in time that grows with their number."""
    rng = random.Random(7)
    case = [e("A", 3 * i, 3 * i + 4, rng.choice([0.4, 0.8])) for i in range(2000)]
    case += [e(rng.choice("AB"), 10_000 + 9 * i + rng.randrange(6), 10_000 + 9 * i + rng.randrange(6, 12), rng.choice([0.4, 0.8])) for i in range(198_000)]
    want, notes = fold(case)
    rows = frame(spark, [case])
    rows.count()
    began = time.time()
    got = overlaps.resolved(rows, ["page"]).select("entity_type", "start", "end", "score").collect()
    assert sorted(map(tuple, got)) == sorted(w[:4] for w in want)
    assert time.time() - began < 60
    assert overlaps.exposures(rows, ["page"]).count() == len(notes)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 9, 10, 17])
def test_every_length_of_an_array(spark, n):
    rng = random.Random(n)
    cases = [random_case(rng, n, 3 * n + 1, 9) for _ in range(20)]
    for case, got in zip(cases, run(spark, cases), strict=True):
        want, notes = fold(case)
        assert got == ([w[:4] for w in want], notes)


def test_a_long_chain_in_one_array(spark):
    rng = random.Random(1)
    case = [e("A", 2 * i, 2 * i + 3, rng.choice([0.4, 0.5, 0.8])) for i in range(20_000)]
    began = time.time()
    ((got, said),) = run(spark, [case])
    want, notes = fold(case)
    assert got == [w[:4] for w in want] and said == notes
    assert time.time() - began < 30


def test_clashes(spark):
    rows = frame(spark, [[e("A", 0, 5, 1.0), e("B", 4, 6, 1.0), e("C", 5, 8, 1.0)], [e("A", 0, 5, 1.0), e("B", 5, 6, 1.0)]])
    assert [tuple(r) for r in overlaps.clashes(rows, ["page"]).collect()] == [(0, 2)]
    assert rows.where(F.col("page") == 1).count() == 2

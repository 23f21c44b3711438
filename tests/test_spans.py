import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veilspan.functions import spans
from veilspan.schema import ENTITY
from pyspark.sql import types as T

PAGES = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("entities", T.ArrayType(ENTITY))])


def fold(ents):
    """Survivors and dropped ones with what they leave bare, one entity at a time."""
    key = lambda e: (-e[3], e[1] - e[2], e[1], e[0])
    cur, out, notes = None, [], []
    for e in sorted(ents, key=lambda e: (e[1], key(e))):
        if cur is None:
            cur = e
        elif not (cur[2] <= e[1] or cur[1] >= e[2]):
            win, lose = (e, cur) if key(e) < key(cur) else (cur, e)
            bare = [b for b in ((lose[1], win[1]), (win[2], lose[2])) if b[0] < b[1]]
            if bare:
                notes.append((lose[0], lose[1], lose[2], win[0], win[1], win[2], tuple(bare)))
            cur = win
        else:
            out.append(cur)
            cur = e
    return ([*out, cur] if cur else out), notes


def run(spark, cases):
    df = spark.createDataFrame(list(enumerate(cases)), PAGES).withColumn("r", spans.resolve(F.col("entities")))
    got = {}
    for r in df.collect():
        notes = [(w.dropped_type, w.dropped_start, w.dropped_end, w.winner_type, w.winner_start, w.winner_end, tuple((x.start, x.end) for x in w.exposed)) for w in r.r.warnings]
        got[r.id] = ([tuple(e)[:4] for e in r.r.resolved], notes)
    return [got[i] for i in range(len(cases))]


def e(kind, s, t, p):
    return (kind, s, t, p, "")


def test_known_cases(spark):
    cases = [
        [e("B", 0, 4, 0.5), e("A", 2, 10, 0.6), e("C", 8, 14, 0.9)],
        [e("A", 0, 20, 0.5), e("C", 2, 4, 0.9), e("D", 10, 12, 0.4)],
        [e("PERSON", 10, 18, 0.85), e("LOCATION", 15, 25, 0.85)],
        [e("A", 0, 4, 0.5), e("B", 4, 8, 0.5)],
        [],
    ]
    got = run(spark, cases)
    assert [[x[0] for x in g[0]] for g in got] == [["C"], ["C", "D"], ["LOCATION"], ["A", "B"], []]
    assert got[2][1] == [("PERSON", 10, 18, "LOCATION", 15, 25, ((10, 15),))]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from("ABC"), st.integers(0, 20), st.integers(1, 9), st.sampled_from([0.1, 0.3, 0.5, 0.9])), max_size=7), min_size=40, max_size=40))
def test_fold(spark, cases):
    cases = [[e(k, s, s + n, p) for k, s, n, p in c] for c in cases]
    for case, got in zip(cases, run(spark, cases), strict=True):
        want, notes = fold(case)
        assert got == ([w[:4] for w in want], notes)


def test_floor_keeps_equality_and_drops_missing_scores(spark):
    df = spark.createDataFrame([(0, [e("A", 0, 1, 0.3), e("B", 1, 2, 0.29), e("C", 2, 3, None)])], PAGES)
    assert [x.entity_type for x in df.select(spans.above_floor(F.col("entities")).alias("k")).first().k] == ["A"]


def test_boxes(spark):
    row = spark.range(1).select(
        spans.padded(F.expr("named_struct('x', 1, 'y', 5, 'w', 10, 'h', 4)"), F.lit(12), F.lit(100)).alias("p"),
        spans.inside(F.lit(5.0), F.lit(9.0), F.expr("named_struct('x', 1, 'y', 5, 'w', 4, 'h', 4)")).alias("edge"),
        spans.box_of_points(F.lit(36.0), F.lit(0.0), F.lit(72.0), F.lit(9.0), F.lit(792.0)).alias("b"),
    ).first()
    assert tuple(row.p) == (0, 2, 12, 12) and row.edge and tuple(row.b) == (100, 2175, 200, 2200)


def test_regions(spark):
    from veilspan.operators import regions

    r = spark.createDataFrame([(1, 0, 0, 20, 20, 1000, 1000), (1, 0, 0, 19, 21, 1000, 1000), (1, 0, 0, 1000, 450, 1000, 1000), (1, 0, 0, 1000, 451, 1000, 1000), (1, 500, 500, 30, 30, 1000, 1000)], "page int, x int, y int, w int, h int, page_width int, page_height int")
    kept = regions.sized(r)
    assert kept.count() == 3
    w = spark.createDataFrame([(1, 5, 5, 10, 10), (2, 505, 505, 4, 4)], "page int, x int, y int, w int, h int")
    yes, no = regions.accounted(kept, w, ["page"]), regions.unaccounted(kept, w, ["page"])
    assert yes.count() == 2 and no.count() == 1
    truth = spark.createDataFrame([(1, "a", 10, 10, 40, 40), (1, "b", 700, 700, 800, 800)], "page int, id string, left int, top int, right int, bottom int")
    assert {x.id: x.detected for x in regions.scored(kept, truth, ["page"]).collect()} == {"a": True, "b": False}


def test_parity_guard(spark):
    from veilspan.operators.redact import same_raster

    expected = F.expr("named_struct('width', 5, 'height', 6)")
    assert spark.range(1).select(same_raster(F.lit(5), F.lit(6), expected)).first()[0]
    assert spark.range(1).select(same_raster(F.lit(5), F.lit(6), F.lit(None).cast("struct<width:int,height:int>"))).first()[0]
    with pytest.raises(Exception, match="raster dimensions"):
        spark.range(1).select(same_raster(F.lit(5), F.lit(7), expected)).collect()

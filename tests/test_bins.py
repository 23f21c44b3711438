"""Joins by bins against all pairs, and region matching against a plain greedy choice."""

import random

import pytest
from pyspark.sql import functions as F

from veilspan.operators import bins, redact, regions


def overlap(a0, a1, b0, b1):
    return not (a1 <= b0 or a0 >= b1)


@pytest.mark.parametrize("size", [1, 4, 256])
def test_intervals(spark, size):
    rng = random.Random(size)
    a = [(rng.randrange(3), i, s := rng.randrange(-9, 60), s + rng.randrange(0, 20)) for i in range(200)]
    b = [(rng.randrange(3), i, s := rng.randrange(-9, 60), s + rng.choice([0, 1, 3, 50])) for i in range(60)]
    left = spark.createDataFrame(a, "page int, a int, start int, end int")
    right = spark.createDataFrame(b, "page int, b int, e_start int, e_end int")
    got = bins.met_intervals(left, right, ["page"], ("start", "end"), ("e_start", "e_end"), size).select("a", "b").collect()
    want = [(x[1], y[1]) for x in a for y in b if x[0] == y[0] and overlap(x[2], x[3], y[2], y[3])]
    assert sorted(map(tuple, got)) == sorted(want)


def test_a_dense_page_makes_no_product(spark):
    """100,000 words and 10,000 entities on one page: rows that meet are a small multiple of those that match."""
    words = spark.range(100_000).select(F.lit(1).alias("page"), F.col("id").alias("seq"), (F.col("id") * 7).cast("int").alias("start"), (F.col("id") * 7 + 6).cast("int").alias("end"), F.lit("w").alias("text"), *[F.lit(1).alias(c) for c in "xywh"])
    found = spark.range(10_000).select(F.lit(1).alias("page"), F.lit("A").alias("entity_type"), (F.col("id") * 70).cast("int").alias("start"), (F.col("id") * 70 + 20).cast("int").alias("end"), F.lit(0.9).alias("score"))
    boxes = redact.redaction_boxes(words, found, ["page"])
    assert boxes.count() == 30_000
    a = words.withColumn("b", F.explode(F.sequence(F.floor(F.col("start") / 256), F.floor((F.col("end") - 1) / 256)))).groupBy("b").count()
    assert a.agg(F.max("count")).first()[0] < 50


def test_regions_by_cells(spark):
    rng = random.Random(4)
    box = lambda most: (rng.randrange(3), rng.randrange(-50, 900), rng.randrange(900), rng.randrange(1, most), rng.randrange(1, most))
    r, w = [box(500) for _ in range(150)], [box(60) for _ in range(120)]
    r += r[:20]
    t = [(p, i, x, y, x + a, y + b) for i, (p, x, y, a, b) in enumerate(box(300) for _ in range(100))]
    columns = "page int, x int, y int, w int, h int"
    rd, wd = spark.createDataFrame(r, columns), spark.createDataFrame(w, columns)
    holds = lambda b, v: b[0] == v[0] and b[1] <= v[1] + v[3] / 2 <= b[1] + b[3] and b[2] <= v[2] + v[4] / 2 <= b[2] + b[4]
    yes, no = sorted(x for x in r if any(holds(x, v) for v in w)), sorted(x for x in r if not any(holds(x, v) for v in w))
    assert sorted(map(tuple, regions.accounted(rd, wd, ["page"]).collect())) == yes
    assert sorted(map(tuple, regions.unaccounted(rd, wd, ["page"]).collect())) == no and yes and no
    td = spark.createDataFrame(t, "page int, id int, left int, top int, right int, bottom int")
    meets = lambda e, b: e[0] == b[0] and b[1] < e[4] and e[2] < b[1] + b[3] and b[2] < e[5] and e[3] < b[2] + b[4]
    assert {x.id: x.detected for x in regions.scored(rd, td, ["page"]).collect()} == {e[1]: any(meets(e, b) for b in r) for e in t}
    pairs = regions.met_boxes(rd.limit(150), td, ["page"])
    assert pairs.count() == pairs.distinct().count()


def iou(b, e):
    w, h = min(e[4], b[1] + b[3]) - max(e[2], b[1]), min(e[5], b[2] + b[4]) - max(e[3], b[2])
    return w * h / (b[3] * b[4] + (e[4] - e[2]) * (e[5] - e[3]) - w * h) if w > 0 and h > 0 else 0.0


@pytest.mark.parametrize("least", [0.05, 0.5])
def test_matching(spark, least):
    rng = random.Random(9)
    r, t = [], []
    for page in range(4):
        for _ in range(60):
            x, y, w, h = rng.randrange(800), rng.randrange(800), rng.randrange(20, 200), rng.randrange(20, 200)
            t.append((page, len(t), x, y, x + w, y + h, rng.choice(["stamp", "seal"])))
            for _ in range(rng.randrange(3)):
                r.append((page, x + rng.randrange(-20, 20), y + rng.randrange(-20, 20), w, h, len(r)))
    rd = spark.createDataFrame(r, "page int, x int, y int, w int, h int, region_id int")
    td = spark.createDataFrame(t, "page int, element_id int, left int, top int, right int, bottom int, element_type string")
    want, used_r, used_t = [], set(), set()
    for v, e, b in sorted(((iou(b, e), e, b) for b in r for e in t if b[0] == e[0] and iou(b, e) >= least), key=lambda x: (-x[0], x[1][1], x[2][5])):
        if e[1] not in used_t and b[5] not in used_r:
            used_t.add(e[1])
            used_r.add(b[5])
            want.append((e[0], b[5], e[1]))
    pairs = regions.matched(rd, td, ["page"], least)
    assert sorted((x.page, x.region_id, x.element_id) for x in pairs.collect()) == sorted(want) and len(want) > 50
    rates = {x.element_type: x for x in regions.match_rates(pairs, rd, td, ["page"]).collect()}
    assert rates[None].n_matched == len(want) and rates[None].precision == len(want) / len(r)
    assert rates["seal"].recall == sum(t[e][6] == "seal" for _, _, e in want) / sum(e[6] == "seal" for e in t)
    assert regions.matched(rd.where("page < 0"), td, ["page"]).count() == 0

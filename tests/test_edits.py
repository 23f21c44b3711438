"""The edit log against a plain reading of its rules, and what apply makes of the result."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from veilspan.operators import anonymize, edits
from veilspan.schema import ENTITY
from pyspark.sql import types as T

PAGES = T.StructType([T.StructField("doc", T.IntegerType()), T.StructField("page", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("entities", T.ArrayType(ENTITY))])
LOG = "doc int, page int, proposal_id string, version int, action string, start int, end int, entity_type string"
KEY = ["doc", "page"]
TEXT = "Mara Quist met Mara Quist\nand Olin Brandt in Velmora on 3 May."


def found(kind, text, nth=0):
    at = -1
    for _ in range(nth + 1):
        at = TEXT.index(text, at + 1)
    return (kind, at, at + len(text), 0.9, text)


def the_id(e, doc=1, page=0):
    return hashlib.sha256(f"{doc}|{page}|{e[1]}|{e[2]}|{e[0]}".encode()).hexdigest()[:16]


FIRST, SECOND, OLIN, PLACE = found("PERSON", "Mara Quist"), found("PERSON", "Mara Quist", 1), found("PERSON", "Olin Brandt"), found("LOCATION", "Velmora")


def review(spark, log, ents=(FIRST, SECOND, OLIN, PLACE)):
    pages = spark.createDataFrame([(1, 0, TEXT, list(ents)), (2, 0, "nothing here", [])], PAGES)
    reviewed = edits.merged(pages, edits.proposals(pages, KEY), spark.createDataFrame(log, LOG), KEY)
    out = edits.substitutions(pages, reviewed, KEY).withColumn("said", F.when(F.col("n_overlaps") == 0, anonymize.apply(F.col("text"), F.col("substitutions"))))
    return {r.proposal_id: r for r in reviewed.collect()}, {r.doc: r for r in out.collect()}


def test_without_edits_it_is_what_propose_gives(spark):
    rows, out = review(spark, [])
    assert {r.status for r in rows.values()} == {"proposed"} and set(rows) == {the_id(e) for e in (FIRST, SECOND, OLIN, PLACE)}
    assert out[1].said == "[PERSON_1] met [PERSON_1]\nand [PERSON_2] in [LOCATION_1] on 3 May." and out[2].said == "nothing here"


def test_each_action(spark):
    date = (TEXT.index("3 May"), TEXT.index("3 May") + 5)
    log = [
        (1, 0, the_id(FIRST), 1, "reject", None, None, None),
        (1, 0, the_id(OLIN), 1, "move", OLIN[1], OLIN[1] + 4, None),
        (1, 0, the_id(PLACE), 1, "retype", None, None, "TOWN"),
        (1, 0, the_id(SECOND), 7, "accept", None, None, None),
        (1, 0, None, 1, "add", *date, "DATE"),
    ]
    rows, out = review(spark, log)
    assert {k: r.status for k, r in rows.items()} == {the_id(FIRST): "rejected", the_id(OLIN): "moved", the_id(PLACE): "retyped", the_id(SECOND): "accepted", the_id(("DATE", *date)): "added"}
    assert rows[the_id(OLIN)].value == "Olin" and rows[the_id(FIRST)].start is None
    # the first person is gone, so that the second mention gets the first number
    assert out[1].said == "Mara Quist met [PERSON_1]\nand [PERSON_2] Brandt in [TOWN_1] on [DATE_1]."
    assert [m.value for m in out[1].restore_map] == ["Mara Quist", "Olin", "Velmora", "3 May"]


def test_the_highest_version_counts_in_any_order(spark):
    log = [(1, 0, the_id(OLIN), v, a, None, None, t) for v, a, t in [(3, "retype", "JUDGE"), (9, "retype", "CLERK"), (1, "reject", None), (4, "reject", None)]]
    for seed in range(3):
        random.Random(seed).shuffle(log)
        rows, out = review(spark, log)
        r = rows[the_id(OLIN)]
        assert (r.status, r.entity_type, r.version, r.n_edits) == ("retyped", "CLERK", 9, 4)
        assert "[CLERK_1]" in out[1].said


def test_stale_and_invalid_edits_are_reported_and_change_nothing(spark):
    gone = the_id(("PERSON", 900, 905))
    log = [
        (1, 0, gone, 1, "reject", None, None, None), (1, 0, "0123", 2, "move", 0, 4, None),
        (1, 0, the_id(FIRST), 1, "move", 5, 5, None), (1, 0, the_id(SECOND), 1, "move", 5, 10_000, None),
        (1, 0, the_id(OLIN), 1, "retype", None, None, None), (1, 0, the_id(PLACE), 1, "erase", None, None, None),
        (2, 0, "far", 1, "add", 3, 99, "X"), (9, 0, "no such page", 1, "add", 0, 1, "X"),
    ]
    rows, out = review(spark, log)
    assert {k: r.status for k, r in rows.items()} == {gone: "stale", "0123": "stale", the_id(FIRST): "invalid", the_id(SECOND): "invalid", the_id(OLIN): "invalid", the_id(PLACE): "invalid", "far": "invalid", "no such page": "invalid"}
    assert rows["far"].start is None and rows["no such page"].start is None
    assert out[1].said == "[PERSON_1] met [PERSON_1]\nand [PERSON_2] in [LOCATION_1] on 3 May."


def test_overlaps_that_edits_make_are_counted_and_refused(spark):
    log = [(1, 0, the_id(OLIN), 1, "move", PLACE[1] - 3, PLACE[1] + 2, None)]
    _, out = review(spark, log)
    assert out[1].n_overlaps == 1 and out[1].said is None
    with pytest.raises(Exception, match="substitutions overlap"):
        df = spark.createDataFrame([(TEXT, [(0, 4, "[A]"), (2, 5, "[B]")])], "text string, s array<struct<start:int,end:int,placeholder:string>>")
        df.select(anonymize.apply(F.col("text"), F.transform("s", lambda x: F.struct(x["start"], x["end"], x["placeholder"], F.lit(None).cast("string").alias("replacement"))))).collect()


def test_a_value_over_a_line_break_keeps_it(spark):
    span = (TEXT.index("Quist\nand"), TEXT.index("Quist\nand") + 9)
    rows, out = review(spark, [(1, 0, the_id(SECOND), 1, "move", *span, None)])
    assert rows[the_id(SECOND)].value == "Quist and" and rows[the_id(SECOND)].breaks == 1
    assert out[1].said.count("\n") == TEXT.count("\n")

"""Anonymization and restoration: generated pages against a plain computation, and cases that each make one point."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspan.functions.boundary import LEADING, TRAILING
from veilspan.operators import anonymize, detect, docs, restore
from veilspan.schema import ENTITY

PAGES = T.StructType([T.StructField("doc_id", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("entities", T.ArrayType(ENTITY))])


def normal(text, kind, s, e):
    """Start and end of a span without white space and listed words at its ends, and what was done."""
    cut, did = text[s:e], []
    for name, at in (("mid_word_start", s), ("mid_word_end", e)):
        if 0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum():
            did.append(name)
    if not cut.strip():
        did.append("abort_empty_span")
        return s, e, did + (["newline_reemit"] if "\n" in cut else [])
    lo, hi = s + len(cut) - len(cut.lstrip()), e - (len(cut) - len(cut.rstrip()))
    if (lo, hi) != (s, e):
        did.append("whitespace_trim")
    words = []
    for m in text[lo:hi].split():
        at = text.index(m, words[-1][1] if words else lo)
        words.append((at, at + len(m), m.lower()))
    peeled, left = [], list(words)
    while left and left[0][2] in LEADING.get(kind, ()):
        left.pop(0)
        peeled.append("leading_trim")
    while left and left[-1][2] in TRAILING.get(kind, ()):
        left.pop()
        peeled.append("trailing_trim")
    if left:
        lo, hi = left[0][0], left[-1][1]
        did += peeled
    else:
        did.append("abort_empty_span")
    return lo, hi, did + (["newline_reemit"] if "\n" in text[lo:hi] else [])


def replaced(text, spans):
    """Text with numbered placeholders for (kind, start, end), and placeholder by value."""
    number, out, at, names = {}, "", 0, {}
    for kind, s, e in sorted(spans, key=lambda x: x[1]):
        value = text[s:e].replace("\n", " ")
        own = number.setdefault(kind, {})
        name = f"[{kind}_{own.setdefault(value, len(own) + 1)}]"
        names[name] = value
        out += text[at:s] + name + "\n" * text[s:e].count("\n")
        at = e
    return out + text[at:], names


WORDS = ["on", "or", "the", "Aino", "May", "7", "until", "Kotka\nHarbour", "x", "about", "\n", " ", "é😀", "to", "Date", "of"]


@st.composite
def page(draw):
    text, spans = "", []
    for _ in range(draw(st.integers(0, 5))):
        text += draw(st.sampled_from(["", " ", "ab", "\n", ", "]))
        body = " ".join(draw(st.lists(st.sampled_from(WORDS), min_size=1, max_size=4)))
        if draw(st.booleans()):
            spans.append((draw(st.sampled_from(["PERSON", "DATE_TIME", "SHIP"])), len(text), len(text) + len(body)))
        text += body
    return text, spans


def frame(spark, pages):
    return spark.createDataFrame([(i, t, [(k, s, e, 0.5, t[s:e]) for k, s, e in spans]) for i, (t, spans) in enumerate(pages)], PAGES)


@settings(max_examples=4, deadline=None)
@given(st.lists(page(), min_size=60, max_size=60))
def test_generated_pages(spark, pages):
    df = frame(spark, pages)
    rows = {}
    for r in anonymize.normalized_rows(df, ["doc_id"]).collect():
        rows[r.doc_id, r.start0] = (r.start, r.end, [a.action for a in r.actions])
    assert rows == {(i, s): normal(t, k, s, e) for i, (t, spans) in enumerate(pages) for k, s, e in spans}
    p = anonymize.propose(df, ["doc_id"]).withColumn("out", anonymize.apply(F.col("text"), F.col("substitutions")))
    for r in p.select("doc_id", "text", "out", "restore_map", *restore.page_columns(F.col("out"), F.col("restore_map"))).collect():
        text, spans = pages[r.doc_id]
        out, names = replaced(text, [(k, *normal(text, k, s, e)[:2]) for k, s, e in spans])
        assert r.out == out and {m.placeholder: m.value for m in r.restore_map} == names
        assert r.out.count("\n") == text.count("\n") and r.missing_placeholders == [] == r.unresolved_tokens
        if not any("\n" in text[s:e] for _, s, e in spans):
            assert r.restored_text == text


POINTS = {
    "equal values share a number": ("Aino towed Otso; Aino left", [("SHIP", "Aino", 0), ("SHIP", "Otso", 0), ("SHIP", "Aino", 1)], "[SHIP_1] towed [SHIP_2]; [SHIP_1] left"),
    "kinds are numbered apart": ("Otso of Kotka", [("SHIP", "Otso", 0), ("PORT", "Kotka", 0)], "[SHIP_1] of [PORT_1]"),
    "a line break is given back": ("by Ida\nOja, later Ida Oja", [("PERSON", "Ida\nOja", 0), ("PERSON", "Ida Oja", 0)], "by [PERSON_1]\n, later [PERSON_1]"),
    "lists are those of a kind": ("until the Otso sails", [("SHIP", "the Otso", 0)], "until [SHIP_1] sails"),
    "whole tokens only": ("sailed Offshore in June", [("DATE_TIME", "Offshore in June", 0)], "sailed [DATE_TIME_1]"),
    "nothing is emptied": ("loaded until or about", [("DATE_TIME", "until or about", 0)], "loaded [DATE_TIME_1]"),
    "nothing found": ("calm sea", [], "calm sea"),
}


@pytest.fixture(scope="module")
def points(spark):
    pages = []
    for text, found, _ in POINTS.values():
        spans = []
        for kind, value, nth in found:
            at = -1
            for _ in range(nth + 1):
                at = text.index(value, at + 1)
            spans.append((kind, at, at + len(value)))
        pages.append((text, spans))
    return frame(spark, pages)


def test_points(points):
    p = anonymize.propose(points, ["doc_id"]).withColumn("out", anonymize.apply(F.col("text"), F.col("substitutions")))
    assert {list(POINTS)[r.doc_id]: r.out for r in p.collect()} == {k: v[2] for k, v in POINTS.items()}


def test_without_boundaries_spans_stay_as_detected(spark):
    df = frame(spark, [("left on 3 May or so", [("DATE_TIME", 5, 16)])])
    for boundaries, want in ((True, "left on [DATE_TIME_1] or so"), (False, "left [DATE_TIME_1] so")):
        p = anonymize.propose(df, ["doc_id"], boundaries=boundaries)
        assert p.select(anonymize.apply(F.col("text"), F.col("substitutions"))).first()[0] == want


def test_scores_below_the_floor_are_left(spark):
    df = spark.createDataFrame([(1, "Otso and Aino", [("SHIP", 0, 4, 0.29, ""), ("SHIP", 9, 13, 0.3, "")])], PAGES)
    assert anonymize.propose(df, ["doc_id"]).select(anonymize.apply(F.col("text"), F.col("substitutions"))).first()[0] == "Otso and [SHIP_1]"


def plain_restore(text, entries):
    """Restored text, occurrences, missing placeholders and tokens that are left, with placeholders that contain no other."""
    import re

    found = [m[0] for m in re.finditer(r"\[[A-Z_]+_\d+\]", text)]
    names = dict(entries)
    back = re.sub(r"\[[A-Z_]+_\d+\]", lambda m: names.get(m[0], m[0]), text)
    return back, sum(f in names for f in found), sorted(set(names) - set(found)), sorted({f for f in found if f not in names})


def test_restore(spark):
    rng = random.Random(8)
    cases = []
    for _ in range(80):
        names = [f"[{k}_{n}]" for k in ("SHIP", "PORT_OF") for n in rng.sample(range(1, 13), 3)]
        entries = [(n, f"value {i}") for i, n in enumerate(names)]
        rng.shuffle(entries)
        text = " ".join(rng.choice([*names, "[SHIP_99]", "[ILLEGIBLE]", "[ship_1]", "sea", "[TABLE — STRUCTURE UNCERTAIN, REVIEW]"]) for _ in range(9))
        cases.append((text, entries))
    df = spark.createDataFrame([(i, t, m) for i, (t, m) in enumerate(cases)], "id int, text string, m array<struct<placeholder:string,value:string>>")
    for r in df.select("id", *restore.page_columns(F.col("text"), F.col("m"))).collect():
        assert tuple(r)[1:] == plain_restore(*cases[r.id])
    nothing = spark.range(1).select(*restore.page_columns(F.lit(None).cast("string"), F.expr("array(struct('[SHIP_1]' AS placeholder, 'Aino' AS value))"))).first()
    assert tuple(nothing) == ("", 0, ["[SHIP_1]"], [])


def test_tokens_that_were_there_before_are_found(spark):
    m = F.expr("array(struct('[SHIP_1]' AS placeholder, 'the [PORT_4]' AS value))")
    assert spark.range(1).select(restore.colliding(F.lit("a [SHIP_1] b"), m).alias("c")).first().c == ["[PORT_4]", "[SHIP_1]"]


SUBS = "array<struct<start:int,end:int,placeholder:string,replacement:string>>"


def test_substitutions_that_overlap_are_an_error(spark):
    for second, n in ((3, 1), (4, 0)):
        df = spark.createDataFrame([("abcdefgh", [(second, 6, "[B_1]", "[B_1]"), (1, 4, "[A_1]", None)])], f"t string, s {SUBS}")
        assert df.select(anonymize.overlapping(F.col("s"))).first()[0] == n
        if n:
            with pytest.raises(Exception, match="overlap"):
                df.select(anonymize.apply(F.col("t"), F.col("s"))).collect()
        else:  # in order of start; without a replacement, the placeholder
            assert df.select(anonymize.apply(F.col("t"), F.col("s"))).first()[0] == "a[A_1][B_1]gh"


def test_formats(spark):
    made = {k: spark.range(1).select(f(F.lit("SHIP"), F.lit(12))).first()[0] for k, f in anonymize.FORMATS.items()}
    assert made == {"square": "[SHIP_12]", "double_bracket": "⟦SHIP_12⟧", "angle": "<<SHIP_12>>", "opaque": "XPIIX_SHIP_12"}


def test_detection(spark):
    text = "Docket 31-0042-77001; bay 31-0042-77001, berth 88/QZ/4021. Mail q.w+e@x-y.fi, z@, host 10.20.30.40 or 10.20.30.4000, card 1234567812345678 and 12345678123456789; Monthly"
    got = [(e.entity_type, e.text, e.score) for e in spark.range(1).select(detect.detect(F.lit(text), (*detect.DEFAULT, *detect.CASES)).alias("e")).first().e]
    assert got == [("CASE_NUMBER", "31-0042-77001", 0.9), ("CASE_NUMBER", "31-0042-77001", 0.9), ("CASE_NUMBER", "88/QZ/4021", 0.85), ("EMAIL_ADDRESS", "q.w+e@x-y.fi", 1.0), ("IP_ADDRESS", "10.20.30.40", 0.6), ("CREDIT_CARD", "1234567812345678", 0.5)]
    own = detect.Recognizer("WORD", "bay|Monthly", 0.9)
    assert [e.text for e in spark.range(1).select(detect.detect(F.lit(text), (own,)).alias("e")).first().e] == ["bay"]
    assert spark.range(1).select(detect.detect(F.lit(None).cast("string")).alias("e")).first().e == []


def test_context_must_be_near_and_whole(spark):
    far = "docket" + " ." * 30 + " 11-22-333; briefcase 11-22-444; CASE NO 11-22-555"
    got = spark.range(1).select(detect.detect(F.lit(far), detect.CASES).alias("e")).first().e
    assert [(e.text, e.score) for e in got] == [("11-22-333", 0.4), ("11-22-444", 0.4), ("11-22-555", 0.9)]


def test_warnings_are_listed_overlaps_first(spark):
    text = "on 4 June Otso sailed"
    df = spark.createDataFrame([(1, text, [("DATE_TIME", 0, 9, 0.9, ""), ("SHIP", 5, 14, 0.5, "")])], PAGES)
    got = [(r.kind, r.pos) for r in anonymize.warnings(df, ["doc_id"]).collect()]
    assert got == [("overlap_exposure", 0), ("boundary_normalization", 0)]


def test_folds_of_turkish_letters(spark):
    got = {r.t: r.f for r in spark.createDataFrame([(t,) for t in ("KIZILIRMAK", "İzmir", "ılık", "ilk", "ÇAĞ")], "t string").select("t", docs.fold_turkish(F.col("t")).alias("f")).collect()}
    assert got == {"KIZILIRMAK": "kızılırmak", "İzmir": "izmir", "ılık": "ılık", "ilk": "ilk", "ÇAĞ": "çağ"}


def test_required_fields(spark):
    whole = {k: "0" for k in docs.REQUIRED_FIELDS} | {"other": ""}
    df = spark.createDataFrame([(whole,)], "v map<string,string>")
    assert df.select(docs.required(F.col("v"))).first()[0] == whole
    for value in ("", None):
        bad = spark.createDataFrame([(whole | {"city": value, "date": value},)], "v map<string,string>")
        assert bad.select(docs.blank_fields(F.col("v"))).first()[0] == ["date", "city"]
        with pytest.raises(Exception, match="blank fields: date, city"):
            bad.select(docs.required(F.col("v"))).collect()


def test_directions(spark):
    assert [tuple(r[0]) for r in spark.createDataFrame([("en>tr",), ("tr>en",)], "d string").select(docs.languages(F.col("d"))).collect()] == [("English", "Turkish"), ("Turkish", "English")]
    for d in ("tr>fi", None):
        with pytest.raises(Exception, match="unknown direction"):
            spark.range(1).select(docs.languages(F.lit(d).cast("string"))).collect()


def test_slots(spark):
    slots = F.expr("array(struct('ship' AS name, '[SHIP_1]' AS token), struct('port' AS name, '[PORT_2]' AS token), struct('none' AS name, '[X_1]' AS token))")
    t = F.lit("{ship} left {port}; {ship}{ship}")
    said, expected = spark.range(1).select(docs.rendered(t, slots), docs.expected_tokens(t, slots)).first()
    assert said == "[SHIP_1] left [PORT_2]; [SHIP_1][SHIP_1]" and expected == ["[SHIP_1]"] * 3 + ["[PORT_2]"]


def test_parts(spark):
    parts = lambda s, l: spark.range(1).select(docs.labelled_parts(F.expr(s), F.expr(l)).alias("p")).first().p
    assert [tuple(x) for x in parts("array('x', 'y', 'z')", "CAST(NULL AS array<string>)")] == list(zip("xyz", docs.SECTIONS, strict=True))
    assert [tuple(x) for x in parts("array('x')", "array('one')")] == [("x", "one")]
    for labels in ("CAST(NULL AS array<string>)", "array('one', 'two', 'three')"):
        with pytest.raises(Exception, match="differ in number"):
            parts("array('x', 'y')", labels)
    with pytest.raises(Exception, match="no label"):
        docs.bookmarks(spark.createDataFrame([(1, 0, "a", 2), (1, 1, None, 3)], "doc int, part int, label string, pages int"), ["doc"]).collect()


JOB = {"doc": 1, "translated_pages": 4, "certificate_pages": 1, "source_pages": 3, "direction": "tr>en", "date": "2025-02-03", "profile": {"translator_full_name": "Oja", "ata_member_number": "5", "state_name": "S", "city": "Kotka", "date": "old"}}
JOBS = "doc int, translated_pages long, certificate_pages long, source_pages long, direction string, date string, profile map<string,string>"


def test_package(spark):
    rows = docs.package(spark.createDataFrame([tuple(JOB.values())], JOBS), ["doc"]).collect()
    assert [(r.part, r.label, r.pages, r.first_page) for r in rows] == [(0, docs.SECTIONS[0], 4, 0), (1, docs.SECTIONS[1], 1, 4), (2, docs.SECTIONS[2], 3, 5)]
    assert rows[0].certificate == JOB["profile"] | {"source_language": "Turkish", "target_language": "English", "page_count": "4", "date": "2025-02-03"}


@pytest.mark.parametrize("wrong, said", [({"direction": "x"}, "unknown direction"), ({"source_pages": 0}, "Source Document can't be read"), ({"certificate_pages": None}, "can't be read"), ({"profile": {"city": "Kotka"}}, "blank fields"), ({"date": None}, "blank fields: date")])
def test_no_package_is_incomplete(spark, wrong, said):
    with pytest.raises(Exception, match=said):
        docs.package(spark.createDataFrame([tuple((JOB | wrong).values())], JOBS), ["doc"]).collect()


def test_pages_in_bounds(spark):
    pages = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c")], "doc int, page_index int, text string")
    ask = lambda *rows: docs.pages_at(pages, spark.createDataFrame(list(rows), "doc int, page_index int"), ["doc"]).collect()
    assert sorted(r.text for r in ask((1, 1), (2, 0))) == ["b", "c"]
    for wrong in ((1, 2), (1, -1), (3, 0)):
        with pytest.raises(Exception, match=f"page {wrong[1]} of"):
            ask((1, 0), wrong)


def test_scores_of_tables_and_delays(spark):
    one = spark.range(1)
    text = "| grain | 4 |\n|--|--|\n| ore |\nprose [REVIEW]\n| salt | 1 | 2 |"
    assert tuple(one.select(docs.table_score(F.lit(text), "[REVIEW]", "[[S").alias("s")).first().s) == (4, 1, [2, 1, 3], True, False)
    assert one.select(docs.retry_seconds(F.lit("Please RETRY in 0.25s")), docs.retry_seconds(F.lit("retry later"))).first() == (0.25, None)


def test_prompts(spark):
    said = spark.range(1).select(docs.prompt(F.lit("Hyvää\npäivää"), F.lit("tr>en"))).first()[0]
    assert said.startswith("Translate this legal document from Turkish into English.") and said.endswith("\n\nHyvää\npäivää") and all(r in said for r in docs.PROMPT_RULES)

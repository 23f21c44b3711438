"""Recognizers from rows, and phrases found by joins against a plain search."""

import contextlib
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from veilspan.functions.text import strip
from veilspan.operators import detect, registry

RULES = "entity_type string, pattern string, score double, context array<string>, boost double"


def plain(rows, phrases):
    out = []
    for i, text in rows:
        w = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"[^\W_]+", text or "")]
        for kind, phrase, score in phrases:
            p = [x.lower() for x in re.findall(r"[^\W_]+", phrase)]
            out += [(i, kind, w[k][0], w[k + len(p) - 1][1], score, text[w[k][0] : w[k + len(p) - 1][1]]) for k in range(len(w) - len(p) + 1) if [x[2] for x in w[k : k + len(p)]] == p]
    return sorted(out)


def test_phrases(spark):
    rng = random.Random(3)
    words = ["Ash", "Birch", "cedar", "Élan", "X1", "d"]
    phrases = sorted({("TREE" if rng.random() < 0.5 else "NAME", " ".join(rng.choice(words) for _ in range(rng.randrange(1, 5))), 0.5) for _ in range(60)})
    rows = [(i, rng.choice(["", "(", "  "]) + "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(rng.randrange(30)))) for i in range(60)] + [(98, None), (99, "")]
    pages = spark.createDataFrame(rows, "page int, text string")
    index = registry.phrase_index(spark.createDataFrame([*phrases, *[(k, p.upper(), 0.4) for k, p, _ in phrases[:9]]], "entity_type string, phrase string, score double"))
    got = sorted(map(tuple, registry.found(pages, ["page"], index).collect()))
    assert got == plain(rows, phrases) and len(got) > 200


def test_many_phrases_are_few_joins(spark):
    phrases = spark.range(100_000).select(F.lit("NAME").alias("entity_type"), F.concat(F.lit("the "), F.col("id").cast("string"), F.lit(" of may")).alias("phrase"), F.lit(0.7).alias("score"))
    pages = spark.range(200).select(F.col("id").alias("page"), F.concat(F.lit("On the "), (F.col("id") * 1000).cast("string"), F.lit(" of May the the the end")).alias("text"))
    got = registry.found(pages, ["page"], registry.phrase_index(phrases))
    assert got.where("page < 100").count() == 100 and got.count() == 100
    assert got.where("page = 7").first().text == "the 7000 of May"


def test_phrases_that_cannot_be_are_errors(spark):
    for phrase in ("", " - ", "a " * 17):
        with pytest.raises(Exception, match="no words"):
            registry.phrase_index(spark.createDataFrame([("X", phrase, 1.0)], "entity_type string, phrase string, score double")).collect()


def test_recognizers_from_rows_are_those_of_the_code(spark):
    table = spark.createDataFrame([(r.entity_type, r.pattern, r.score, list(r.context) or None, None) for r in (*detect.DEFAULT, *detect.CASES)], RULES)
    rules = registry.recognizers(table)
    assert {(r.entity_type, r.pattern, r.score, r.context, r.boost, r.least, r.window) for r in rules} == {(r.entity_type, r.pattern, r.score, r.context, r.boost, r.least, r.window) for r in (*detect.DEFAULT, *detect.CASES)}
    pages = spark.createDataFrame([(1, "Esas No 12-3456-789 and 1.2.3.4 by a@b.cc; Monthly 12-3456-780")], "page int, text string")
    got = {(r.entity_type, r.text, r.score) for r in registry.detected(pages, ["page"], table).collect()}
    assert got == {("CASE_NUMBER", "12-3456-789", 0.9), ("IP_ADDRESS", "1.2.3.4", 0.6), ("EMAIL_ADDRESS", "a@b.cc", 1.0), ("CASE_NUMBER", "12-3456-780", 0.4)}


def test_boost_denied_texts_and_phrases_together(spark):
    table = spark.createDataFrame([("CODE", "[A-Z]{2}[0-9]{2}", 0.3, ["Ref"], 0.2)], RULES)
    pages = spark.createDataFrame([(1, "ref AB12, CD34, Olin Brandt and olin  BRANDT, Monthly")], "page int, text string")
    index = registry.phrase_index(spark.createDataFrame([("PERSON", "Olin Brandt", 0.8), ("WHEN", "monthly", 0.8)], "entity_type string, phrase string, score double"))
    denied = spark.createDataFrame([("CODE", "CD34"), (None, "olin  BRANDT"), ("PERSON", "AB12")], "entity_type string, text string")
    got = {(r.entity_type, r.text, r.score) for r in registry.detected(pages, ["page"], table, index, denied).collect()}
    assert got == {("CODE", "AB12", 0.55), ("PERSON", "Olin Brandt", 0.8)}


def test_bad_tables_are_errors(spark):
    for row in (("X", "a", 1.5, None, None), (None, "a", 0.5, None, None), ("X", "a", None, None, None)):
        with pytest.raises(ValueError, match="no type"):
            registry.recognizers(spark.createDataFrame([row], RULES))
    with pytest.raises(Exception, match="(?i)pattern|unclosed"):
        registry.recognizers(spark.createDataFrame([("X", "(a", 0.5, None, None)], RULES))
    with pytest.raises(ValueError, match="more than 500"):
        registry.recognizers(spark.range(501).select(F.lit("X").alias("entity_type"), F.lit("a").alias("pattern"), F.lit(0.5).alias("score")))


def test_separators_are_white_space(spark):
    assert spark.range(1).select(strip(F.lit("\x1c\x1d a\x1eb \x1f"))).first()[0] == "a\x1eb"


def test_pages_with_one_key_and_sizes_with_many_phrases(spark, monkeypatch):
    """Pages that share a key don't meet each other's words, and no word is shuffled; phrases beyond the broadcast pass the bitmap."""
    rng = random.Random(5)
    words = ["ash", "birch", "cedar", "elm", "fir"]
    rows = [(i % 20, rng.choice(["", "("]) + "".join(rng.choice(words) + rng.choice([" ", ", "]) for _ in range(rng.randrange(30)))) for i in range(40)]
    phrases = sorted({("TREE", " ".join(rng.choice(words) for _ in range(rng.randrange(1, 4))), 0.5) for _ in range(30)})
    pages = spark.createDataFrame(rows, "page int, text string")
    index = registry.phrase_index(spark.createDataFrame(phrases, "entity_type string, phrase string, score double"))
    found = registry.found(pages, ["page"], index)
    assert sorted(map(tuple, found.collect())) == plain(rows, phrases)
    assert "hashpartitioning(page" not in explained(found)
    for most in (6, 0):
        monkeypatch.setattr(registry, "BROADCAST_PHRASES", most)
        assert sorted(map(tuple, registry.found(pages, ["page"], index).collect())) == plain(rows, phrases)


def explained(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_texts_are_cut_only_where_they_are_asked_for(spark):
    """Without texts, a page is split by its words once, to place them, and pieces of it don't go with each word."""
    pages = spark.createDataFrame([(1, "Ash, birch and ASH birch"), (2, None)], "page int, text string")
    index = registry.phrase_index(spark.createDataFrame([("TREE", "ash birch", 0.5)], "entity_type string, phrase string, score double"))
    got = registry.found(pages, ["page"], index, texts=False)
    assert got.columns == ["page", "entity_type", "start", "end", "score"]
    assert sorted(map(tuple, got.collect())) == [r[:-1] for r in plain([(1, "Ash, birch and ASH birch")], [("TREE", "ash birch", 0.5)])]

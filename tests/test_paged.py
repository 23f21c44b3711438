"""The data source of pages: round trips, ranges, errors that say where, and writes that leave nothing behind."""

import json

import pytest
from pyspark.sql import functions as F

from veilspan.operators import words
from veilspan.sources import paged


@pytest.fixture(scope="module")
def pages(spark):
    """Envelopes of made words, 250 pages of one document among them."""
    paged.register(spark)
    w = spark.range(1600).select(F.when(F.col("id") < 1000, "long").otherwise(F.concat(F.lit("d"), F.col("id") % 5)).alias("doc_id"), F.when(F.col("id") < 1000, F.col("id") / 4).otherwise(F.col("id") % 7).cast("int").alias("page_index"), F.lit("0:0:0").alias("line_id"), F.col("id").cast("int").alias("seq"), F.concat(F.lit("wörd"), F.col("id")).alias("text"), F.lit(90).alias("conf"), *[F.lit(5).alias(c) for c in "xywh"])
    key = ["doc_id", "page_index"]
    w = words.with_char_spans(w, key)
    nested = words.nested_pages(w, words.line_rows(w, key), key)
    dims = F.struct(F.lit(2550).alias("width"), F.lit(3300).alias("height"))
    return nested.select("doc_id", "page_index", dims.alias("image_dimensions"), "text", "lines", "words")


def rows(df):
    return sorted(json.dumps(r.asDict(recursive=True), sort_keys=True) for r in df.collect())


def test_round_trip_and_ranges(spark, pages, tmp_path):
    path = f"{tmp_path}/out"
    pages.coalesce(1).write.format(paged.NAME).mode("append").save(path)
    got = spark.read.format(paged.NAME).load(path)
    assert rows(got) == rows(pages) and got.schema == paged.SCHEMA
    narrow = spark.read.format(paged.NAME).option("pagesPerPartition", "100").load(path)
    n = pages.count()
    assert narrow.rdd.getNumPartitions() == -(-n // 100) and rows(narrow) == rows(pages)
    assert {r.n for r in narrow.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()} <= {100, n % 100}
    pages.repartition(5).limit(3).write.format(paged.NAME).mode("append").save(path)
    assert spark.read.format(paged.NAME).load(path).count() == n + 3
    pages.limit(2).write.format(paged.NAME).mode("overwrite").save(path)
    assert spark.read.format(paged.NAME).load(path).count() == 2
    assert len([p for p in (tmp_path / "out").iterdir() if p.name.startswith("part")]) == len(paged.manifest(path)["parts"])


def test_no_rows(spark, pages, tmp_path):
    pages.limit(0).write.format(paged.NAME).mode("append").save(f"{tmp_path}/out")
    assert spark.read.format(paged.NAME).load(f"{tmp_path}/out").count() == 0


def test_errors_name_the_file_and_line(spark, pages, tmp_path):
    path = f"{tmp_path}/out"
    pages.coalesce(1).limit(150).write.format(paged.NAME).mode("append").save(path)
    (part,) = (tmp_path / "out").glob("part*")
    sound = part.read_text().splitlines()
    for bad in ("{broken", "[1]", '{"doc_id": "x"}', '{"doc_id": "x", "page_index": "one"}', '{"doc_id": "x", "page_index": 1, "words": [{"conf": "high"}]}'):
        lines = sound[:120] + [bad] + sound[121:]
        body = "".join(x + "\n" for x in lines).encode()
        part.write_bytes(body)
        said = {"name": part.name, "pages": 150, "bytes": len(body), "offsets": [0, sum(len(x.encode()) + 1 for x in lines[:100])]}
        (tmp_path / "out" / paged.MANIFEST).write_text(json.dumps({"parts": [said]}))
        with pytest.raises(Exception, match=rf"{part.name}, line 121"):
            spark.read.format(paged.NAME).load(path).collect()
    part.write_text("".join(x + "\n" for x in sound[:90]))
    with pytest.raises(Exception, match=part.name):
        spark.read.format(paged.NAME).load(path).collect()
    with pytest.raises(Exception, match="_manifest.json"):
        spark.read.format(paged.NAME).load(f"{tmp_path}/nowhere").collect()


def test_a_failed_write_leaves_nothing_behind(spark, pages, tmp_path):
    path = f"{tmp_path}/out"
    pages.limit(4).coalesce(1).write.format(paged.NAME).mode("append").save(path)
    before = sorted(p.name for p in (tmp_path / "out").iterdir())
    broken = pages.repartition(4).withColumn("text", F.when(F.col("page_index") == 200, F.raise_error(F.lit("lost"))).otherwise(F.col("text")).cast("string"))
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="lost"):
            broken.write.format(paged.NAME).mode(mode).save(path)
        assert sorted(p.name for p in (tmp_path / "out").iterdir()) == before
    assert spark.read.format(paged.NAME).load(path).count() == 4


def test_other_columns_are_refused(spark, pages, tmp_path):
    for df in (pages.withColumn("more", F.lit(1)), pages.drop("page_index"), pages.withColumn("text", F.lit(5))):
        with pytest.raises(Exception, match="columns that pages"):
            df.write.format(paged.NAME).mode("append").save(f"{tmp_path}/out")

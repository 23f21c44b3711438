import time

import pytest
from pyspark.sql import functions as F

from veilspan.streaming import pages


@pytest.fixture(autouse=True, scope="module")
def few_parts(spark):
    """Each part has a worker and a state store of its own."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def run(spark, query_df, name):
    q = query_df.writeStream.format("memory").queryName(name).outputMode("append").start()
    try:
        q.processAllAvailable()
        return spark.sql(f"SELECT * FROM {name}").collect()
    finally:
        q.stop()


SCHEMA = "doc_id string, page_index int, page_count int, text string"


def stream(spark, tmp_path, rows):
    for i, r in enumerate(rows):
        spark.createDataFrame([r], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")


def test_documents_come_out_once_complete(spark, tmp_path):
    rows = [("a", 1, 2, "two"), ("b", 0, 3, "x"), ("a", 0, 2, "one"), ("b", 0, 3, "again"), ("c", 2, 3, "z"), ("c", 1, 2, "y"), ("c", 0, 2, "x")]
    out = run(spark, pages.complete_documents(stream(spark, tmp_path, rows)), "complete")
    assert sorted((r.doc_id, r.page_count, r.text) for r in out) == [("a", 2, "one\ftwo"), ("c", 3, "x\fy\fz")]


def to_files(query_df, tmp_path, **trigger):
    return query_df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{tmp_path}/state").option("path", f"{tmp_path}/out").trigger(**trigger or {"availableNow": True}).start()


def files(spark, tmp_path, schema="doc_id string, page_count int, text string, complete boolean"):
    return sorted((r.doc_id, r.page_count, r.text, r.complete) for r in spark.read.schema(schema).parquet(f"{tmp_path}/out").collect())


def test_a_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    for rows in ([("a", 2, 3, "z"), ("b", 0, 1, "only")], [("a", 0, 3, "x"), ("a", 2, 3, "Z")], [("a", 1, 3, "y"), ("c", 5, 2, "far")]):
        to_files(pages.complete_documents(stream(spark, tmp_path, rows)), tmp_path).awaitTermination()
    assert files(spark, tmp_path) == [("a", 3, "x\fy\fZ", True), ("b", 1, "only", True)]


def test_pages_that_are_there_before(spark, tmp_path):
    before = spark.createDataFrame([("a", 0, 2, "first"), ("b", 0, 9, "waits")], SCHEMA)
    to_files(pages.complete_documents(stream(spark, tmp_path, [("a", 1, 2, "second")]), initial=before), tmp_path).awaitTermination()
    assert files(spark, tmp_path) == [("a", 2, "first\fsecond", True)]


def test_incomplete_documents_are_given_up_where_the_caller_asks(spark, tmp_path):
    q = to_files(pages.complete_documents(stream(spark, tmp_path, [("a", 1, 3, "y"), ("a", 0, 3, "x")]), give_up_ms=500), tmp_path, processingTime="100 milliseconds")
    try:
        until = time.time() + 60
        while time.time() < until and not files(spark, tmp_path):
            time.sleep(0.5)
    finally:
        q.stop()
    assert files(spark, tmp_path) == [("a", 3, "x\fy", False)]


def test_a_document_of_5000_pages(spark, tmp_path):
    """In ten batches: each page is written to the state once."""
    n = 5000
    for part in range(10):
        rows = spark.range(n).where(F.col("id") % 10 == part).select(F.lit("long").alias("doc_id"), (n - 1 - F.col("id")).cast("int").alias("page_index"), F.lit(n).alias("page_count"), F.concat(F.lit("page "), n - 1 - F.col("id")).alias("text"))
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    began = time.time()
    to_files(pages.complete_documents(source), tmp_path).awaitTermination()
    assert files(spark, tmp_path) == [("long", n, "\f".join(f"page {i}" for i in range(n)), True)]
    assert time.time() - began < 120


def test_state_needs_its_store(spark, tmp_path):
    source = stream(spark, tmp_path, [("a", 0, 1, "x")])
    spark.conf.unset(pages.PROVIDER)
    try:
        with pytest.raises(ValueError, match="RocksDB"):
            pages.complete_documents(source)
    finally:
        spark.conf.set(pages.PROVIDER, pages.STORE)


def test_detection_runs_on_streams(spark, tmp_path):
    out = run(spark, pages.anonymized(stream(spark, tmp_path, [("a", 0, 1, "mail x@y.zz")])).select(F.size("entities").alias("n")), "detected")
    assert [r.n for r in out] == [1]


APPROVAL = "doc_id string, approved boolean"


def test_drafts_wait_for_their_approval(spark, tmp_path):
    """Batch by batch: before it, with it, after it; a refusal and silence are no approval."""
    (tmp_path / "in").mkdir()
    (tmp_path / "said").mkdir()
    drafts = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
    said = spark.readStream.schema(APPROVAL).parquet(f"{tmp_path}/said")
    q = pages.approved(drafts, said).writeStream.format("memory").queryName("waiting").outputMode("append").option("checkpointLocation", f"{tmp_path}/state").start()
    seen = []

    def step(new=(), approvals=()):
        for rows, schema, name in ((new, SCHEMA, "in"), (approvals, APPROVAL, "said")):
            if rows:
                spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        q.processAllAvailable()
        out = sorted((r.doc_id, r.text) for r in spark.sql("SELECT * FROM waiting").collect())
        fresh = [x for x in out if x not in seen]
        seen.extend(fresh)
        return fresh

    try:
        assert step([("a", 0, 1, "early"), ("b", 0, 1, None), ("c", 0, 1, "never")]) == []
        assert step([("a", 1, 2, "second")], [("b", False)]) == []
        assert step([], [("a", True), ("d", True)]) == [("a", "early"), ("a", "second")]
        assert step([("d", 0, 1, "late"), ("a", 2, 3, "third")]) == [("a", "third"), ("d", "late")]
        assert step([], [("b", True)]) == [("b", None)]
    finally:
        q.stop()


def test_pages_of_two_streams_are_paired(spark, tmp_path):
    schema = "doc_id string, page_index int, at timestamp, v string"
    for side, rows in (("l", [("a", 0, "2024-01-01 00:00:00", "x"), ("a", 1, "2024-01-01 00:00:00", "y"), ("b", 0, "2024-01-01 00:00:00", "z")]), ("r", [("a", 0, "2024-01-01 00:03:00", "p"), ("a", 1, "2024-01-01 09:00:00", "q"), ("c", 0, "2024-01-01 00:00:00", "s")])):
        spark.createDataFrame(rows, "doc_id string, page_index int, at string, v string").withColumn("at", F.to_timestamp("at")).write.parquet(f"{tmp_path}/{side}")
    left, right = (spark.readStream.schema(schema).parquet(f"{tmp_path}/{side}") for side in "lr")
    out = pages.paired(left, right, ["doc_id", "page_index"], "at", "10 minutes").select("a.doc_id", "a.v", F.col("b.v").alias("w"))
    assert [tuple(r) for r in run(spark, out, "paired")] == [("a", "x", "p")]

"""Exact deduplication through a log-structured merge index of text digests.

A memtable is the rows of one task: it is flushed as a run, a Parquet file sorted by
digest that carries a Bloom filter of its digests, by which point lookups skip runs.
Compaction merges the runs that are new into the level, which keeps the smallest identifier
and the count of each digest. A bitmap of bounded size of the digests that occur more than
once is the filter of that level: only rows that pass it move their text, and these hits are
verified byte by byte, by grouping on the text itself. A digest that one text has is answered
by the level, whose identifier and count must be the texts' own; one that several texts share
is told apart by them.

Everything here is DataFrame code. Defined results:

* a null text counts as the empty text; empty texts are equal to each other
* texts are equal when they are after replacing each run of white space by one space
* rows repeated with the same identifier all count in ``group_size`` and share flags
* a null identifier never stays in place of one that is not null; a group that has
  only null identifiers has a null ``keep_id`` and its rows are kept
* other columns of the input don't matter, whatever their names
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspan import scratch

#: A digest with at least this share of all rows is joined by broadcast: there are at most 1/share of them.
HEAVY_SHARE = 0.001
#: Bits of the filter, as powers of two: it never takes more than 8 MB, 16 bits for each of four million digests.
FILTER_BITS = (12, 26)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


class DigestIndex:
    """The index in one folder of the shared store: ``runs``, and the ``level`` that they are merged into."""

    def __init__(self, spark: SparkSession, digest: Callable[[Column], Column] = sha256):
        self.spark, self.digest, self.path = spark, digest, scratch.fresh(spark, "digest-index")
        self.flushed = self.merged = self.levels = 0

    def rows(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        norm = normalised(F.col(text_col))
        return docs.select(F.col(id_col).cast("long").alias("id"), norm.alias("norm")).select("id", "norm", self.digest(F.col("norm")).alias("digest"))

    def flush(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Write the digests of ``docs`` as sorted runs, a run for each task."""
        (
            self.rows(docs, id_col, text_col)
            .select("digest", "id")
            .sortWithinPartitions("digest")
            .write.option("parquet.bloom.filter.enabled#digest", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .parquet(f"{self.path}/runs/{self.flushed}")
        )
        self.flushed += 1

    def runs(self, since: int = 0) -> DataFrame:
        return self.spark.read.schema("digest binary, id long").parquet(*[f"{self.path}/runs/{k}" for k in range(since, self.flushed)])

    def compact(self) -> None:
        """Merge the runs that are new with the level: the smallest identifier and the number of rows of each digest. Equal digests meet first within each task."""
        if self.merged == self.flushed:
            return
        rows = self.runs(self.merged).select("digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("n"))
        before = self.level().unionByName(rows) if self.levels else rows
        merged = before.groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("n"))
        merged.sortWithinPartitions("digest").write.parquet(f"{self.path}/level-{self.levels}")
        if self.levels:
            scratch.remove(self.spark, f"{self.path}/level-{self.levels - 1}")
        self.merged, self.levels = self.flushed, self.levels + 1

    def level(self) -> DataFrame:
        return self.spark.read.schema("digest binary, keep_id long, n long").parquet(f"{self.path}/level-{self.levels - 1}")

    def contains(self, text: str) -> bool:
        """Point lookup: the runs' Bloom filters and footers skip those that can't hold it."""
        wanted = self.spark.range(1).select(self.digest(normalised(F.lit(text))).alias("d")).first()["d"]
        return not self.runs().where(F.col("digest") == F.lit(wanted)).isEmpty()


def repeated_filter(level: DataFrame) -> tuple[DataFrame, int]:
    """A one-row bitmap of the digests with several rows, and the power of two of its bits. Its size is bounded; when many more digests come than bits, it lets more rows pass, never fewer."""
    repeated = level.where("n > 1")
    wanted = max(1, 16 * repeated.count()).bit_length()
    bits = min(max(wanted, FILTER_BITS[0]), FILTER_BITS[1])
    h = F.pmod(F.xxhash64("digest"), F.lit(1 << bits))
    words = repeated.select(h.alias("h")).groupBy(F.shiftright("h", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits"))
    dense = level.sparkSession.range(1 << (bits - 6)).withColumnRenamed("id", "word").join(words, "word", "left")
    packed = dense.groupBy().agg(F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("w"))
    return packed.select(F.col("w.bits").alias("bitmap")), bits


def passing(rows: DataFrame, bitmap: DataFrame, bits: int) -> DataFrame:
    """The rows whose digest has its bit in the bitmap."""
    slot = rows.withColumn("slot", F.pmod(F.xxhash64("digest"), F.lit(1 << bits)))
    word = F.element_at(bitmap.scalar(), (F.shiftright("slot", 6) + 1).cast("int"))
    return slot.withColumn("word", word).where("shiftrightunsigned(word, cast(slot & 63 as int)) & 1 = 1").drop("slot", "word")


def _joined(rows: DataFrame, groups: DataFrame, heavy_from: int) -> DataFrame:
    """Left join on the digest. The few digests with very many rows are joined by broadcast, so that no task gets them all."""
    heavy, light = groups.where(F.col("n") >= heavy_from), groups.where(F.col("n") < heavy_from)
    hot = rows.join(F.broadcast(heavy), "digest")
    cold = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").join(light, "digest", "left")
    return hot.unionByName(cold)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """For each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256. See the module for the cases."""
    spark = docs.sparkSession
    index = DigestIndex(spark, digest)
    index.flush(docs, id_col, text_col)
    index.compact()
    level = index.level()
    total = level.agg(F.sum("n")).first()[0] or 0
    heavy_from = max(1000, int(total * HEAVY_SHARE))

    bitmap, bits = repeated_filter(level)
    hits = passing(index.rows(docs, id_col, text_col), scratch.written(bitmap, "digest-filter"), bits)
    by_text = hits.groupBy("digest", "norm").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    verified = scratch.written(by_text.select("digest", F.col("keep_id").alias("text_id"), F.col("n").alias("text_n")), "digest-verified")
    texts = verified.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.min("text_id").alias("text_id"), F.sum("text_n").alias("text_n"))
    groups = level.where("n > 1").join(texts, "digest", "left")
    agree = (F.col("texts") >= 1) & F.col("keep_id").eqNullSafe(F.col("text_id")) & (F.col("n") == F.col("text_n"))
    checked = F.when(F.coalesce(agree, F.lit(False)), F.col("n")).otherwise(F.raise_error(F.lit("the index and the texts differ")).cast("long"))
    groups = scratch.written(groups.select("digest", "keep_id", checked.alias("n"), "texts"), "digest-groups")
    collided = groups.where("texts > 1").select("digest")

    rows = index.runs()
    found = rows
    if not collided.isEmpty():  # different texts share a digest: these rows are told apart by their text
        found = rows.join(collided, "digest", "left_anti")
        told = hits.join(collided, "digest", "left_semi").join(by_text.join(collided, "digest", "left_semi"), ["digest", "norm"])
        told = told.select("digest", "id", "keep_id", "n")
    else:
        told = None
    out = _joined(found, groups.where("texts = 1").drop("texts"), heavy_from).select("digest", "id", F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("n", F.lit(1).cast("long")).alias("n"))
    if told is not None:
        out = out.unionByName(told)
    return out.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )

"""The corpus pipeline: quality, near duplicates, benchmark leaks, mix, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents,
whatever further ones there are among them; the mixing stage adds the place of each piece in
the mix (shard, slot, place, and whether it ends its document), and the token files are
written in that order, with an end id after the pieces that end a document and no others.
A piece that is cut by the end of its slot is followed by the next slot's words at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspan import scratch
from veilspan.llm import decontam, mixing, near_dedup, quality, tokens


def unused(docs: DataFrame, name: str) -> str:
    """A name that no column of ``docs`` has."""
    while name in docs.columns:
        name += "_"
    return name


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject. It learns from the labels of documents that are still there."""
    network, score = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), unused(docs, "score")
    return quality.score(docs, network, out=score).where(F.col(score) >= quality.THRESHOLD).drop(score)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, the one with the smallest id."""
    own = unused(docs, "gone")
    gone = near_dedup.near_dedup(docs).where("not kept").select(F.col("doc_id").alias(own)).distinct()
    gone = scratch.written(gone, "near-gone")
    small = gone.limit(near_dedup.BROADCAST_IDS + 1).count() <= near_dedup.BROADCAST_IDS
    return docs.join(F.broadcast(gone) if small else gone, F.col("doc_id").cast("long") == F.col(own), "left_anti")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, a row for each piece of a document that it takes."""
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, in its order, and what its pieces are in them. Documents without places in a mix are written in the order of their ids."""
    if set(mixing.PLACE) <= set(docs.columns):
        *order, ends = mixing.PLACE
        return tokens.read(spark, tokens.write(docs, order=tuple(order), ends=ends))
    return tokens.read(spark, tokens.write(docs))


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: SQL can't express the stages; tests/llm/test_pipeline.py holds each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared folder, and its own tables are removed."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch.fresh(spark, f"pipeline-{name}")
        with scratch.scope(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        if before:
            scratch.remove(spark, before)
        docs, before = spark.read.schema(out.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)

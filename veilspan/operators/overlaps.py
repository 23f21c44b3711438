"""Overlapping entities of a page as rows: islands, and the fold within each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veilspan.functions import spans

FIELDS = ("entity_type", "start", "end", "score", "text")


def islands(entities: DataFrame, page: list[str]) -> DataFrame:
    """Adds island: entities of a page whose chain of overlaps isn't broken. In order of start, one that begins at or after the greatest end before it begins the next island; nothing overlaps over that place."""
    order = Window.partitionBy(*page).orderBy("start", *spans.priority_columns())
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("start") >= F.col("reach"), F.lit(True)).cast("int")
    counted = F.sum(begins).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return entities.withColumn("reach", reach).withColumn("island", counted).drop("reach")


def folded(entities: DataFrame, page: list[str], floor: float | None = spans.SCORE_FLOOR) -> DataFrame:
    """page, island, fold (survivors and warnings of ``spans.resolve``): what is gathered into one row is one island, however many entities its page has. Entities below the floor are left out."""
    if floor is not None:
        entities = entities.where(F.coalesce("score", F.lit(0.0)) >= F.lit(floor))
    e = F.struct(*[F.col(c) for c in FIELDS])
    return islands(entities, page).groupBy(*page, "island").agg(F.collect_list(e).alias("all")).select(*page, "island", spans.resolve(F.col("all")).alias("fold"))


def resolved(entities: DataFrame, page: list[str], floor: float | None = spans.SCORE_FLOOR) -> DataFrame:
    """The surviving entities, a row for each."""
    return folded(entities, page, floor).select(*page, F.explode("fold.resolved").alias("e")).select(*page, "e.*")


def exposures(entities: DataFrame, page: list[str], floor: float | None = spans.SCORE_FLOOR) -> DataFrame:
    """The warnings: a row for each entity that was dropped and leaves text uncovered, with ``pos``, its place among those of its page."""
    rows = folded(entities, page, floor).select(*page, "island", F.posexplode("fold.warnings").alias("nth", "w"))
    place = F.row_number().over(Window.partitionBy(*page).orderBy("island", "nth")) - 1
    return rows.withColumn("pos", place).select(*page, "pos", "w.*")


def clashes(spans_: DataFrame, page: list[str]) -> DataFrame:
    """Pages whose spans overlap, and how many spans begin before the one before them ends: ``anonymize.apply`` refuses such a page."""
    before = F.lag("end").over(Window.partitionBy(*page).orderBy("start", "end"))
    return spans_.withColumn("before", before).where(F.col("start") < F.col("before")).groupBy(*page).agg(F.count(F.lit(1)).alias("n_overlaps"))

"""Word boxes that entities cover, and the raster parity guard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspan.functions import spans
from veilspan.operators import bins


def redaction_boxes(words: DataFrame, entities: DataFrame, page: list[str], floor: float = spans.SCORE_FLOOR) -> DataFrame:
    """For each word that an entity of its page overlaps: its whole box, text, and the sorted distinct types, comma-joined.

    A join on page and bin of offsets with the overlap as a condition, so that words far from an
    entity don't meet it; pre-aggregated by word. Only words of pages with entities go there.
    """
    e = entities.where(F.coalesce("score", F.lit(0.0)) >= F.lit(floor)).select(*page, "entity_type", F.col("start").alias("e_start"), F.col("end").alias("e_end"))
    own = words.select(*page, "seq", "start", "end", "text", "x", "y", "w", "h").join(e.select(*page).distinct(), page, "left_semi")
    met = bins.met_intervals(own, e, page, ("start", "end"), ("e_start", "e_end"))
    return met.groupBy(*page, "seq").agg(*[F.first(c).alias(c) for c in ("text", "x", "y", "w", "h")], F.array_join(F.array_sort(F.collect_set("entity_type")), ",").alias("entity_types"))


def unmatched(words: DataFrame, entities: DataFrame, page: list[str]) -> DataFrame:
    """Pages that one side lacks, which the join by page leaves out: page and ``missing``, words or entities, a row for each."""
    a, b = words.select(*page).distinct(), entities.select(*page).distinct()
    return b.join(a, page, "left_anti").withColumn("missing", F.lit("words")).unionByName(a.join(b, page, "left_anti").withColumn("missing", F.lit("entities")))


def with_pads(boxes: DataFrame, width: Column, height: Column, pad: int = 3) -> DataFrame:
    """Adds left, top, right and bottom of the padded boxes."""
    box = spans.padded(F.struct("x", "y", "w", "h"), width, height, pad)
    return boxes.withColumn("p", box).select(*boxes.columns, "p.*")


def same_raster(width: Column, height: Column, expected: Column) -> Column:
    """True, or an error where the expected dimensions are known and others."""
    differs = (width != expected["width"]) | (height != expected["height"])
    return F.when(expected.isNotNull() & differs, F.raise_error(F.lit("raster dimensions differ")).cast("boolean")).otherwise(F.lit(True))


def residual(pages: DataFrame, key: list[str], detect: Column) -> DataFrame:
    """Entities that are still found in anonymized text: a row for each."""
    return pages.select(*key, F.explode(detect).alias("e")).select(*key, "e.*")

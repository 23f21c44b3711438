"""Terms and their translations, from paragraphs that are each other's translation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilspan import scratch

#: What counts as a term: a capital letter and at least three more letters.
TERM = r"(?<![\p{L}\p{N}\[])\p{Lu}\p{L}{3,}(?![\p{L}\p{N}_\]])"
#: Paragraphs that must have both, and the least ratio: chance in a thousand.
LEAST_TOGETHER, LEAST_RATIO = 3, 10.83


def terms(text: Column, pattern: str = TERM) -> Column:
    """The distinct terms of a paragraph. Placeholders in brackets are none."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0)))


def log_likelihood(both: Column, a: Column, b: Column, n: Column) -> Column:
    """Dunning's ratio of a 2 x 2 table: ``both`` of n paragraphs have both terms, ``a`` and ``b`` each of them."""

    def part(k: Column, row: Column, col: Column) -> Column:
        return F.when(k > 0, k * F.log(k.cast("double") * n / (row.cast("double") * col))).otherwise(0.0)

    cells = part(both, a, b) + part(a - both, a, n - b) + part(b - both, n - a, b) + part(n - a - b + both, n - a, n - b)
    return F.round(2.0 * cells, 6)


def harvested(pairs: DataFrame, key: list[str], least: int = LEAST_TOGETHER, ratio: float = LEAST_RATIO) -> DataFrame:
    """Term pairs of aligned paragraphs (key, original, translated): term, translation, together, ratio.

    A pair counts once for each paragraph that has both; it must be together in ``least``
    paragraphs, more often than chance has it, and each of its terms must be the best that the
    other has: by ratio, then by paragraphs together, then by spelling. So no term comes twice.
    Terms of one paragraph meet each other, and no others; numbers are summed before they are
    exchanged.
    """
    found = scratch.written(pairs.select(*key, terms(F.col("original")).alias("a"), terms(F.col("translated")).alias("b")), "paragraph-terms")
    n = found.agg(F.count(F.lit(1)).alias("n"))
    left = found.select(F.explode("a").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_a"))
    right = found.select(F.explode("b").alias("translation")).groupBy("translation").agg(F.count(F.lit(1)).alias("n_b"))
    met = found.select(F.explode("a").alias("term"), "b").select("term", F.explode("b").alias("translation")).groupBy("term", "translation").agg(F.count(F.lit(1)).alias("together"))
    met = met.where(F.col("together") >= least).join(left, "term").join(right, "translation").withColumn("n", n.scalar())
    more = F.col("together").cast("double") * F.col("n") > F.col("n_a").cast("double") * F.col("n_b")
    met = met.where(more).withColumn("ratio", log_likelihood(F.col("together"), F.col("n_a"), F.col("n_b"), F.col("n"))).where(F.col("ratio") >= ratio)
    best = [F.desc("ratio"), F.desc("together")]
    ranked = met.withColumn("of_term", F.row_number().over(Window.partitionBy("term").orderBy(*best, "translation"))).withColumn("of_translation", F.row_number().over(Window.partitionBy("translation").orderBy(*best, "term")))
    return ranked.where("of_term = 1 and of_translation = 1").select("term", "translation", "together", "ratio")

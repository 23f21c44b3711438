"""Exact order statistics of integers, by key or over all rows, without gathering them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilspan import scratch

#: Values that are one bucket of the histogram.
BUCKET = 4096


def order_statistics(rows: DataFrame, key: list[str], value: str, ranks: dict[str, Column]) -> DataFrame:
    """key, n, least, most and for each name of ``ranks`` the value at that place (from 0, an expression of ``n``) of the key's sorted values. Nulls are left out; a place beyond the end gives null.

    Distinct values and their numbers are what is left after the first exchange, map-side sums
    before it. A histogram of them, a row for each BUCKET values, says which bucket holds a
    rank; only these buckets are ranked, so that a window has at most BUCKET rows.
    """
    key_ = key or ["__all"]
    own = (rows if key else rows.withColumn("__all", F.lit(0))).where(F.col(value).isNotNull())
    counts = own.groupBy(*key_, F.col(value).cast("long").alias("__v")).agg(F.count(F.lit(1)).alias("__m"))
    counts = scratch.written(counts.withColumn("__b", F.floor(F.col("__v") / F.lit(BUCKET)).cast("long")), "value-counts")
    over = Window.partitionBy(*key_)
    buckets = counts.groupBy(*key_, "__b").agg(F.sum("__m").alias("__m"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    buckets = buckets.withColumns({"__to": F.sum("__m").over(over.orderBy("__b")), "n": F.sum("__m").over(over), "least": F.min("__lo").over(over), "most": F.max("__hi").over(over)})
    asked = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), place.cast("long").alias("at")) for name, place in ranks.items()]))
    wanted = buckets.withColumn("__r", asked).where((F.col("__r.at") >= F.col("__to") - F.col("__m")) & (F.col("__r.at") < F.col("__to")))
    wanted = wanted.select(*key_, "__b", F.col("__r.name").alias("__name"), (F.col("__r.at") - F.col("__to") + F.col("__m")).alias("__at"))
    upto = F.sum("__m").over(Window.partitionBy(*key_, "__b", "__name").orderBy("__v"))
    found = counts.join(wanted, [*key_, "__b"]).withColumn("__upto", upto)
    found = found.where((F.col("__at") < F.col("__upto")) & (F.col("__at") >= F.col("__upto") - F.col("__m"))).select(*key_, "__name", "__v")
    values = found.groupBy(*key_).agg(*[F.max(F.when(F.col("__name") == name, F.col("__v"))).alias(name) for name in ranks])
    sizes = buckets.groupBy(*key_).agg(F.max("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
    return sizes.join(values, key_, "left").select(*key, "n", "least", "most", *ranks)

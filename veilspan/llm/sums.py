"""Sums before a row, numbers of rows, and lookups, in parts of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Values of an index that are summed in one group.
GROUP = 4096
#: Most rows, and most bytes of keys, of a table that is broadcast.
MOST_ROWS, MOST_BYTES = 200_000, 16 << 20
#: A key with at least this share of all rows counts as hot: there are at most 1/share of them.
HOT_SHARE = 0.001


def before(df: DataFrame, key: list[str], index: str, value: str, out: str) -> DataFrame:
    """``df``, one row for each key and index (a number from 0), with ``out``: the sum of ``value`` over the key's rows of a smaller index. Summed within groups of GROUP values of the index and over the groups' totals, so that no task gets all rows of a key."""
    grouped = df.withColumn("__grp", F.expr(f"`{index}` div {GROUP}"))
    totals = grouped.groupBy(*key, "__grp").agg(F.sum(value).alias("__all"))
    over = Window.partitionBy(*key).orderBy("__grp") if key else Window.orderBy("__grp")
    totals = totals.select(*key, "__grp", (F.sum("__all").over(over) - F.col("__all")).alias("__at"))
    within = F.sum(value).over(Window.partitionBy(*key, "__grp").orderBy(index)) - F.col(value)
    return grouped.withColumn("__in", within).join(totals, [*key, "__grp"]).withColumn(out, F.col("__at") + F.col("__in")).drop("__grp", "__at", "__in")


def numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """``df`` with ``out``: the number of each row, from 0, in an order that leaves no ties: by range parts, and within each."""
    spark = df.sparkSession
    parts = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).withColumn("__part", F.spark_partition_id())
    sizes = before(parts.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")), [], "__part", "__n", "__first")
    rank = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    return parts.withColumn("__rank", rank).join(F.broadcast(sizes.select("__part", "__first")), "__part").withColumn(out, F.col("__first") + F.col("__rank")).drop("__part", "__first", "__rank")


def lookup(rows: DataFrame, table: DataFrame, key: str, n: str) -> DataFrame:
    """``rows`` joined to ``table``, a written table with one row for each ``key`` (null is a key) and ``n``, the number of its rows in ``rows``. A table of bounded size is broadcast; of a larger one only the hot keys are, all others are shuffled."""
    right = table.withColumnRenamed(key, "__key")

    def join(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.join(b, a[key].eqNullSafe(b["__key"])).drop("__key")

    size = table.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length(F.coalesce(F.col(key).cast("string"), F.lit("")))).alias("bytes"), F.sum(n).alias("all")).first()
    if size["rows"] <= MOST_ROWS and (size["bytes"] or 0) <= MOST_BYTES:
        return join(rows, F.broadcast(right))
    hot = F.col(n) >= max(1, int(size["all"] * HOT_SHARE))
    heavy = right.where(hot)
    cold = rows.join(F.broadcast(heavy.select("__key")), rows[key].eqNullSafe(F.col("__key")), "left_anti")
    return join(rows, F.broadcast(heavy)).unionByName(join(cold, right.where(~hot)))

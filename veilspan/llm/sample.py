"""Bounded samples of rows to learn from, the same whatever the order and number of partitions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Takes the condition on ``doc_id`` that rows of the sample must meet; gives rows with doc_id and text, and what else counts.
Rows = Callable[[Column], DataFrame]


def sampled(rows: Rows, total: int, most_rows: int, most_bytes: int) -> DataFrame | None:
    """Distinct rows with the smallest hash of their id, at most ``most_rows`` of them, with ``h``, a number for each; None if there are none.

    They are taken in the order of (hash of doc_id, hash of the row) as long as their texts
    fit into ``most_bytes``; one that doesn't fit is passed over. ``total`` is about how many
    rows there are: as few as are needed are looked at first, and more if too many of them
    are copies. The driver gets at most ``most_rows`` numbers.
    """
    share = min(1.0, 4 * most_rows / max(1, total))
    while True:
        below = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) < F.lit(int(share * (1 << 53)))
        found = rows(below if share < 1 else F.lit(True))
        found = found.withColumn("h", F.xxhash64(*found.columns)).withColumn("first", F.xxhash64("doc_id"))
        sizes = found.groupBy("first", "h").agg(F.max(F.coalesce(F.octet_length("text"), F.lit(0))).alias("size"))
        got = sizes.orderBy("first", "h").limit(most_rows).collect()
        if len(got) == most_rows or share == 1:
            break
        share = min(1.0, 16 * share)
    taken, used = [], 0
    for r in got:
        if used + r["size"] <= most_bytes:
            taken.append((r["h"],))
            used += r["size"]
    if not taken:
        return None
    chosen = found.sparkSession.createDataFrame(taken, "h long").coalesce(1)
    return found.join(F.broadcast(chosen), "h").drop("first").dropDuplicates(["h"])

"""Propose substitutions for entities, and apply them.

``propose`` and ``apply`` are two steps, so that a reviewer may change the substitutions
between them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veilspan.functions import boundary, spans
from veilspan.functions.text import let, newlines, piece


def square(entity_type: Column, n: Column) -> Column:
    return F.concat(F.lit("["), entity_type, F.lit("_"), n.cast("string"), F.lit("]"))


#: Other spellings of placeholders.
FORMATS: dict[str, Callable[[Column, Column], Column]] = {
    "square": square,
    "double_bracket": lambda t, n: F.concat(F.lit("⟦"), t, F.lit("_"), n.cast("string"), F.lit("⟧")),
    "angle": lambda t, n: F.concat(F.lit("<<"), t, F.lit("_"), n.cast("string"), F.lit(">>")),
    "opaque": lambda t, n: F.concat(F.lit("XPIIX_"), t, F.lit("_"), n.cast("string")),
}


def normalized_rows(pages: DataFrame, key: list[str], floor: float = spans.SCORE_FLOOR, boundaries: bool = True) -> DataFrame:
    """A row for each surviving entity of pages (key, text, entities): entity_type, start, end, score, original span, actions, value, line breaks. Without ``boundaries``, spans stay as they were detected.

    Only an entity's own piece of the text goes with its row. The outer explode keeps the
    optimizer from asking for the size of the list first, which would resolve each page twice.
    """
    kept = spans.resolve(spans.above_floor(F.col("entities"), floor))["resolved"]
    pieces = F.transform(kept, lambda e: boundary.cut_out(F.col("text"), e))
    own = [F.col(k).alias(f"__key{i}") for i, k in enumerate(key)]
    rows = pages.select(*own, F.explode_outer(pieces).alias("e")).where("e is not null").select(*[f"__key{i}" for i in range(len(key))], "e.*")
    if boundaries:
        rows = boundary.normalized(rows)
    else:
        rows = rows.withColumns({"new_start": F.col("start"), "new_end": F.col("end"), "actions": F.array().cast(f"array<{boundary.ACTION}>"), "text": F.col("cut")})
    return rows.select(*[F.col(f"__key{i}").alias(k) for i, k in enumerate(key)], "entity_type", F.col("new_start").alias("start"), F.col("new_end").alias("end"), "score", F.col("start").alias("start0"), F.col("end").alias("end0"), "actions", F.replace("text", F.lit("\n"), F.lit(" ")).alias("value"), newlines(F.col("text")).alias("breaks"))


def numbered(rows: DataFrame, key: list[str], fmt: Callable[[Column, Column], Column] = square) -> DataFrame:
    """Adds number, placeholder, replacement and first_start. Equal values of a type share a number, in order of first appearance on the page."""
    first = F.min("start").over(Window.partitionBy(*key, "entity_type", "value"))
    number = F.dense_rank().over(Window.partitionBy(*key, "entity_type").orderBy("first_start"))
    r = rows.withColumn("first_start", first).withColumn("number", number)
    r = r.withColumn("placeholder", fmt(F.col("entity_type"), F.col("number")))
    return r.withColumn("replacement", F.concat("placeholder", F.repeat(F.lit("\n"), F.col("breaks"))))


def propose(pages: DataFrame, key: list[str], fmt: Callable[[Column, Column], Column] = square, floor: float = spans.SCORE_FLOOR, boundaries: bool = True) -> DataFrame:
    """For each page: substitutions in order of start, and restore_map as an array in order of first appearance. A page without entities has empty arrays."""
    return gathered(pages, numbered(normalized_rows(pages, key, floor, boundaries), key, fmt), key)


def gathered(pages: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """The rows of ``numbered`` as lists of their pages."""
    sub = F.struct("start", "end", "placeholder", "replacement", "entity_type", "value")
    entry = F.struct("first_start", "placeholder", "value")
    found = rows.groupBy(*key).agg(F.array_sort(F.collect_list(sub)).alias("substitutions"), F.array_sort(F.collect_set(entry)).alias("restore_map"))
    out = pages.select(*key, "text").join(found, key, "left")
    none_sub = F.array().cast("array<struct<start:int,end:int,placeholder:string,replacement:string,entity_type:string,value:string>>")
    none_map = F.array().cast("array<struct<first_start:int,placeholder:string,value:string>>")
    return out.withColumn("substitutions", F.coalesce("substitutions", none_sub)).withColumn("restore_map", F.coalesce("restore_map", none_map))


def apply(text: Column, substitutions: Column) -> Column:
    """The text with each span replaced; a missing replacement is its placeholder. Overlapping spans are an error."""

    def put(subs: Column) -> Column:
        def part(s: Column, i: Column) -> Column:
            before = F.when(i == 0, F.lit(0)).otherwise(F.get(subs, i - 1)["end"])
            bad = s["start"] < before
            return F.when(bad, F.raise_error(F.lit("substitutions overlap")).cast("string")).otherwise(F.concat(piece(text, before, s["start"]), F.coalesce(s["replacement"], s["placeholder"])))

        tail = F.substr(text, F.coalesce(F.try_element_at(subs, F.lit(-1))["end"], F.lit(0)) + 1, F.length(text))
        return F.concat(F.array_join(F.transform(subs, part), ""), tail)

    ordered = F.array_sort(substitutions, lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(a["end"] - b["end"]))
    return let(ordered, put)


def overlapping(substitutions: Column) -> Column:
    """How many substitutions begin before the one before them ends: ``apply`` refuses a list with any."""
    ordered = F.array_sort(F.transform(substitutions, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return let(ordered, lambda o: F.size(F.filter(F.transform(o, lambda s, i: (i > 0) & (s["start"] < F.get(o, i - 1)["end"])), lambda bad: bad)))


def warnings(pages: DataFrame, key: list[str], floor: float = spans.SCORE_FLOOR) -> DataFrame:
    """All warnings of a page's proposal, overlap exposures first: kind and a JSON text."""
    fold = pages.withColumn("r", spans.resolve(spans.above_floor(F.col("entities"), floor)))
    # the outer explode: see normalized_rows
    over = fold.select(*key, F.posexplode_outer("r.warnings").alias("pos", "w")).where("w is not null").select(*key, F.lit("overlap_exposure").alias("kind"), "pos", F.to_json("w").alias("warning"))
    # rows without actions go after the window only: before it, the filter would be moved below the steps of normalized_rows and ask for all of them again
    rows = normalized_rows(pages, key, floor).withColumn("says", F.size("actions") > 0)
    rank = F.count_if("says").over(Window.partitionBy(*key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)) - 1
    note = F.struct("entity_type", "score", "start0", "end0", "start", "end", "value", "actions")
    bound = rows.withColumn("pos", rank.cast("int")).where("says").select(*key, F.lit("boundary_normalization").alias("kind"), "pos", F.to_json(note).alias("warning"))
    return over.unionByName(bound)

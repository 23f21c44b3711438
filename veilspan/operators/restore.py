"""Put the original values back, and detect tokens that are missing or stray."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilspan.functions.text import count_of

#: Fixed value: the grammar of placeholders; review markers don't fit it.
TOKEN = r"\[[A-Z_]+_\d+\]"


def restored(text: Column, restore_map: Column) -> Column:
    """Each placeholder replaced literally, one entry after the other. Null text is empty."""
    return F.aggregate(restore_map, F.coalesce(text, F.lit("")), lambda a, m: F.replace(a, m["placeholder"], m["value"]))


def restored_count(text: Column, restore_map: Column) -> Column:
    """Occurrences of all placeholders in the text."""
    t = F.coalesce(text, F.lit(""))
    return F.aggregate(restore_map, F.lit(0), lambda a, m: a + count_of(t, m["placeholder"]))


def missing(text: Column, restore_map: Column) -> Column:
    """Placeholders that don't occur, sorted."""
    t = F.coalesce(text, F.lit(""))
    return F.array_sort(F.transform(F.filter(restore_map, lambda m: ~F.contains(t, m["placeholder"])), lambda m: m["placeholder"]))


def unresolved(restored_text: Column) -> Column:
    """Distinct tokens that are still there, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(restored_text, F.lit(TOKEN), F.lit(0))))


def colliding(text: Column, restore_map: Column) -> Column:
    """Tokens of the original text, or of a value, that a restore could take for placeholders."""
    values = F.array_join(F.transform(restore_map, lambda m: m["value"]), "\n")
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.concat_ws("\n", text, values), F.lit(TOKEN), F.lit(0))))


def page_columns(text: Column, restore_map: Column) -> list[Column]:
    """restored_text, restored_count, missing_placeholders, unresolved_tokens."""
    r = restored(text, restore_map)
    return [r.alias("restored_text"), restored_count(text, restore_map).alias("restored_count"), missing(text, restore_map).alias("missing_placeholders"), unresolved(r).alias("unresolved_tokens")]


def survived(text: Column, token: Column) -> Column:
    """A token survives if it occurs, whatever letters follow it."""
    return F.contains(text, token)

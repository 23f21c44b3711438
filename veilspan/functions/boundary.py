"""Boundary normalization of entity spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspan.functions.text import BLANKS, lstrip, newlines, piece, strip

#: Words that aren't part of a span of this type, at its start and at its end.
LEADING = {"DATE_TIME": ("on", "or", "about", "at", "from", "through", "until", "since", "by", "before", "after", "in", "within", "commencing", "effective", "date", "dated", "this", "beginning", "starting", "the", "of", "as")}
TRAILING = {"DATE_TIME": ("through", "until", "to", "and", "or", "at", "on", "from", "the", "of", "in", "by", "as")}
ACTION = "struct<action:string,token:string,count:int,reason:string,fixed:boolean>"


def _action(name: str, fixed: bool, token: Column | None = None, count: Column | None = None, reason: str | None = None) -> Column:
    none = F.lit(None)
    return F.struct(F.lit(name).alias("action"), (none if token is None else token).cast("string").alias("token"), (none if count is None else count).cast("int").alias("count"), F.lit(reason).cast("string").alias("reason"), F.lit(fixed).alias("fixed")).cast(ACTION)


def _peeled(value: Column, words: tuple[str, ...], name: str, front: bool) -> Column:
    """What is left of ``value`` after listed tokens are taken off one end, and the actions: one match finds them all."""
    any_of, blank = f"(?i:{'|'.join(words)})", f"[{BLANKS}]"
    pattern = rf"^(?:{any_of}(?:{blank}+|\z))+" if front else rf"(?:(?:^|{blank}+){any_of})+\z"
    found = F.regexp_extract(value, pattern, 0)
    rest = lstrip(F.substr(value, F.length(found) + 1)) if front else F.substr(value, F.lit(1), F.length(value) - F.length(found))
    tokens = F.filter(F.split(F.translate(found, BLANKS, " " * len(BLANKS)), " "), lambda t: t != "")
    actions = F.transform(tokens if front else F.reverse(tokens), lambda t: _action(name, True, token=t))
    return F.when(found == "", F.struct(value.alias("left"), F.array().cast(f"array<{ACTION}>").alias("actions"))).otherwise(F.struct(rest.alias("left"), actions.alias("actions")))


def splits_word(text: Column, at: Column) -> Column:
    """A letter or digit is on both sides of a place in the text."""
    return F.when(at > 0, F.substr(text, at, F.lit(2)).rlike(r"^[\p{L}\p{N}]{2}\z")).otherwise(F.lit(False))


def cut_out(text: Column, e: Column) -> Column:
    """What ``normalized`` needs of a text for one of its entities: the piece, and whether its ends split a word. The text itself needn't go along."""
    return F.struct(
        e["entity_type"].alias("entity_type"), e["start"].alias("start"), e["end"].alias("end"), e["score"].alias("score"),
        piece(text, e["start"], e["end"]).alias("cut"), splits_word(text, e["start"]).alias("mid_start"), splits_word(text, e["end"]).alias("mid_end"),
    )


def normalized(rows: DataFrame, leading: dict = LEADING, trailing: dict = TRAILING) -> DataFrame:
    """Adds new_start, new_end, actions and text of each span to rows of what ``cut_out`` gives.

    White space at both ends goes first, then listed words: all at the start before any at
    the end, compared as whole tokens in lower case. A span is never emptied: one of white
    space only stays as it is, one of listed words only keeps its trimmed form, and then
    its trims aren't reported. Newlines of the final span are counted for re-emission.
    Each step is a column, so that what later steps ask several times is computed once.
    """
    nothing = F.array().cast(f"array<{ACTION}>")
    names = rows.columns

    def only(cond: Column, action: Column) -> Column:
        return F.when(cond, F.array(action)).otherwise(nothing)

    def peel(value: Column, lists: dict, name: str, front: bool) -> Column:
        """Only types with a list are looked at."""
        out = F.struct(value.alias("left"), nothing.alias("actions"))
        for kind, words in lists.items():
            out = F.when(F.col("entity_type") == kind, _peeled(value, words, name, front)).otherwise(out)
        return out

    r = rows.withColumn("v1", strip(F.col("cut"))).withColumn("skip", F.length("cut") - F.length(lstrip(F.col("cut"))))
    r = r.withColumn("front", peel(F.col("v1"), leading, "leading_trim", True))
    r = r.withColumn("back", peel(F.col("front.left"), trailing, "trailing_trim", False))
    blank, emptied = F.col("v1") == "", F.col("back.left") == ""
    cut_front = F.col("skip") + F.length("v1") - F.length("front.left")
    r = r.withColumn("lo", F.when(blank, 0).when(emptied, F.col("skip")).otherwise(cut_front))
    r = r.withColumn("hi", F.when(blank, F.length("cut")).when(emptied, F.col("skip") + F.length("v1")).otherwise(cut_front + F.length("back.left")))
    r = r.withColumn("text", piece(F.col("cut"), F.col("lo"), F.col("hi"))).withColumn("lines", newlines(F.col("text")))
    actions = F.concat(
        only(F.col("mid_start"), _action("mid_word_start", False)),
        only(F.col("mid_end"), _action("mid_word_end", False)),
        only(blank, _action("abort_empty_span", False, reason="span is whitespace-only")),
        only(~blank & (F.length("v1") < F.length("cut")), _action("whitespace_trim", True)),
        F.when(blank, nothing).when(emptied, F.array(_action("abort_empty_span", False, reason="every token blacklisted"))).otherwise(F.concat("front.actions", "back.actions")),
        only(F.col("lines") > 0, _action("newline_reemit", True, count=F.col("lines"))),
    )
    return r.select(*names, (F.col("start") + F.col("lo")).alias("new_start"), (F.col("start") + F.col("hi")).alias("new_end"), actions.alias("actions"), "text")

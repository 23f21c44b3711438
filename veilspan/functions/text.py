"""Text columns: white space, tokens, folds and counts, by code points."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scan(items: Column, state: Column, gives: dict[str, str], step: Callable[[Column, Column], tuple[Column, dict[str, Column]]], finish: Callable[[Column], Column]) -> Column:
    """A left fold that gives out elements on its way.

    ``step`` of the state and an item returns the next state and arrays of what it gives out,
    by name; ``gives`` has the types of their elements; ``finish`` makes the result of a struct
    of ``state`` and the lists. An array can't be appended to without a copy, so items go
    in blocks: n of them cost n to the power of 1.5 copied elements, not n squared.
    """

    def begin(at: Column, nested: str) -> Column:
        return F.struct(at.alias("state"), *[F.array().cast(f"array<{nested.format(t)}>").alias(n) for n, t in gives.items()])

    def within(acc: Column, item: Column) -> Column:
        after, out = step(acc["state"], item)
        return F.struct(after.alias("state"), *[F.when(F.size(out[n]) > 0, F.concat(acc[n], out[n])).otherwise(acc[n]).alias(n) for n in gives])

    def block(acc: Column, some: Column) -> Column:
        inner = F.aggregate(some, begin(acc["state"], "{}"), within)
        return let(inner, lambda r: F.struct(r["state"].alias("state"), *[F.concat(acc[n], F.array(r[n])).alias(n) for n in gives]))

    def cut(all_: Column) -> Column:
        size = F.ceil(F.sqrt(F.greatest(F.size(all_), F.lit(1)))).cast("int")
        many = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.size(all_), F.lit(1)) - 1) / size).cast("int")), lambda k: F.slice(all_, k * size + 1, size))
        return F.when(F.size(all_) <= 64, F.array(all_)).otherwise(many)

    done = F.aggregate(let(items, cut), begin(state, "array<{}>"), block)
    return let(done, lambda r: finish(F.struct(r["state"].alias("state"), *[F.flatten(r[n]).alias(n) for n in gives])))


#: Fixed value: characters that count as white space, as regular expressions of Unicode have it.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same for a character class, those but the space, and those within a line. Letters fail two tests, not one for each character that is blank.
_LOW, _HIGH = r"\t\x0b\x0c\r\x85\xa0", r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
ODD_BLANK = rf"\n{_LOW}\x1c\x1d\x1e\x1f{_HIGH}"
BLANK, LINE_BLANK = rf"\x20{ODD_BLANK}", rf"\x20{_LOW}\x1c\x1d\x1e\x1f{_HIGH}"
#: What \\s of Unicode is, within a line.
LINE_SPACE = rf"\x20{_LOW}{_HIGH}"


def lstrip(text: Column) -> Column:
    return F.ltrim(text, F.lit(BLANKS))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(BLANKS))


def strip(text: Column) -> Column:
    """Without white space (of Unicode) at both ends. Spaces alone are what is mostly there, and are cut off by bytes; a set of characters is searched for each character of the text."""
    return F.when(text.rlike(f"[{ODD_BLANK}]"), F.btrim(text, F.lit(BLANKS))).otherwise(F.trim(text))


def is_blank(text: Column) -> Column:
    return text.rlike(rf"\A[{BLANK}]*+\z")


def piece(text: Column, start: Column, end: Column) -> Column:
    """text[start:end], from 0."""
    return F.substr(text, start + 1, end - start)


def count_of(text: Column, needle: Column) -> Column:
    """Non-overlapping occurrences of a literal text that isn't empty."""
    return ((F.length(text) - F.length(F.replace(text, needle, F.lit("")))) / F.length(needle)).cast("int")


def newlines(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def is_alnum(char: Column) -> Column:
    return char.rlike(r"^[\p{L}\p{N}]\z")


def fold_turkish(text: Column) -> Column:
    """Lower case with the dotted and dotless i kept apart."""
    return F.lower(F.translate(text, "Iİ", "ıi"))


def nonblank_lines(block: Column) -> Column:
    return F.filter(F.split(block, "\n"), lambda x: ~is_blank(x))


def literal_array(values: list[str] | tuple[str, ...]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")

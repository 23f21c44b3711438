"""Markdown blocks: rows, tables, headings, footers, and the splice of tables over pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilspan.functions.text import BLANK, LINE_BLANK, LINE_SPACE, ODD_BLANK, is_blank, let, lstrip, nonblank_lines, strip

#: Fixed values.
REVIEW_MARKER = "[TABLE — STRUCTURE UNCERTAIN, REVIEW]"
UNEVEN_FLAG = "[TABLE ROWS UNEVEN — auto-aligned, REVIEW cell placement]"
SEPARATOR = rf"\A[\n:|{LINE_SPACE}]*+-[\n:|\-{LINE_SPACE}]*+\z"
FOOTER = r"(?U)^Sayfa\s+\d+"
SPLICE_FOOTER = r"(?iU)^\s*(Sayfa|Page)\s+\d+|^\s*(FABRICATED DOCUMENT|YAZILIM TEST)"
PAGE_FOOTER = r"(?iU)(Page\s+\d+\s*[—-]|Sayfa\s+\d+\s*[—-]|FABRICATED DOCUMENT|YAZILIM TEST)"
#: The start of a block's first line, line breaks before it aside.
_TOP = rf"\A\n*+[{LINE_BLANK}]*+"
#: Kinds of a block by its text; what comes first holds.
KINDS = {
    "review": _TOP + r"\Q" + REVIEW_MARKER + r"\E",
    "table": rf"{_TOP}\|[^\n]*+\n[:|{LINE_SPACE}]*+-[:|\-{LINE_SPACE}]*+(?:\n|\z)",
    "h2": rf"{_TOP}## [{LINE_BLANK}]*+[^\n]++\n*+\z",
    "h1": rf"{_TOP}# [{LINE_BLANK}]*+[^\n]++\n*+\z",
    "footer": rf"(?U){_TOP}Sayfa[{LINE_SPACE}]++\d",
}
#: A table whose blank lines don't count.
TABLE_TOP = rf"\A[{BLANK}]*+\|[^\n]*+\n(?:[{LINE_BLANK}]*+\n)*+[:|{LINE_SPACE}]*+-[:|\-{LINE_SPACE}]*+(?:\n|\z)"
#: A gap between blocks with pipes at both sides.
PIPES_MEET = rf"\|[{LINE_BLANK}]*+\n[{LINE_BLANK}]*+\n[{BLANK}]*+\|"
#: How a block of footers begins.
FOOTER_TOP = rf"(?iU)\A[{BLANK}]*+(?:(?:Sayfa|Page)\s+\d|FABRICATED DOCUMENT|YAZILIM TEST)"
WIDTH_TWIPS, LEAST_TWIPS = 9360, 720


def is_separator(line: Column) -> Column:
    return line.rlike(SEPARATOR)


def is_pipe_row(line: Column) -> Column:
    return line.rlike(rf"(?s)\A[{BLANK}]*+\|.*\|[{BLANK}]*+\z")


def _parts(line: Column) -> Column:
    """Parts of a row between pipes, without one blank part at each end. Most rows have a pipe at both."""
    piped = line.startswith("|") & line.endswith("|") & (F.length(line) > 1)
    inner = F.when(piped, F.substr(line, F.lit(2), F.length(line) - 2)).otherwise(F.regexp_replace(line, rf"\A[{BLANK}]*+\||\|[{BLANK}]*+\z", ""))
    return F.when(~piped & line.rlike(rf"\A[{BLANK}]*+\|?[{BLANK}]*+\z"), F.array().cast("array<string>")).otherwise(F.split(inner, r"\|"))


def cells(line: Column) -> Column:
    """Cells of a row, without one blank part at each end."""
    return F.when(line.rlike(f"[{ODD_BLANK}]"), F.transform(_parts(line), strip)).otherwise(F.transform(_parts(line), lambda x: F.trim(x)))


def width(line: Column) -> Column:
    """The number of a row's cells."""
    return F.size(_parts(line))


def is_table(lines: Column) -> Column:
    return F.coalesce((F.size(lines) >= 2) & lstrip(F.try_element_at(lines, F.lit(1))).startswith("|") & is_separator(F.try_element_at(lines, F.lit(2))), F.lit(False))


def begins_table(block: Column) -> Column:
    """``is_table`` of a block's lines that aren't blank."""
    return block.rlike(TABLE_TOP)


def is_footerish(block: Column) -> Column:
    lines = nonblank_lines(block)
    return block.rlike(FOOTER_TOP) & (F.size(lines) > 0) & F.forall(lines, lambda x: x.rlike(SPLICE_FOOTER))


def is_continuation(block: Column) -> Column:
    """Pipe rows only, without a separator row."""
    lines = nonblank_lines(block)
    return (F.size(lines) > 0) & ~F.exists(lines, is_separator) & F.forall(lines, is_pipe_row)


def split_blocks(text: Column) -> Column:
    """Blocks of one page: parted by blank lines, but a block that begins with a pipe row is joined to one that ends with a pipe row (so two real tables next to each other become one). Few pages have such blocks; the parts of any other are its blocks."""
    parts = F.split(strip(text), r"\n(?U:\s*)\n")

    def edges(b: Column) -> Column:
        return let(nonblank_lines(b), lambda n: F.struct(is_pipe_row(F.try_element_at(n, F.lit(1))).alias("first"), is_pipe_row(F.try_element_at(n, F.lit(-1))).alias("last")))

    def fused(all_: Column, e: Column) -> Column:
        goes_on = lambda i: F.coalesce((i > 0) & F.get(e, i - 1)["last"] & F.get(e, i)["first"], F.lit(False))
        starts = F.filter(F.sequence(F.lit(0), F.size(all_) - 1), lambda i: ~goes_on(i))

        def block(at: Column, start: Column, k: Column) -> Column:
            own = F.slice(all_, start + 1, F.coalesce(F.get(at, k + 1), F.size(all_)) - start)
            before = lambda x, i: F.when(i > 0, F.regexp_replace(x, r"^\n+", "")).otherwise(x)
            after = lambda x, i: F.when(i < F.size(own) - 1, F.regexp_replace(x, r"\n+\z", "")).otherwise(x)
            return F.array_join(F.transform(F.transform(own, before), after), "\n")

        return let(starts, lambda at: F.transform(at, lambda start, k: block(at, start, k)))

    whole = let(parts, lambda all_: let(F.transform(all_, edges), lambda e: fused(all_, e)))
    return F.when(text.rlike(PIPES_MEET), whole).otherwise(parts)


def kind(block: Column) -> Column:
    """review, table, h2, h1, footer or paragraph: the first that fits. Line breaks around the block don't count."""
    found = F
    for name, pattern in KINDS.items():
        found = found.when(block.rlike(pattern), name)
    return found.otherwise("paragraph")


def _lines(block: Column) -> Column:
    trimmed = F.regexp_replace(F.regexp_replace(block, r"\A\n+", ""), r"\n+\z", "")
    return F.split(F.when(block.startswith("\n") | block.endswith("\n"), trimmed).otherwise(block), "\n")


def _body(lines: Column) -> Column:
    return F.filter(F.slice(lines, 3, F.greatest(F.size(lines), F.lit(1))), lambda x: ~is_blank(x))


def table_rows(block: Column) -> Column:
    """header and body cells of a table block; the separator line is left out."""
    lines = _lines(block)
    return F.struct(cells(F.substring_index(F.ltrim(block, F.lit("\n")), "\n", 1)).alias("header"), F.transform(_body(lines), cells).alias("body"))


def is_uneven(block: Column) -> Column:
    """``is_ragged`` of a table block's rows, without its cells."""
    return let(_lines(block), lambda x: let(width(F.element_at(x, 1)), lambda n: F.exists(_body(x), lambda r: width(r) != n)))


def is_ragged(rows: Column) -> Column:
    return F.exists(rows["body"], lambda r: F.size(r) != F.size(rows["header"]))


def column_widths(rows: Column) -> Column:
    """Twips for each column by its longest cell; a floor for each, so that their sum may be over the page's."""
    n = F.size(rows["header"])

    def longest(i: Column) -> Column:
        own = F.transform(rows["body"], lambda r: F.when(F.size(r) > i, F.length(F.get(r, i))).otherwise(F.lit(0)))
        return F.greatest(F.length(F.get(rows["header"], i)), F.coalesce(F.array_max(own), F.lit(0)))

    most = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), longest)).otherwise(F.array().cast("array<int>"))
    total = F.greatest(F.aggregate(most, F.lit(0), lambda a, x: a + x), F.lit(1))
    return F.transform(most, lambda m: F.greatest(F.floor(F.lit(float(WIDTH_TWIPS)) * m / total).cast("int"), F.lit(LEAST_TWIPS)))


def summary(blocks: Column) -> Column:
    """What a page's blocks do to a table that is open before it.

    lead: how many blocks at the start are rows only, of one number of cells, ``cells``, and
    lead_rows, their rows; last: the last block that isn't a footer (null: there is none, the
    table stays open); is_table and ncols, the cells of its first line. If ``lead`` reaches
    ``last``, the page passes on a table of its own number of cells and closes any other.
    """

    widths = lambda lines: F.transform(lines, width)
    even = lambda n: F.when(F.array_min(n) == F.array_max(n), F.element_at(n, 1)).otherwise(-1)

    def lead(acc: Column, b: Column) -> Column:
        """Goes on until a block isn't of the kind: what comes after isn't read."""
        own = F.when(is_continuation(b), let(widths(nonblank_lines(b)), even))
        more = lambda n: F.struct((acc["n"] + F.when(F.coalesce(n == F.coalesce(acc["cells"], n), F.lit(False)), 1).otherwise(0)).alias("n"), F.coalesce(acc["cells"], n).alias("cells"), (n.isNull() | F.coalesce(n != acc["cells"], F.lit(False))).alias("stop"))
        return F.when(acc["stop"], acc).otherwise(let(own, more))

    def tail(acc: Column, b: Column) -> Column:
        """The same from the end, for the last block that isn't a footer."""
        foot = is_footerish(b)
        found = lambda f: F.struct((acc["n"] + F.when(f, 1).otherwise(0)).alias("n"), (~f).alias("stop"))
        return F.when(acc["stop"], acc).otherwise(let(foot, found))

    def whole(all_: Column) -> Column:
        nothing = F.lit(None).cast("int")
        front = F.aggregate(all_, F.struct(F.lit(0).alias("n"), nothing.alias("cells"), F.lit(False).alias("stop")), lead)
        back = F.aggregate(F.reverse(all_), F.struct(F.lit(0).alias("n"), F.lit(False).alias("stop")), tail)
        return let(F.struct(front.alias("front"), back["n"].alias("feet")), lambda x: said(all_, x["front"], F.size(all_) - x["feet"] - 1))

    def said(all_: Column, front: Column, last: Column) -> Column:
        lines = nonblank_lines(F.get(all_, last))
        rows = F.flatten(F.transform(F.slice(all_, F.lit(1), front["n"]), nonblank_lines))
        return let(lines, lambda x: F.struct(
            front["n"].alias("lead"), F.when(front["n"] > 0, front["cells"]).alias("cells"), rows.alias("lead_rows"),
            F.when(last >= 0, last).alias("last"), F.when(last >= 0, is_table(x)).alias("is_table"), F.when(last >= 0, width(F.try_element_at(x, F.lit(1)))).alias("ncols"),
        ))

    return let(blocks, whole)

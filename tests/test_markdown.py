"""Blocks, the splice over pages and written elements, on generated pages whose content is known."""

import random

import pytest
from pyspark.sql import functions as F

from veilspan.functions import blocks
from veilspan.operators import markdown

NAMES = ("Cargo", "Tonnes", "Berth", "Crane", "Seal")


def row(rng, n):
    return "| " + " | ".join(f"{rng.choice(NAMES).lower()} {rng.randrange(99)}" for _ in range(n)) + " |"


def block(rng, kind):
    """(kind, cells, rows, text)"""
    n, k = rng.choice((2, 2, 2, 3)), rng.randrange(1, 5)
    rows = [row(rng, n) for _ in range(k)]
    if kind == "table":
        return kind, n, k, "\n".join(["| " + " | ".join(NAMES[:n]) + " |", "|" + " --- |" * n, *rows])
    if kind == "rows":
        return kind, n, k, "\n".join(rows)
    return kind, 0, 0, {"prose": f"The hold was swept at {k} bells.", "foot": f"Page {k}", "head": f"## Voyage {k}"}[kind]


def pages_of(rng):
    """Pages as lists of blocks; two blocks of pipe rows never follow each other on a page, as these would be one."""
    out = []
    for _ in range(rng.randrange(1, 6)):
        page = []
        for _ in range(rng.randrange(0, 4)):
            pipes = page and page[-1][0] in ("table", "rows")
            page.append(block(rng, rng.choice(("prose", "foot", "head") if pipes else ("prose", "foot", "table", "table", "rows", "rows"))))
        out.append(page)
    return out


def spliced(pages):
    """(page, number of blocks taken from its start) and, for each table that gains rows, (page, block): rows."""
    open_, taken, gained = None, [], {}
    for p, page in enumerate(pages):
        k = 0
        while open_ and k < len(page) and page[k][0] == "rows" and page[k][1] == open_[2]:
            gained[open_[:2]] = gained.get(open_[:2], 0) + page[k][2]
            k += 1
        taken.append(k)
        if not page:
            open_ = None  # an empty page ends a table
            continue
        rest = [i for i in range(k, len(page)) if page[i][0] != "foot"]
        if rest:
            last = page[rest[-1]]
            open_ = (p, rest[-1], last[1]) if last[0] == "table" else None
    return taken, gained


def test_splice(spark):
    rng = random.Random(12)
    docs = [pages_of(rng) for _ in range(1000)]
    text = [(d, p, "\n\n".join(b[3] for b in page)) for d, pages in enumerate(docs) for p, page in enumerate(pages)]
    got = {}
    for r in markdown.spliced_blocks(spark.createDataFrame(text, "doc int, page_index int, text string"), ["doc"]).collect():
        got.setdefault(r.doc, {})[r.page_index, r.block_idx] = r
    n_gained = 0
    for d, pages in enumerate(docs):
        taken, gained = spliced(pages)
        n_gained += len(gained)
        want = {}
        for p, page in enumerate(pages):
            for i, (kind, n, k, own) in enumerate(page or [("prose", 0, 0, "")]):
                if i >= taken[p]:
                    want[p, i - taken[p]] = (own, gained.get((p, i), 0))
        assert {k: r.added_rows for k, r in got[d].items()} == {k: v[1] for k, v in want.items()}
        for k, (own, more) in want.items():
            assert got[d][k].block.startswith(own) and len(got[d][k].block.split("\n")) == len(own.split("\n")) + more
    assert n_gained > 50


MANIFEST = """# MANIFEST

Port of Kotka

of the steamer Aino

## 1. Hold

1. Sealed on 3 May.
- Swept.

| Cargo | Tonnes | Berth |
|:--|--:|---|
| grain | 12 |
| ore | 7 | 4 | spare |
| salt | 1 | 2 |

[TABLE — STRUCTURE UNCERTAIN, REVIEW]
half a line
another

Sayfa 4
son"""


def test_elements(spark):
    p = spark.createDataFrame([(1, 2, MANIFEST), (1, 3, "Later prose\n\n## 2. End"), (1, 4, ""), (2, 0, "alone")], "doc int, page_index int, text string")
    kinds = markdown.with_kinds(markdown.page_blocks(p, ["doc"]), ["doc"])
    rows = sorted(markdown.elements(kinds, ["doc"], page_breaks=True).collect(), key=lambda r: (r.doc, r.page_index, r.block_idx, r.item_idx))
    said = [(r.style, r.text if r.cells is None else r.cells) for r in rows]
    assert said == [
        ("h1", "MANIFEST"), ("caption", "Port of Kotka"), ("caption", "of the steamer Aino"), ("h2", "1. Hold"), ("body", "1. Sealed on 3 May."), ("body", "- Swept."),
        ("flag", blocks.UNEVEN_FLAG), ("header_row", ["Cargo", "Tonnes", "Berth"]), ("row", ["grain", "12", ""]), ("row", ["ore", "7", "4"]), ("row", ["salt", "1", "2"]),
        ("flag", blocks.REVIEW_MARKER), ("body", "half a line"), ("body", "another"), ("footer", "Sayfa 4"), ("footer", "son"),
        ("body", "Later prose"), ("h2", "2. End"), ("body", "alone"),
    ]
    assert [r.text for r in rows if r.break_before] == ["Later prose"]
    assert not any(r.break_before for r in markdown.elements(kinds, ["doc"]).collect())
    assert {r.kind for r in kinds.where("flag").collect()} == {"table", "review"}


LINES = {
    "|---|": (True, True, ["---"]),
    "  | --:| :-: |  ": (True, True, ["--:", ":-:"]),
    "-": (True, False, ["-"]),
    "| tar | 4 |": (False, True, ["tar", "4"]),
    "tar | 4": (False, False, ["tar", "4"]),
    "| tar |  | 4": (False, False, ["tar", "", "4"]),
    "|": (False, False, []),
    "||": (False, True, [""]),
    " | tar | ": (False, True, ["tar"]),
    "": (False, False, []),
}


@pytest.mark.parametrize("line", LINES)
def test_lines(spark, line):
    c = F.lit(line)
    assert tuple(spark.range(1).select(blocks.is_separator(c), blocks.is_pipe_row(c), blocks.cells(c)).first()) == LINES[line]


def test_blocks_of_pipe_rows_that_follow_each_other_are_one(spark):
    rng = random.Random(2)
    a, b = block(rng, "table")[3], block(rng, "rows")[3]
    got = spark.range(1).select(blocks.split_blocks(F.lit(f"{a}\n\n{b}\n \nend")).alias("b")).first().b
    assert got == [f"{a}\n{b}", "end"]


@pytest.mark.parametrize("sizes", [[10, 10], [1, 200], [5, 30, 65], [3]])
def test_widths(spark, sizes):
    text = "| " + " | ".join("h" * min(n, 2) for n in sizes) + " |\n|" + "-|" * len(sizes) + "\n| " + " | ".join("c" * n for n in sizes) + " |"
    got = spark.range(1).select(blocks.column_widths(blocks.table_rows(F.lit(text)))).first()[0]
    assert got == [max(720, 9360 * n // sum(sizes)) for n in sizes]


def test_blank_and_fused_blocks_keep_their_line_breaks(spark):
    cases = {"": [""], "a": ["a"], "| a |\n\n\n| b |\n\nc\n\n| d |": ["| a |\n| b |", "c", "| d |"], "x\n| a |\n\n| b |\ny\n\n| c |": ["x\n| a |\n| b |\ny", "| c |"]}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.b for r in df.select("t", blocks.split_blocks(F.col("t")).alias("b")).collect()} == cases


def test_a_document_of_100_000_pages(spark):
    """A table goes over most of them: each page is a row of its own in all steps but the table itself."""
    n = 100_000
    text = F.when(F.col("id") == 1, "intro\n\n| k | v |\n|---|---|\n| 0 | 0 |\n\nPage 1").when(F.col("id") == n - 5, "prose closes it").when(F.col("id") % 1000 == 7, "Page of footers\n\nSayfa 3").otherwise(F.concat(F.lit("| "), F.col("id").cast("string"), F.lit(" | 1 |\n\nPage "), F.col("id").cast("string")))
    pages = spark.range(1, n + 1).repartition(8).select(F.lit("d").alias("doc"), F.col("id").cast("int").alias("page_index"), F.when(F.col("id") % 1000 == 7, F.lit("Sayfa 3")).otherwise(text).alias("text"))
    got = markdown.splices(pages, ["doc"]).agg(F.sum("taken").alias("taken"), F.max("target_page").alias("to"), F.max(F.when(F.col("taken") > 0, F.col("page_index"))).alias("last")).first()
    footers = len(range(7, n - 5, 1000))
    assert tuple(got) == (n - 5 - 2 - footers, 1, n - 6)
    assert markdown.spliced_blocks(pages, ["doc"]).agg(F.max("added_rows")).first()[0] == got.taken


def test_against_plain_functions_on_odd_white_space(spark):
    """Strips, separators, cells and kinds of random lines with blanks of all kinds, against Python's."""
    import re

    from veilspan.functions import text as T

    rng = random.Random(5)
    space = "".join(b for b in T.BLANKS if b not in "\x1c\x1d\x1e\x1f")
    some = [" ", "|", "-", ":", "a", "#", "## ", "# ", "Sayfa", "Page", "1", "\n", "\n\n", "| a | b |", "|---|", "é", "​", "\x00", *T.BLANKS]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(9))) for _ in range(4000)]
    lines = [t.replace("\n", "") for t in texts]

    def cells(line):
        p = line.split("|")
        p = p[1:] if not p[0].strip(T.BLANKS) else p
        p = p[:-1] if p and not p[-1].strip(T.BLANKS) else p
        return [x.strip(T.BLANKS) for x in p]

    def kind(block):
        own = block.strip("\n").split("\n")
        first = own[0].strip(T.BLANKS)
        if len(own) > 1 and first.startswith("|") and separator(own[1]):
            return "table"
        if len(own) == 1 and first.startswith(("## ", "# ")):
            return "h2" if first.startswith("## ") else "h1"
        return "footer" if re.match(f"Sayfa[{space}]+1", first) else "paragraph"

    def separator(line):
        return "-" in line and not line.strip(space + "|:-") and all(c in space + "|:-" for c in line)

    df = spark.createDataFrame([*zip(texts, lines, strict=True)], "t string, line string")
    c, line = F.col("t"), F.col("line")
    got = df.select("t", "line", T.strip(c).alias("strip"), T.is_blank(c).alias("blank"), blocks.is_separator(line).alias("sep"), blocks.is_pipe_row(c).alias("pipe"), blocks.cells(line).alias("cells"), blocks.width(line).alias("width"), blocks.kind(c).alias("kind"))
    for r in got.collect():
        s = r.t.strip(T.BLANKS)
        assert (r.strip, r.blank, r.pipe) == (s, not s, len(s) > 1 and s[0] == s[-1] == "|"), r
        assert (r.sep, r.cells, r.width, r.kind) == (separator(r.line), cells(r.line), len(cells(r.line)), kind(r.t)), r

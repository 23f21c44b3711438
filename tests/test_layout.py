"""Bands, runs and verdicts on pages made by formula, against a plain computation of the same."""

import random

import pytest
from pyspark.sql import functions as F

from veilspan.operators import layout

LINE = ["doc_id", "page_index", "line_no"]
SCHEMA = "doc_id int, page_index int, line_no int, seq int, x int, y int, w int, text string"


def grid(rng, columns, lines, first_y):
    """Words of lines: some columns 300 pixels apart, up to three words in each, edges that tremble by 9 pixels."""
    out = []
    for n in range(lines):
        for c in range(columns):
            x = 200 + 300 * c + rng.randrange(10)
            for _ in range(rng.randrange(1, 4)):
                w = rng.randrange(8, 31)
                out.append((n, x, first_y + 37 * n, w))
                x += w + rng.randrange(3, 12)
    return out


def document(rng, doc):
    """Pages of 1 to 5 columns and 0 to 4 lines, at times with a line of another shape at an edge, and a footer."""
    rows, columns = [], rng.randrange(1, 5)
    for page in range(rng.randrange(1, 5)):
        columns = columns if rng.random() < 0.7 else rng.randrange(1, 5)
        words = grid(rng, columns, rng.randrange(1, 5), 400)
        if rng.random() < 0.3:
            words = [(0, 200, 350, 25)] + [(n + 1, *r) for n, *r in words]
        words.append((90, 700, 950 if rng.random() < 0.7 else 500, 60))
        texts = ["Page 3 - notes" if n == 90 else "word" for n, *_ in words]
        rows += [(doc, page, n, k, x, y, w, t) for k, ((n, x, y, w), t) in enumerate(zip(words, texts, strict=True))]
    return rows


def plain_bands(words, threshold):
    words = sorted(words)
    return [x for k, (x, w) in enumerate(words) if k == 0 or x - sum(words[k - 1]) > threshold]


def alike(a, b):
    return len(a) == len(b) and all(abs(x - y) <= 25 for x, y in zip(a, b, strict=True))


def run_length(lines):
    n = 0
    for line in lines:
        if len(line) < 2 or not alike(line, lines[0]):
            break
        n += 1
    return n


def plain_verdicts(rows, threshold):
    """(doc, page): whether the table goes on, and the runs on both sides."""
    pages, out = {}, {}
    for d, p, n, _, x, _, w, _ in rows:
        if n != 90:
            pages.setdefault(d, {}).setdefault(p, {}).setdefault(n, []).append((x, w))
    for d, by_page in pages.items():
        shapes = {p: [plain_bands(ws, threshold) for _, ws in sorted(lines.items())] for p, lines in by_page.items()}
        order = sorted(shapes)
        for p, q in zip(order, order[1:], strict=False):
            tail, head = run_length(shapes[p][::-1]), run_length(shapes[q])
            out[d, p] = (tail >= 2 and head >= 2 and alike(shapes[p][-1], shapes[q][0]), tail, head)
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_against_a_plain_computation(spark, seed):
    rng = random.Random(seed)
    rows = [r for d in range(60) for r in document(rng, d)]
    df = spark.createDataFrame(rows, SCHEMA)
    gapped = layout.gaps(df, LINE)
    lines = layout.bands(gapped, LINE, F.lit(150), height=F.lit(1000))
    got = {(r.doc_id, r.page_index): (r.fires, r.tail_lines, r.next_head_lines) for r in layout.verdicts(layout.runs(lines, LINE[:2]), ["doc_id"]).collect()}
    want = plain_verdicts(rows, 150)
    assert got == want and {v[0] for v in want.values()} == {True, False}
    swept = {}
    for r in layout.sweep(gapped, LINE[:2], ["doc_id"], height=F.lit(1000)).collect():
        swept.setdefault(r.threshold, {})[r.doc_id, r.page_index] = r.fires
    assert set(swept) == set(layout.SWEEP)
    for t in (60, 200, 260, 420):
        assert swept[t] == {k: v[0] for k, v in plain_verdicts(rows, t).items()}


def test_quantiles_are_taken_by_place(spark):
    gaps = sorted(random.Random(1).sample(range(1000), 37))
    df = spark.createDataFrame([(1, g) for g in gaps] + [(1, None), (2, 5)], "page int, gap int")
    got = {r.page: r for r in layout.gap_quantiles(df, ["page"]).collect()}
    assert [got[1][f"p{q}"] for q in layout.QUANTILES] == [gaps[37 * q // 100] for q in layout.QUANTILES] and got[2].p50 == 5 and got[1].n == 37


@pytest.mark.parametrize(
    "y, height, text, footer",
    [(921, 1000, "plain", True), (920, 1000, "plain", False), (999, 0, "plain", False), (999, None, "plain", False), (5, 0, "see PAGE 12 - end", True), (5, 1000, "sayfa  7 — son", True), (5, 1000, "page 7", False), (5, None, "a Fabricated Document of ours", True), (5, 1000, None, False)],
)
def test_footers(spark, y, height, text, footer):
    df = spark.createDataFrame([(y, height, text)], "line_y int, h int, line_text string")
    assert layout.content_lines(df, F.col("h")).count() == (not footer)


def test_hints(spark):
    header = F.array(F.lit("Cargo"), F.lit("Tonnes"))
    full, rows = spark.range(1).select(layout.hint(header), layout.hint(header, "headerless")).first()
    for said in (full, rows):
        assert said.startswith(layout.SENTINEL + "\n") and said.endswith(f"\n{layout.SENTINEL}\n\n") and '"Cargo" | "Tonnes"' in said
    assert full != rows
    with pytest.raises(ValueError, match="unknown style"):
        layout.hint(header, "other")


def test_runs_of_whole_pages(spark):
    """Pages that hold their lines as arrays give what rows of words do."""
    rng = random.Random(9)
    df = spark.createDataFrame([r for d in range(60) for r in document(rng, d)], SCHEMA)
    page, made = LINE[:2], ("head_lines", "head_bands", "tail_lines", "tail_bands")
    want = layout.runs(layout.bands(layout.gaps(df, LINE), LINE, F.lit(150), height=F.lit(1000)), page)
    words = F.sort_array(F.collect_list(F.struct("x", "seq", "w", "text")))
    lines = df.groupBy(*LINE).agg(F.min("y").alias("y"), words.alias("s")).select(*LINE, F.struct("y", *[F.col(f"s.{c}").alias(c) for c in ("x", "w", "text")]).alias("line"))
    pages = lines.groupBy(*page).agg(F.sort_array(F.collect_list(F.struct("line_no", "line")))["line"].alias("lines"))
    got = layout.page_runs(pages.withColumn("bands", layout.page_bands(F.col("lines"), F.lit(150), F.lit(1000)))).where("head_lines is not null")
    plain = lambda rows: {tuple(r[c] for c in page): [r[c] for c in made] for r in rows.collect()}
    assert plain(got) == plain(want)


def test_sweep_of_whole_pages(spark):
    """Pages that hold their lines as arrays give the report that rows of words do."""
    rng = random.Random(11)
    df = spark.createDataFrame([r for d in range(60) for r in document(rng, d)], SCHEMA)
    page = LINE[:2]
    want = layout.sweep_report(layout.sweep(layout.gaps(df, LINE), page, ["doc_id"], height=F.lit(1000)), ["doc_id"])
    words = F.sort_array(F.collect_list(F.struct("x", "seq", "w", "text")))
    lines = df.groupBy(*LINE).agg(F.min("y").alias("y"), words.alias("s")).select(*LINE, F.struct("y", *[F.col(f"s.{c}").alias(c) for c in ("x", "w", "text")]).alias("line"))
    pages = lines.groupBy(*page).agg(F.sort_array(F.collect_list(F.struct("line_no", "line")))["line"].alias("lines"))
    got = layout.page_sweep(pages, ["doc_id"], height=F.lit(1000))
    plain = lambda rows: sorted(tuple(r) for r in rows.collect())
    assert got.columns == want.columns and plain(got) == plain(want) and any(r.steady > 1 and r.fires for r in got.collect())

"""Column bands of lines, and tables that go on over a page boundary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veilspan import scratch
from veilspan.functions.blocks import PAGE_FOOTER
from veilspan.functions.text import let
from veilspan.operators import ranks

#: Fixed values.
GAP, TOLERANCE, LEAST_RUN, FOOTER_FROM = 150, 25, 2, 0.92
SWEEP = tuple(range(60, 421, 20))
QUANTILES = (50, 75, 90, 95, 98, 99)
#: Marks a hint, so that one that leaks into a translation is seen; and what each style asks for.
SENTINEL = "[[TABLE GOES ON]]"
HINTS = {
    "full": "Give the whole table: header, separator, then a row for each record.",
    "headerless": "Give a row for each record, with a pipe at both ends; no header and no separator.",
}


def gaps(words: DataFrame, line: list[str]) -> DataFrame:
    """Adds gap: pixels between a word and the one to its left; null for a line's first word."""
    left = Window.partitionBy(*line).orderBy("x", "seq")
    return words.withColumn("gap", F.col("x") - F.lag(F.col("x") + F.col("w")).over(left))


def _said() -> list[Column]:
    """line_y and line_text, what ``content_lines`` asks of a line, from its words."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), " ")
    return [F.min("y").alias("line_y"), text.alias("line_text")]


def bands(gapped: DataFrame, line: list[str], threshold: Column, keep: tuple[str, ...] = (), height: Column | None = None) -> DataFrame:
    """For each line, the left edges of its bands in order; a gap wider than the threshold begins one. ``keep``: columns that a line's words share; ``height``: of the page, where footers are to be left out."""
    begins = F.col("gap").isNull() | (F.col("gap") > threshold)
    edges = F.array_sort(F.collect_list(F.when(begins, F.col("x")))).alias("bands")
    lines = gapped.groupBy(*line).agg(edges, *[F.first(c).alias(c) for c in keep], *([] if height is None else _said()))
    return lines if height is None else content_lines(lines, height).drop("line_y", "line_text")


def page_bands(lines: Column, threshold: Column, height: Column | None = None) -> Column:
    """``bands`` of a page that holds its lines as an array in their order, structs of y and, for its words from the left, arrays x, w and text. No row is made for a word or a line."""

    def of_line(x: Column, w: Column) -> Column:
        return F.filter(x, lambda left, i: (i == 0) | F.coalesce(left - F.get(x, i - 1) - F.get(w, i - 1) > threshold, F.lit(True)))

    if height is not None:
        lines = F.filter(lines, lambda line: ~is_footer(line["y"], height, F.coalesce(F.array_join(line["text"], " "), F.lit(""))))
    return F.transform(lines, lambda line: of_line(line["x"], line["w"]))


def bands_match(a: Column, b: Column, tolerance: int = TOLERANCE) -> Column:
    near = F.forall(F.zip_with(a, b, lambda x, y: F.abs(x - y) <= tolerance), lambda z: F.coalesce(z, F.lit(False)))
    return (F.size(a) == F.size(b)) & near


def is_footer(y: Column, height: Column, text: Column) -> Column:
    """By place on a page whose height is known and not 0, else by text."""
    low = F.coalesce((height != 0) & (y > F.lit(FOOTER_FROM) * height), F.lit(False))
    return low | text.rlike(PAGE_FOOTER)


def gap_quantiles(gapped: DataFrame, key: list[str]) -> DataFrame:
    """For each key (a document; none: over all) its gaps' number, least and greatest, and those at index int(n*q/100) of their sorted list: not interpolated."""
    return ranks.order_statistics(gapped, key, "gap", {f"p{q}": F.floor(F.col("n") * q / F.lit(100.0)) for q in QUANTILES})


def largest_gaps(gapped: DataFrame, line: list[str], k: int = 15) -> DataFrame:
    """The k widest gaps with their page and the text of their line, ties by document, page and text, all descending. ``line``: the columns that name a line, its document and page first.

    Texts are made for the lines that may be among them only: of gaps as wide as the k-th on
    the k-th's page, and of wider ones.
    """
    g = gapped.where("gap is not null")
    place = F.struct("gap", *line[:2])
    edge = g.select(place.alias("p")).orderBy(F.desc("p")).limit(k).agg(F.min("p").alias("p"))
    near = scratch.written(g.where(place >= edge.scalar()).select("gap", *line), "widest-gaps")
    said = gapped.join(F.broadcast(near.select(*line).distinct()), line, "left_semi").groupBy(*line).agg(_said()[1])
    found = near.join(said, line).select("gap", *line[:2], F.col("line_text").alias("text"))
    return found.orderBy(*[F.desc(c) for c in ("gap", *line[:2], "text")]).limit(k)


def runs(lines: DataFrame, page: list[str]) -> DataFrame:
    """For each page the leading and the trailing run: how many lines from the edge are grid-like (two bands or more) and match the first line at that edge, and that line's bands. ``lines``: content lines with line_no and bands."""
    down = Window.partitionBy(*page).orderBy("line_no")
    up = Window.partitionBy(*page).orderBy(F.desc("line_no"))

    def run(w, name: str, df: DataFrame) -> DataFrame:
        ref = F.first("bands").over(w)
        ok = (F.size("bands") >= 2) & bands_match(F.col("bands"), ref)
        df = df.withColumn("ok", ok.cast("int"))
        return df.withColumn(f"{name}_ok", F.min("ok").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn(f"{name}_ref", F.when(F.size(ref) >= 2, ref)).drop("ok")

    r = run(up, "tail", run(down, "head", lines))
    return r.groupBy(*page).agg(F.sum("head_ok").cast("int").alias("head_lines"), F.first("head_ref").alias("head_bands"), F.sum("tail_ok").cast("int").alias("tail_lines"), F.first("tail_ref").alias("tail_bands"))


def _edge_run(bands: Column, all_: Column) -> tuple[Column, Column]:
    """Length and bands of the run that ``all_``, the lines' bands or their reverse, begins with."""
    n, ref = F.size(bands), F.get(all_, F.lit(0))
    alike = F.size(F.array_distinct(bands)) == 1  # as in most pages of a table: nothing is to be compared
    stop = F.array_position(F.transform(all_, lambda b: (F.size(b) >= 2) & bands_match(b, F.get(all_, F.lit(0)))), False)
    lines = F.when(alike, F.when(F.size(ref) >= 2, n).otherwise(0)).otherwise(F.when(stop == 0, n).otherwise(stop - 1))
    return F.when(n > 0, lines.cast("int")), F.when(F.size(ref) >= 2, ref)


def _edges(bands: Column) -> Column:
    """What ``page_runs`` adds, as a struct."""

    def both(back: Column) -> Column:
        (head, head_bands), (tail, tail_bands) = _edge_run(bands, bands), _edge_run(bands, back)
        return F.struct(head.alias("head_lines"), head_bands.alias("head_bands"), tail.alias("tail_lines"), tail_bands.alias("tail_bands"))

    return let(F.reverse(bands), both)


def page_runs(pages: DataFrame) -> DataFrame:
    """``runs`` of pages whose column bands holds those of their lines in order: adds head_lines, head_bands, tail_lines and tail_bands; null without lines."""
    rows = pages.withColumn("back", F.reverse("bands"))
    (head, head_bands), (tail, tail_bands) = _edge_run(F.col("bands"), F.col("bands")), _edge_run(F.col("bands"), F.col("back"))
    return rows.withColumns({"head_lines": head, "head_bands": head_bands, "tail_lines": tail, "tail_bands": tail_bands}).drop("back")


def _fires(tail_lines: Column, tail_bands: Column, head_lines: Column, head_bands: Column) -> Column:
    fires = (tail_lines >= LEAST_RUN) & (head_lines >= LEAST_RUN) & tail_bands.isNotNull() & head_bands.isNotNull()
    return F.coalesce(fires & bands_match(tail_bands, head_bands), F.lit(False))


def verdicts(pages: DataFrame, doc: list[str], order: str = "page_index") -> DataFrame:
    """For each page but a document's last: whether its table goes on over the boundary to the next page there is."""
    nxt = Window.partitionBy(*doc).orderBy(order)
    p = pages
    for c in ("head_lines", "head_bands", order):
        p = p.withColumn(f"next_{c}", F.lead(c).over(nxt))
    p = p.where(F.col(f"next_{order}").isNotNull())
    return p.withColumn("fires", _fires(*[F.col(c) for c in ("tail_lines", "tail_bands", "next_head_lines", "next_head_bands")]))


def sweep(gapped: DataFrame, page: list[str], doc: list[str], thresholds: tuple[int, ...] = SWEEP, height: Column | None = None) -> DataFrame:
    """Verdicts for each threshold. ``height``: of the page, where footers are to be left out.

    A line's bands change only where a threshold passes one of its gaps. So a page's lines are
    read once for each stretch of thresholds between which no line of the page changes, and
    only what they come to, a row for each page and stretch, is given for every threshold.
    """
    line, limits = [*page, "line_no"], sorted(thresholds)
    # how many thresholds a gap is wider than: it begins a band for these, the first ones
    wider = F.when(F.col("gap").isNotNull(), sum(((F.col("gap") > t).cast("int") for t in limits), F.lit(0)))
    words = gapped.withColumn("wider", wider).groupBy(*line).agg(F.array_sort(F.collect_list(F.struct("x", "gap", "wider"))).alias("ws"), *([] if height is None else _said()))
    if height is not None:
        words = content_lines(words, height).drop("line_y", "line_text")
    own = F.array_distinct(F.filter(F.transform("ws", lambda w: w["wider"]), lambda n: (n > 0) & (n < len(limits))))
    all_ = F.array_sort(F.array_distinct(F.flatten(F.collect_list("changes").over(Window.partitionBy(*page)))))
    lines = words.withColumn("changes", own).withColumn("cuts", F.concat(F.array(F.lit(0)), all_, F.array(F.lit(len(limits)))))
    stretch = F.explode(F.transform(F.slice("cuts", F.lit(1), F.size("cuts") - 1), lambda c, i: F.struct(c.alias("from"), F.get("cuts", i + 1).alias("to"))))
    each = lines.withColumn("stretch", stretch)
    b = F.transform(F.filter("ws", lambda w: w["wider"].isNull() | (w["wider"] > F.col("stretch.from"))), lambda w: w["x"])
    found = runs(each.withColumn("bands", b).select(*line, "stretch", "bands"), [*page, "stretch"])
    of_page = F.explode(F.slice(F.array(*[F.lit(t) for t in limits]), F.col("stretch.from") + 1, F.col("stretch.to") - F.col("stretch.from")))
    return verdicts(found.withColumn("threshold", of_page).drop("stretch"), [*doc, "threshold"])


def page_sweep(pages: DataFrame, doc: list[str], thresholds: tuple[int, ...] = SWEEP, height: Column | None = None) -> DataFrame:
    """``sweep_report`` of pages that hold their lines as ``page_bands`` takes them, in the column lines: doc, page_index, lines.

    No row is made for a word or a line, nor for a page and a threshold. A page, a boundary and
    a document each have one entry for a stretch of thresholds over which nothing of theirs
    changes; only the report's own rows are made for each threshold.
    """
    limits = sorted(thresholds)

    def wider(x: Column, w: Column, i: Column) -> Column:
        return let(F.get(x, i) - F.get(x, i - 1) - F.get(w, i - 1), lambda gap: sum(((gap > t).cast("int") for t in limits), F.lit(0)))

    def of_line(line: Column) -> Column:
        return F.struct(line["x"].alias("x"), F.transform(line["x"], lambda _, i: F.when(i > 0, wider(line["x"], line["w"], i))).alias("wider"))

    def of_stretch(lines: Column, begins: Column) -> Column:
        edges = F.transform(lines, lambda line: F.filter(line["x"], lambda _, i: F.coalesce(F.get(line["wider"], i) > begins, F.lit(True))))
        return F.struct(begins.alias("from"), let(edges, _edges).alias("runs"))

    def begins(all_: Column) -> Column:
        return F.array_sort(F.array_distinct(all_))

    def at(stretches: Column, place: Column) -> Column:
        return F.element_at(F.filter(stretches, lambda s: s["from"] <= place), -1)

    said = F.filter("lines", lambda line: F.size(line["x"]) > 0)
    if height is not None:
        said = F.filter(said, lambda line: ~is_footer(line["y"], height, F.coalesce(F.array_join(line["text"], " "), F.lit(""))))
    own = F.concat(F.array(F.lit(0)), F.filter(F.flatten(F.col("lines.wider")), lambda n: (n > 0) & (n < len(limits))))
    rows = pages.select(*doc, "page_index", F.transform(said, of_line).alias("lines")).where(F.size("lines") > 0)
    rows = rows.withColumn("cuts", begins(own)).select(*doc, "page_index", F.transform("cuts", lambda c: of_stretch(F.col("lines"), c)).alias("here"))
    nxt = Window.partitionBy(*doc).orderBy("page_index")
    rows = rows.withColumns({"next_page_index": F.lead("page_index").over(nxt), "onto": F.lead("here").over(nxt)}).where("next_page_index is not null")

    def verdict(c: Column) -> Column:
        return F.struct(c.alias("from"), let(F.struct(at(F.col("here"), c)["runs"].alias("a"), at(F.col("onto"), c)["runs"].alias("b")), lambda p: _fires(p["a"]["tail_lines"], p["a"]["tail_bands"], p["b"]["head_lines"], p["b"]["head_bands"])).alias("fires"))

    label = F.concat(F.col("page_index").cast("string"), F.lit("->"), F.col("next_page_index").cast("string"))
    both = F.transform(begins(F.concat(F.col("here.from"), F.col("onto.from"))), verdict)
    docs = rows.select(*doc, F.struct("page_index", label.alias("label"), both.alias("parts")).alias("cell")).groupBy(*doc).agg(F.array_sort(F.collect_list("cell")).alias("cells"))

    def report(c: Column) -> Column:
        firing = F.filter("cells", lambda x: at(x["parts"], c)["fires"])
        return F.struct(c.alias("from"), F.array_join(F.transform(firing, lambda x: x["label"]), ",").alias("fires"))

    cuts = begins(F.flatten(F.transform("cells", lambda x: x["parts"]["from"])))
    docs = docs.select(*doc, F.size("cells").cast("long").alias("n_boundaries"), F.transform(cuts, report).alias("all"))
    changes = F.filter("all", lambda s, i: (i == 0) | (s["fires"] != F.get(F.col("all"), i - 1)["fires"]))
    docs = docs.select(*doc, "n_boundaries", F.posexplode(changes).alias("nth", "s"), changes.alias("each"))
    ends = F.coalesce(F.get("each", F.col("nth") + 1)["from"], F.lit(len(limits)))
    named = F.slice(F.array(*[F.lit(t) for t in limits]), F.col("s.from") + 1, ends - F.col("s.from"))
    docs = docs.select(*doc, "n_boundaries", "s.fires", F.posexplode(named).alias("since", "threshold"))
    return docs.select(*doc, "threshold", "fires", "n_boundaries", (F.col("since") + 1).alias("steady"))


def sweep_report(swept: DataFrame, doc: list[str]) -> DataFrame:
    """For each document and threshold its boundaries that fire and how many it has: doc, threshold, fires (``3->4`` and so on, comma-joined in order of pages), n_boundaries; and steady, at how many thresholds in a row up to this one the same boundaries have fired."""
    label = F.concat(F.col("page_index").cast("string"), F.lit("->"), F.col("next_page_index").cast("string"))
    cells = F.array_sort(F.collect_list(F.when(F.col("fires"), F.struct("page_index", label.alias("l")))))
    rows = swept.groupBy(*doc, "threshold").agg(F.array_join(F.transform(cells, lambda c: c["l"]), ",").alias("fires"), F.count(F.lit(1)).alias("n_boundaries"))
    order = Window.partitionBy(*doc).orderBy("threshold")
    changed = F.coalesce(F.col("fires") != F.lag("fires").over(order), F.lit(True)).cast("int")
    rows = rows.withColumn("changed", changed).withColumn("same", F.sum("changed").over(order))
    return rows.withColumn("steady", F.row_number().over(Window.partitionBy(*doc, "same").orderBy("threshold"))).select(*doc, "threshold", "fires", "n_boundaries", "steady")


def content_lines(rows: DataFrame, height: Column, y: str = "line_y", text: str = "line_text") -> DataFrame:
    """Lines that are no footers."""
    return rows.where(~is_footer(F.col(y), height, F.coalesce(text, F.lit(""))))


def carried_headers(pages: DataFrame, boundaries: DataFrame, doc: list[str]) -> DataFrame:
    """For each page that a table goes on to: doc, page_index, header, the column names of that table.

    ``pages``: doc, page_index, header (of the table that is open at the page's end, null
    without one, or without a header); ``boundaries``: the rows of ``verdicts``. A header is
    carried over pages until a verdict ends the table or a page has a later header, so that the
    third page of a table gets what the first one has.
    """
    onto = boundaries.select(*doc, F.col("next_page_index").alias("page_index"), "fires")
    rows = pages.join(onto, [*doc, "page_index"], "left").withColumn("goes_on", F.coalesce("fires", F.lit(False)))
    return _carried(rows, doc)


def headers_onto(pages: DataFrame, doc: list[str]) -> DataFrame:
    """``carried_headers`` from pages that have both: doc, page_index, header and what ``page_runs`` adds. Windows over a document's pages do, without a join: the page before is the last one that has lines."""
    before = Window.partitionBy(*doc).orderBy("page_index").rowsBetween(Window.unboundedPreceding, -1)
    tail = F.last(F.when(F.col("tail_lines").isNotNull(), F.struct("tail_lines", "tail_bands")), ignorenulls=True).over(before)
    rows = pages.withColumn("tail", tail)
    fires = _fires(*[F.col(c) for c in ("tail.tail_lines", "tail.tail_bands", "head_lines", "head_bands")])
    return _carried(rows.select(*doc, "page_index", "header", fires.alias("goes_on")), doc)


def _carried(rows: DataFrame, doc: list[str]) -> DataFrame:
    rows = rows.withColumn("table", F.count_if(~F.col("goes_on")).over(Window.partitionBy(*doc).orderBy("page_index")))
    before = Window.partitionBy(*doc, "table").orderBy("page_index").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("header", F.last("header", ignorenulls=True).over(before)).where(F.col("goes_on") & F.col("header").isNotNull()).select(*doc, "page_index", "header")


def hint(header: Column, style: str = "full") -> Column:
    """What tells a translator that a table goes on: its columns' names, and whether to give the header again (``full``) or rows only (``headerless``), between two lines of SENTINEL. Any other style is an error."""
    if style not in HINTS:
        raise ValueError(f"unknown style of hint: {style}")
    names = F.array_join(F.transform(header, lambda h: F.concat(F.lit('"'), h, F.lit('"'))), " | ")
    return F.concat(F.lit(f"{SENTINEL}\nThe table of the page before goes on here. Columns: "), names, F.lit(f". {HINTS[style]}\n{SENTINEL}\n\n"))

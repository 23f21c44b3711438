"""Block tables of Markdown pages: what a renderer would write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veilspan.functions import blocks as B
from veilspan.functions.text import is_blank, nonblank_lines, strip


def page_blocks(pages: DataFrame, doc: list[str]) -> DataFrame:
    """A row for each block: doc, page_index, block_idx, block. pages: doc, page_index, text."""
    return pages.select(*doc, "page_index", F.posexplode(B.split_blocks(F.coalesce("text", F.lit("")))).alias("block_idx", "block"))


def open_headers(pages: DataFrame, doc: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """doc, page_index, header: of the table that ends a page, but for footers; null without one. ``keep``: further columns of the pages."""
    rows = pages.select(*doc, "page_index", *keep, B.split_blocks(F.coalesce("text", F.lit(""))).alias("blocks"))
    rows = rows.select(*doc, "page_index", *keep, F.try_element_at(F.filter("blocks", lambda b: ~B.is_footerish(b)), F.lit(-1)).alias("last"))
    return rows.select(*doc, "page_index", *keep, F.when(B.begins_table(F.col("last")), B.table_rows(F.col("last"))["header"]).alias("header"))


def splices(pages: DataFrame, doc: list[str]) -> DataFrame:
    """How tables go on over pages: doc, page_index, pos (place of the page, from 1), blocks, taken (blocks at its start that go on with an open table), taken_rows, and the table's target_page, target_pos and target_block.

    A table stays open at a page's end if it is the last block but for footers; blocks of rows
    only, with its number of cells, at the start of the next page continue it. A page of
    footers only leaves it open, and so does one that it takes whole; any other page without an
    open table at its end closes it. So a page sets what is open, passes on what has its own
    number of cells, or passes on all: what is open before a page is what the last page before
    it set, unless one since then has stopped it. Both are windows over a document's pages; no
    row has more than one page. Pages come by page_index (missing ones count as 0), then by text.
    """
    rows = pages.select(*doc, F.coalesce("page_index", F.lit(0)).alias("page_index"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("blocks", B.split_blocks(F.col("text"))).withColumn("s", B.summary(F.col("blocks")))
    order = Window.partitionBy(*doc).orderBy("page_index", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = F.col("s.lead") > F.col("s.last")  # all but footers may be taken
    sets = F.coalesce(~whole, F.lit(False))
    rows = rows.withColumn("pos", F.row_number().over(order)).withColumn("sets", sets)
    opened = F.struct("pos", "page_index", F.col("s.last").alias("block"), F.col("s.ncols").alias("ncols"), F.col("s.is_table").alias("is_table"))
    rows = rows.withColumn("open", F.last(F.when(F.col("sets"), opened), ignorenulls=True).over(before)).withColumn("since", F.count_if("sets").over(before))
    fits = F.coalesce(F.col("open.is_table") & (F.col("s.cells") == F.col("open.ncols")), F.lit(False))
    rows = rows.withColumn("fits", fits).withColumn("stops", F.coalesce(whole, F.lit(False)) & ~F.col("fits"))
    stopped = F.max("stops").over(Window.partitionBy(*doc, "since").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    goes_on = F.col("fits") & ~F.coalesce("stopped", F.lit(False))
    rows = rows.withColumn("stopped", stopped).withColumn("goes_on", goes_on)
    own = {n: F.when(F.col("goes_on"), c) for n, c in (("taken_rows", F.col("s.lead_rows")), ("target_page", F.col("open.page_index")), ("target_pos", F.col("open.pos")), ("target_block", F.col("open.block")))}
    return rows.select(*doc, "page_index", "pos", "blocks", F.when(F.col("goes_on"), F.col("s.lead")).otherwise(0).alias("taken"), *[c.alias(n) for n, c in own.items()])


def spliced_blocks(pages: DataFrame, doc: list[str]) -> DataFrame:
    """Blocks after tables that go over pages are put together: doc, page_index, block_idx, block, added_rows. Each page gives its blocks to itself and the rows that are taken from it to the table's page; what meets there is one block, by the partitioning that the windows made."""
    rows = splices(pages, doc)
    none = F.lit(None)
    kept = F.transform(F.slice("blocks", F.col("taken") + 1, F.size("blocks")), lambda b, i: F.struct(F.col("pos").alias("pos"), (i + F.col("taken")).alias("block_idx"), b.alias("block"), none.cast("int").alias("from"), none.cast("array<string>").alias("more")))
    sent = F.struct(F.col("target_pos").alias("pos"), F.col("target_block").alias("block_idx"), none.cast("string").alias("block"), F.col("pos").alias("from"), F.col("taken_rows").alias("more"))
    rows = rows.select(*doc, "page_index", "taken", F.explode(F.when(F.col("taken") > 0, F.concat(kept, F.array(sent))).otherwise(kept)).alias("b")).select(*doc, "page_index", "taken", "b.*")
    own = F.col("block").isNotNull()
    met = rows.groupBy(*doc, "pos", "block_idx").agg(
        F.max(F.when(own, F.col("page_index"))).alias("page_index"), F.max(F.when(own, F.col("taken"))).alias("taken"), F.max("block").alias("block"),
        F.array_sort(F.collect_list(F.when(~own, F.struct("from", "more")))).alias("parts"),
    )
    met = met.withColumn("more", F.flatten(F.transform("parts", lambda x: x["more"])))
    joined = F.concat(F.regexp_replace("block", r"\n+\z", ""), F.lit("\n"), F.array_join("more", "\n"))
    return met.select(*doc, "page_index", (F.col("block_idx") - F.col("taken")).alias("block_idx"), F.when(F.size("more") > 0, joined).otherwise(F.col("block")).alias("block"), F.size("more").alias("added_rows"))


def with_kinds(blocks: DataFrame, doc: list[str]) -> DataFrame:
    """Adds kind, flag, in_caption, ragged and rows (header and body of a table, else null). Blank blocks are left out, as a renderer writes nothing for them."""
    b = blocks.withColumn("kind", B.kind(F.col("block")))
    first_line = strip(F.element_at(F.split(strip(F.col("block")), "\n"), 1))
    h2 = F.min(F.when(first_line.startswith("## "), F.col("block_idx"))).over(Window.partitionBy(*doc, "page_index"))
    first_page = F.min("page_index").over(Window.partitionBy(*doc))
    b = b.withColumn("first_h2", h2).withColumn("first_page", first_page)
    table, made = F.col("kind") == "table", B.table_rows(F.col("block"))
    rows = F.struct(*[F.when(table, made[c]).alias(c) for c in ("header", "body")])
    b = b.withColumn("rows", rows).withColumn("in_caption", F.coalesce((F.col("page_index") == F.col("first_page")) & (F.col("block_idx") < F.col("first_h2")), F.lit(False)))
    b = b.withColumn("ragged", F.when(table, B.is_uneven(F.col("block"))).otherwise(False)).withColumn("flag", (F.col("kind") == "review") | F.col("ragged"))
    return b.where(~is_blank(F.col("block"))).drop("first_h2", "first_page")


#: A page of a written document, in twips, and its type.
PAGE_SETUP = {"width": 12240, "height": 15840, "margin": 1440, "font": "Times New Roman", "points": 11}


def elements(kinds: DataFrame, doc: list[str], page_breaks: bool = False) -> DataFrame:
    """What is written, in order: a row for each paragraph, heading, footer line, flag, and table row (padded or cut to the header's cells). With ``page_breaks``, break_before is set for the first element of each page but a document's first; list items are paragraphs whose numbers are text."""
    body = F.regexp_replace(F.regexp_replace("block", r"^\n+", ""), r"\n+\z", "")
    lines = F.transform(nonblank_lines(body), strip)
    none = F.lit(None).cast("array<string>")

    def item(style: str, text, cells=none):
        return F.struct(F.lit(style).alias("style"), text.cast("string").alias("text"), cells.alias("cells"))

    n = F.size("rows.header")
    fit = F.transform("rows.body", lambda r: F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.coalesce(F.get(r, i), F.lit(""))))
    blank = F.lit(None).cast("string")
    table = F.concat(F.when(F.col("ragged"), F.array(item("flag", F.lit(B.UNEVEN_FLAG)))).otherwise(F.array().cast("array<struct<style:string,text:string,cells:array<string>>>")), F.array(item("header_row", blank, F.col("rows.header"))), F.transform(fit, lambda r: item("row", blank, r)))
    head = F.element_at(lines, 1)
    made = (
        F.when(F.col("kind") == "review", F.transform(lines, lambda x, i: F.when(i == 0, item("flag", x)).otherwise(item("body", x))))
        .when(F.col("kind") == "table", table)
        .when(F.col("kind") == "h2", F.array(item("h2", strip(F.substr(head, F.lit(4))))))
        .when(F.col("kind") == "h1", F.array(item("h1", strip(F.substr(head, F.lit(3))))))
        .when(F.col("kind") == "footer", F.transform(lines, lambda x: item("footer", x)))
        .otherwise(F.transform(lines, lambda x: F.when(F.col("in_caption"), item("caption", x)).otherwise(item("body", x))))
    )
    rows = kinds.select(*doc, "page_index", "block_idx", F.posexplode(made).alias("item_idx", "item")).select(*doc, "page_index", "block_idx", "item_idx", "item.*")
    if not page_breaks:
        return rows.withColumn("break_before", F.lit(False))
    place = F.struct("block_idx", "item_idx")
    first = F.min(place).over(Window.partitionBy(*doc, "page_index")) == place
    return rows.withColumn("break_before", first & (F.col("page_index") > F.min("page_index").over(Window.partitionBy(*doc))))

r"""Removal of lines that repeat across documents, as compressed keep bitmaps.

1. Each line of at least ``LEAST`` code points (white space stripped at both ends, A-Z in
   lower case) becomes a row of its digest (128 bits of SHA-256), document and place.
2. The rows are dealt out by range of the digest and sorted by digest, document and place;
   a running first value streams over them and tells each line the first document that
   holds it. Digests with a thousandth of all rows or more (a frequent-items sketch over
   all rows finds them) are cut into slices by document, each of which is a range of its
   own; the first documents of slices are compared afterwards.
3. Lines of documents that aren't the first become a bitmap for each document: words of 64
   lines, and runs of equal words. Texts aren't moved until a bitmap is applied.

A bitmap is an array of runs: ``skip`` words that are kept whole, then ``n`` words with the
same ``bits``, from the lowest bit on; 1 keeps a line. Lines beyond the last run are kept.

Everything here is DataFrame code. Defined results:

* a null text, and an empty one, has one empty line, which is kept
* a line that repeats within the first document that holds it stays there each time
* rows with equal doc_ids are one document, whatever their texts; each has its own bitmap
* rows with a null doc_id are one document that comes after all others
* lines that are shorter, or empty, are kept
* other columns of the input don't matter, whatever their names; an empty table gives none
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilspan import scratch

#: Code points that a line must have to count.
LEAST = 10
SPACE = " \t\n\x0b\x0c\r"
#: A digest with at least this share of all rows is cut into slices; how many items the sketch that finds them tracks.
HOT_SHARE, TRACKED = 0.001, 16_384
RUN = "array<struct<skip:int,n:int,bits:bigint>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def bare(line: Column) -> Column:
    """Without white space at both ends; most lines have none, and only the others are gone through."""
    edge = F.lit(SPACE).contains(F.substring(line, 1, 1)) | F.lit(SPACE).contains(F.substring(line, -1, 1))
    return F.when(edge, F.btrim(line, F.lit(SPACE))).otherwise(line)


def lowered(line: Column) -> Column:
    return F.when(F.length(line) == F.octet_length(line), F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def rows_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, uid (a hash of the text, to tell rows of one doc_id apart), text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc"), text.alias("text")).select("doc", F.xxhash64("text").alias("uid"), "text")


def sliced(lines: DataFrame) -> DataFrame:
    """``lines`` (k, doc, uid, ...), a written table, with ``slices``, into how many its digest is cut, and ``slice``."""
    spark = lines.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    h = F.xxhash64("k")
    found = lines.select(h.alias("h")).agg(F.count(F.lit(1)).alias("all"), F.expr(f"approx_top_k(h, {int(1 / HOT_SHARE)}, {TRACKED})").alias("top")).first()
    least = max(1, int(found["all"] * HOT_SHARE))
    per = max(1, found["all"] // (4 * parts))
    hot = [(x["item"], max(2, -(-x["count"] // per))) for x in found["top"] or [] if x["count"] >= least]
    table = spark.createDataFrame(hot, "h long, cut int").coalesce(1)  # at most 1 / HOT_SHARE rows
    cut = lines.withColumn("h", h).join(F.broadcast(table), "h", "left").drop("h")
    cut = cut.withColumn("slices", F.coalesce("cut", F.lit(1))).drop("cut")
    return cut.withColumn("slice", F.pmod(F.xxhash64("doc", "uid"), F.col("slices")).cast("int"))


def _later(doc: str, first: str) -> Column:
    """Whether ``doc`` comes after the first one; null comes last."""
    return F.col(first).isNotNull() & (F.col(doc).isNull() | (F.col(doc) > F.col(first)))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """doc, uid, pos (from 0) of each line that another document holds first."""
    spark = docs.sparkSession
    each = rows_of(docs, id_col, text_col).select("doc", "uid", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    each = each.select("doc", "uid", "pos", bare(F.col("line")).alias("line")).where(F.length("line") >= least)
    k = F.unhex(F.substring(F.sha2(lowered(F.col("line")), 256), 1, 32))
    lines = scratch.written(each.select(k.alias("k"), "doc", "uid", "pos"), "line-rows")
    dealt = sliced(lines).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "k", "slice")
    order = Window.partitionBy("k", "slice").orderBy(F.col("doc").asc_nulls_last(), "uid", "pos")
    streamed = dealt.withColumn("first", F.first("doc").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    streamed = streamed.withColumn("later", _later("doc", "first"))
    # what is left of slices: the lines of their first documents
    told = scratch.written(streamed.where("later or slices > 1").select(F.when(~F.col("later"), F.col("k")).alias("k"), "doc", "uid", "pos", "later"), "line-firsts")
    heads = told.where("not later")
    firsts = heads.groupBy("k").agg(F.min("doc").alias("first"))  # at most 1 / HOT_SHARE rows
    beaten = heads.join(F.broadcast(firsts), "k").where(_later("doc", "first"))
    return told.where("later").select("doc", "uid", "pos").unionByName(beaten.select("doc", "uid", "pos"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """doc, uid, n_dropped, keep (runs of words) for each document that loses lines."""
    gone = repeated(docs, id_col, text_col, least)
    words = gone.groupBy("doc", "uid", F.expr("pos div 64").cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("gone"))
    at = Window.partitionBy("doc", "uid").orderBy("word")
    words = words.withColumn("before", F.lag("word").over(at)).withColumn("as_before", F.lag("gone").over(at))
    goes_on = (F.col("word") == F.col("before") + 1) & (F.col("gone") == F.col("as_before"))
    words = words.withColumn("begins", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
    words = words.withColumn("skip", F.col("word") - F.coalesce("before", F.lit(-1)) - 1).withColumn("run", F.sum("begins").over(at))
    runs = words.groupBy("doc", "uid", "run").agg(F.min_by("skip", "word").cast("int").alias("skip"), F.count(F.lit(1)).cast("int").alias("n"), F.bitwise_not(F.first("gone")).alias("bits"), F.sum(F.bit_count("gone")).alias("gone"))
    cells = F.array_sort(F.collect_list(F.struct("run", F.struct("skip", "n", "bits").alias("r"))))
    return runs.groupBy("doc", "uid").agg(F.sum("gone").cast("long").alias("n_dropped"), F.transform(cells, lambda x: x["r"]).cast(RUN).alias("keep"))


def kept_lines(lines: Column, keep: Column) -> Column:
    """The lines that a bitmap keeps; all where it is null."""
    words = F.flatten(F.transform(keep, lambda r: F.concat(F.array_repeat(F.lit(-1).cast("long"), r["skip"]), F.array_repeat(r["bits"], r["n"]))))
    words = F.coalesce(words, F.array().cast("array<bigint>"))

    def is_kept(held: Column, i: Column) -> Column:
        word = F.coalesce(F.get(held, F.shiftright(i, 6)), F.lit(-1).cast("long"))
        return F.getbit(word, i.bitwiseAND(F.lit(63))) == 1

    # the words are one element of an array, so that they are made once for each document
    return F.element_at(F.transform(F.array(words), lambda held: F.filter(lines, lambda _, i: is_kept(held, i))), 1)


def applied(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of ``docs``: doc_id, n_lines, n_dropped, kept_text."""
    # by hash, the bitmaps being the side that is held: texts need no sort
    maps = bitmaps.select(F.col("doc").alias("own"), F.col("uid").alias("own_uid"), "n_dropped", "keep").hint("shuffle_hash")
    joined = rows_of(docs, id_col, text_col).join(maps, F.col("doc").eqNullSafe(F.col("own")) & (F.col("uid") == F.col("own_uid")), "left")
    lines = lines_of(F.col("text"))
    kept = F.when(F.col("keep").isNull(), F.col("text")).otherwise(F.array_join(kept_lines(lines, F.col("keep")), "\n"))
    return joined.select(F.col("doc").alias("doc_id"), F.size(lines).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"), kept.alias("kept_text"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """For each row of ``docs``: doc_id, n_lines, n_dropped, kept_text. See the module for the cases."""
    bitmaps = scratch.written(keep_bitmaps(docs, id_col, text_col, least), "line-bitmaps")
    return applied(docs, bitmaps, id_col, text_col)

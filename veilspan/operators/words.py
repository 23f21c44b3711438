"""Pages from recognised words: lines, text and character spans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veilspan.functions.text import is_blank, strip


def kept_words(raw: DataFrame) -> DataFrame:
    """Rows with text and a confidence that isn't negative; any other confidence is kept. ``conf`` may be text."""
    conf = F.coalesce(F.expr("try_cast(try_cast(conf AS double) AS int)"), F.lit(-1))
    return raw.withColumn("conf", conf).where(~is_blank(F.coalesce("text", F.lit(""))) & (F.col("conf") >= 0)).withColumn("text", strip(F.col("text")))


def with_line_id(raw: DataFrame) -> DataFrame:
    """Line numbers begin anew in each block, so that all three numbers are needed."""
    return raw.withColumn("line_id", F.concat_ws(":", "block_num", "par_num", "line_num"))


def with_char_spans(words: DataFrame, page: list[str], line: str = "line_id", seq: str = "seq") -> DataFrame:
    """Adds line_seq, start and end: words joined by a space within a line, lines by a line break, in the order they are first seen."""
    line_seq = F.min(seq).over(Window.partitionBy(*page, line))
    w = words.withColumn("line_seq", line_seq)
    upto = Window.partitionBy(*page).orderBy("line_seq", seq).rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("text")
    end = F.sum(size + 1).over(upto) - 1
    return w.withColumn("end", end.cast("int")).withColumn("start", (F.col("end") - size).cast("int"))


def line_rows(words: DataFrame, page: list[str], line: str = "line_id", seq: str = "seq") -> DataFrame:
    """A row for each line: its text and the union of its words' boxes."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(seq), F.col("text")))), lambda x: x["text"]), " ")
    return words.groupBy(*page, line).agg(
        F.min(seq).alias("line_seq"),
        text.alias("text"),
        F.min("x").alias("x"),
        F.min("y").alias("y"),
        (F.max(F.col("x") + F.col("w")) - F.min("x")).alias("w"),
        (F.max(F.col("y") + F.col("h")) - F.min("y")).alias("h"),
    )


def page_text(lines: DataFrame, page: list[str]) -> DataFrame:
    """A row for each page: its lines joined by line breaks, in the order they are first seen."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_seq", "text"))), lambda x: x["text"]), "\n")
    return lines.groupBy(*page).agg(text.alias("text"))


def span_violations(words: DataFrame, texts: DataFrame, page: list[str]) -> DataFrame:
    """Words whose span doesn't cut their own text out of the page, or begins before the one before it. None in a sound table."""
    before = F.lag("start").over(Window.partitionBy(*page).orderBy("line_seq", "seq"))
    w = words.withColumn("before", before)
    cut = F.substr(F.col("page_text"), F.col("start") + 1, F.col("end") - F.col("start"))
    return w.join(texts.withColumnRenamed("text", "page_text"), page).where(~cut.eqNullSafe(F.col("text")) | (F.col("start") < F.col("before"))).drop("before", "page_text")


def confidence_summary(words: DataFrame, page: list[str], low: int = 60) -> DataFrame:
    return words.groupBy(*page).agg(
        F.count(F.lit(1)).alias("n_words"),
        F.avg("conf").alias("mean_conf"),
        F.min("conf").alias("min_conf"),
        F.max("conf").alias("max_conf"),
        F.count_if(F.col("conf") < low).alias("n_low"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("conf") < low, F.struct("seq", "text")))).getField("text"), " ").alias("low_words"),
    )


def nested_pages(words: DataFrame, lines: DataFrame, page: list[str]) -> DataFrame:
    """The page envelope: text, lines and words of each page as arrays."""
    box = F.struct("x", "y", "w", "h").alias("box")
    w = words.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct("line_seq", "seq", F.struct("text", box, "conf", "line_id", F.struct("start", "end").alias("char_span")).alias("word")))).getField("word").alias("words"))
    n = lines.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct("line_seq", "text", F.struct("line_id", "text", box).alias("line")))).alias("own"))
    n = n.select(*page, F.array_join(F.col("own.text"), "\n").alias("text"), F.col("own.line").alias("lines"))
    return n.join(w, page)

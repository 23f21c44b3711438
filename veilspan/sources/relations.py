"""Relations made from the given tables by fixed formulas, so that each operator meets cases that the raw tables lack."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = ["doc_id", "page_index"]
#: A page height that makes its tenth line a footer.
HEIGHT = 700
#: Fields of a certificate, from customer; SQL that Spark and DuckDB read alike.
PROFILE = (
    ("translator_full_name", "c_name"),
    ("ata_member_number", "CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '12' END"),
    ("source_language", "'English'"),
    ("target_language", "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Turkish' END"),
    ("page_count", "'0'"),
    ("date", "CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '2024' END"),
    ("state_name", "' '"),
)
LINES_ON_PAGE = 10

#: SQL that Spark and DuckDB read alike: spans with long chains of overlaps.
SPAN_COLUMNS = {
    "doc_id": "l_orderkey",
    "entity_type": "CASE l_partkey % 3 WHEN 0 THEN 'PERSON' WHEN 1 THEN 'LOCATION' ELSE 'DATE_TIME' END",
    "s": "CAST(l_linenumber * 3 + l_partkey % 4 AS INT)",
    "e": "CAST(l_linenumber * 3 + l_partkey % 4 + 1 + l_suppkey % 9 AS INT)",
    "score": "CAST((l_partkey * 7 + l_suppkey * 13 + l_linenumber * 5) % 20 AS DOUBLE) / 20",
}
#: A court record for each order. The later columns use the earlier ones.
DECREE_COLUMNS = (
    ("name", "'Ilgin' || chr(10) || 'Q. N' || CAST(o_custkey % 7 AS STRING)"),
    ("flat", "'Ilgin Q. N' || CAST(o_custkey % 7 AS STRING)"),
    ("dt", "'On or about January ' || CAST(1 + o_orderkey % 28 AS STRING) || ', 2024 through'"),
    ("alpha", "lpad(CAST(o_orderkey % 9973 AS STRING), 4, '0') || '-CV-' || lpad(CAST(o_custkey AS STRING), 6, '0')"),
    ("numeric_no", "'24-' || lpad(CAST(o_custkey % 10000 AS STRING), 4, '0') || '-' || lpad(CAST(o_orderkey % 100000 AS STRING), 5, '0')"),
    ("label", "CASE o_orderkey % 3 WHEN 0 THEN 'docket' WHEN 1 THEN 'Esas No' ELSE 'sheet' END"),
    ("body", "'In ' || alpha || ' and ' || label || ' ' || numeric_no || ', ' || name || ' appeared  ' || dt || ' Sunday; later ' || flat || ' met Ostrava and left at about.'"),
)
#: (entity_type, start, length, score, condition) of the record's spans.
DECREE_SPANS = (
    ("'PERSON'", "instr(body, name) - 1", "length(name)", "0.85", "TRUE"),
    ("'PERSON'", "instr(body, '; later ') + 7 - CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END", "length(flat) + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END", "0.9", "TRUE"),
    ("'DATE_TIME'", "instr(body, dt) - 1", "length(dt)", "0.6", "TRUE"),
    ("'DATE_TIME'", "instr(body, 'left at about') + 7", "5", "0.5", "TRUE"),
    ("'PERSON'", "instr(body, 'Ostrava') - 1", "4", "0.4", "o_orderkey % 5 = 0"),
    ("'LOCATION'", "instr(body, 'appeared  ') + 8", "1", "0.3", "o_orderkey % 4 = 0"),
    ("'ORG'", "instr(body, ' Sunday') - 1", "7", "0.2", "TRUE"),
)


def spread(df: DataFrame) -> DataFrame:
    """A table whose files give fewer parts than there are cores is dealt out over all of them, as what follows is much work for each row; a larger one stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of a table's files whose rows one task gets, where each becomes many rows later on.
PART_BYTES = {"documents": 4 << 20, "lineitem": 1 << 20, "orders": 1 << 20}
#: The same for documents that become images of 24 kB; images that leave Python together.
IMAGE_PART_BYTES, IMAGES_AT_ONCE = 1 << 20, 64


def parts(spark: SparkSession, sf_dir: str, name: str, most: int | None = None) -> int:
    """To how many parts a table is dealt out, a multiple of the cores. Their number grows with the files, so that what a task sorts stays as large as it is; left to the size of what is shuffled, parts would be as large for rows that become a hundred rows as for others."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    size = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    cores = spark.sparkContext.defaultParallelism
    return -(-max(1, size) // ((most or PART_BYTES[name]) * cores)) * cores


def span_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, entity_type, s, e, score: a row for each line of an order."""
    return spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")).selectExpr(*[f"{x} AS {n}" for n, x in SPAN_COLUMNS.items()])


def span_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, entities."""
    e = F.struct("entity_type", F.col("s").alias("start"), F.col("e").alias("end"), "score", F.lit("").alias("text"))
    return span_rows(spark, sf_dir).groupBy("doc_id").agg(F.collect_list(e).alias("entities"))


def decrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, page_index, text, entities."""
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").repartition(parts(spark, sf_dir, "orders"), "o_orderkey")
    for name, x in DECREE_COLUMNS:
        df = df.withColumn(name, F.expr(x))
    made = [F.expr(f"CASE WHEN {cond} THEN named_struct('entity_type', {t}, 'start', CAST({s} AS INT), 'end', CAST({s} + {n} AS INT), 'score', CAST({p} AS DOUBLE), 'text', substr(body, {s} + 1, {n})) END") for t, s, n, p, cond in DECREE_SPANS]
    return df.select(F.col("o_orderkey").alias("doc_id"), F.lit(0).alias("page_index"), F.col("body").alias("text"), F.array_compact(F.array(*made)).alias("entities"))


#: SQL that Spark and DuckDB read alike: edits of a proposal (condition, id, version, action, start, end, type), its columns being named a for start and b for end.
EDITS = (
    ("(doc_id + a) % 5 = 0", "proposal_id", "1", "'reject'", "NULL", "NULL", "NULL"),
    ("(doc_id + a) % 5 = 0 AND doc_id % 2 = 0", "proposal_id", "2", "'accept'", "NULL", "NULL", "NULL"),
    ("(doc_id + a) % 5 = 1", "proposal_id", "4", "'retype'", "NULL", "NULL", "'REVIEWED'"),
    ("(doc_id + a) % 5 = 1", "proposal_id", "3", "'reject'", "NULL", "NULL", "NULL"),
    ("(doc_id + a) % 5 = 2", "proposal_id", "1", "'move'", "a", "b - 1 - doc_id % 3", "NULL"),
    ("(doc_id + a) % 5 = 3 AND doc_id % 3 = 0", "'gone' || proposal_id", "1", "'retype'", "NULL", "NULL", "'REVIEWED'"),
    ("entity_type = 'ORG' AND doc_id % 3 = 1", "'head'", "1", "'add'", "0", "2", "'HEADING'"),
    ("entity_type = 'ORG' AND doc_id % 7 = 1", "'beyond'", "1", "'add'", "5", "100000", "'HEADING'"),
)


def edit_log(proposed: DataFrame) -> DataFrame:
    """doc_id, page_index, proposal_id, version, action, start, end, entity_type, from proposals."""
    made = [f"CASE WHEN {cond} THEN named_struct('proposal_id', {i}, 'version', {v}, 'action', {act}, 'start', CAST({s} AS INT), 'end', CAST({e} AS INT), 'entity_type', CAST({t} AS STRING)) END" for cond, i, v, act, s, e, t in EDITS]
    rows = proposed.select("doc_id", "page_index", "proposal_id", "entity_type", F.col("start").alias("a"), F.col("end").alias("b"))
    return rows.select("doc_id", "page_index", F.explode(F.array_compact(F.array(*[F.expr(m) for m in made]))).alias("e")).select("doc_id", "page_index", "e.*")


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, page_index, line_no, line_id, text: documents cut into pages of ten lines, dealt out by page before lines become words: what asks for a page's words then finds them in one part."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("i", "text"))
    no = F.col("i") % LINES_ON_PAGE
    lines = lines.select("doc_id", F.expr(f"CAST(i DIV {LINES_ON_PAGE} AS INT)").alias("page_index"), "i", "text").repartition(parts(spark, sf_dir, "documents"), *PAGE)
    return lines.select(*PAGE, no.alias("line_no"), F.expr(f"concat_ws(':', i % {LINES_ON_PAGE} DIV 4, i % 4 DIV 2, i % {LINES_ON_PAGE})").alias("line_id"), "text")


def raw_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words as a recogniser gives them, blank ones and ones of confidence -1 among them, in up to three columns."""
    w = page_lines(spark, sf_dir).select("doc_id", "page_index", "line_no", "line_id", F.posexplode(F.split("text", " ")).alias("k", "text"))
    column = "least(k DIV 3, 2)"
    return w.select(
        "doc_id", "page_index", "line_no", "line_id", (F.col("line_no") * 100_000 + F.col("k")).alias("seq"), "text",
        F.expr("CAST((doc_id * 7 + k * 13 + line_no * 3) % 101 - 1 AS INT)").alias("conf"),
        F.expr(f"CAST(300 + 600 * {column} + 60 * (k - 3 * {column}) + (doc_id * 7 + line_no * 11) % 40 AS INT)").alias("x"),
        (300 + 40 * F.col("line_no")).alias("y"), F.least(12 * F.length("text"), F.lit(50)).alias("w"), F.lit(30).alias("h"),
    )


#: Width and height of the made images; the bars on them: x, y, w and h, in SQL that Spark and DuckDB read alike.
IMAGE = (200, 120)
IMAGE_BARS = (
    ("20", "20", "1 + doc_id % 40", "1 + doc_id % 7"),
    ("150 + doc_id % 3", "15", "1 + doc_id % 5", "1 + doc_id % 30"),
    ("60", "90", "2", "2"),
    ("CASE WHEN doc_id % 4 = 0 THEN 130 ELSE 80 END", "92", "4 + doc_id % 60", "5"),
    ("199", "0", "1", "1"),
)


def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, page_index, image, width, height: gray pages of documents with bars of ink."""
    import numpy as np
    import pyarrow as pa

    width, height = IMAGE
    cells = [F.expr(f"CAST({x} AS INT)") for bar in IMAGE_BARS for x in bar]
    df = table(spark, sf_dir, "documents").select("doc_id").repartition(parts(spark, sf_dir, "documents", IMAGE_PART_BYTES))  # a part is what an Arrow batch may hold
    df = df.select(F.col("doc_id").cast("string").alias("path"), F.array(*cells).alias("bars"))

    def run(batches):
        for batch in (b.slice(k, IMAGES_AT_ONCE) for b in batches for k in range(0, b.num_rows, IMAGES_AT_ONCE)):
            images = []
            for bars in batch.column("bars").to_pylist():
                page = np.full((height, width), 0xF0, np.uint8)
                for x, y, w, h in zip(bars[0::4], bars[1::4], bars[2::4], bars[3::4], strict=True):
                    page[y : y + h, x : x + w] = 0x10
                images.append(page.tobytes())
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array([0] * n, pa.int32()), pa.array(images, pa.binary()), pa.array([width] * n, pa.int32()), pa.array([height] * n, pa.int32())], ["path", "page_index", "image", "width", "height"])

    return df.mapInArrow(run, "path string, page_index int, image binary, width int, height int")


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, page_index, text of whole pages."""
    lines = page_lines(spark, sf_dir)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), "\n")
    return lines.groupBy(*PAGE).agg(text.alias("text"))


def markdown_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, page_index, text: a table of an order's lines, three on a page, with all that comes around tables."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").repartition(parts(spark, sf_dir, "lineitem"), "l_orderkey")
    from pyspark.sql.window import Window

    rank = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")) - 1
    li = li.withColumn("k", rank).withColumn("page", F.expr("CAST(k DIV 3 AS INT)"))
    row = F.expr("'| part ' || CAST(l_partkey AS STRING) || ' | ' || CAST(l_suppkey AS STRING) || CASE WHEN l_orderkey % 5 = 0 AND k = 4 THEN ' | extra |' ELSE ' |' END")
    rows = F.array_join(F.sort_array(F.collect_list(F.struct("k", row.alias("r"))))["r"], "\n")
    p = li.groupBy("l_orderkey", "page").agg(rows.alias("rows"))
    return p.select(F.col("l_orderkey").alias("doc_id"), F.col("page").alias("page_index"), F.expr(MARKDOWN_TEXT).alias("text"))


#: SQL that Spark and DuckDB read alike: the text of a page from l_orderkey, page and rows.
MARKDOWN_TEXT = """CASE WHEN page = 0 THEN '# ORDER ' || CAST(l_orderkey AS STRING) || chr(10) || chr(10) || 'Caption of the case' || chr(10) || chr(10) || '## I. ITEMS' || chr(10) || chr(10)
 || '| Item | Supplier |' || chr(10) || '| :--- | :--- |' || chr(10) ELSE '' END
 || CASE WHEN l_orderkey % 7 = 3 AND page = 1 THEN '| Item | Supplier |' || chr(10) || '| --- | --- |' || chr(10) ELSE '' END
 || rows
 || CASE WHEN l_orderkey % 4 = 1 THEN chr(10) || chr(10) || 'Closing [PERSON_2] davac row' || chr(10) || '[PERSON_3] daval row' ELSE '' END
 || CASE WHEN l_orderkey % 6 = 2 AND page = 0 THEN chr(10) || chr(10) || '[TABLE — STRUCTURE UNCERTAIN, REVIEW]' || chr(10) || 'loose row' ELSE '' END
 || chr(10) || chr(10) || CASE WHEN l_orderkey % 2 = 0 THEN 'Sayfa ' ELSE 'Page ' END || CAST(page + 1 AS STRING)"""


#: A translator that writes each word by other letters; SQL that Spark and DuckDB read alike.
TRANSLATED = "translate(line, 'ABEHOSTWaeinorstdh', 'EHTBSOWAeaonirtshd')"
#: Lines whose translation is that of the line before.
SHIFTED = "(doc_id + line_no) % 5 = 0"


def translated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, line_no, original, translated: lines of documents."""
    from pyspark.sql.window import Window

    lines = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_no", "line"))
    before = F.lag("line").over(Window.partitionBy("doc_id").orderBy("line_no"))
    return lines.withColumn("before", before).select("doc_id", "line_no", F.col("line").alias("original"), F.expr(f"CASE WHEN {SHIFTED} THEN {TRANSLATED.replace('line', 'before')} ELSE {TRANSLATED} END").alias("translated"))


def ledger_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, page_index, text: a table of an order's lines, two on a page, over up to four pages, at times with a second header or closing prose."""
    from pyspark.sql.window import Window

    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").repartition(parts(spark, sf_dir, "lineitem"), "l_orderkey")
    rank = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")) - 1
    li = li.withColumn("k", rank).withColumn("page", F.expr("CAST(k DIV 2 AS INT)"))
    row = F.expr("'| part ' || CAST(l_partkey AS STRING) || ' | ' || CAST(l_suppkey AS STRING) || ' |'")
    rows = F.array_join(F.sort_array(F.collect_list(F.struct("k", row.alias("r"))))["r"], "\n")
    return li.groupBy("l_orderkey", "page").agg(rows.alias("rows")).select(F.col("l_orderkey").alias("doc_id"), F.col("page").alias("page_index"), F.expr(LEDGER_TEXT).alias("text"))


def ledger_words(pages: DataFrame, spread: bool = False) -> DataFrame:
    """Words of ledger pages as a recogniser gives them: a cell is a word, 600 pixels from the one before it; the page's number is at its foot. With ``spread``, cells are nearer to each other by the document's number."""
    from veilspan.functions import blocks

    lines = pages.select("doc_id", "page_index", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).where("line <> '' AND line NOT LIKE '|--%'")
    parts = F.when(F.col("line").startswith("|"), blocks.cells(F.col("line"))).otherwise(F.array("line"))
    w = lines.select("doc_id", "page_index", "line_no", "line", F.posexplode(parts).alias("k", "text"))
    y = F.when(F.col("line").startswith("Page "), F.lit(670)).otherwise(100 + 20 * F.col("line_no"))
    return w.select("doc_id", "page_index", "line_no", (F.col("line_no") * 100 + F.col("k")).alias("seq"), "text", (300 + ledger_step(spread) * F.col("k")).alias("x"), y.alias("y"), F.lit(100).alias("w"), F.lit(15).alias("h"))


def ledger_step(spread: bool) -> Column:
    """Pixels from a cell to the next."""
    return F.expr("CAST(160 + doc_id % 40 * 10 AS INT)") if spread else F.lit(600)


def ledger_lines(text: Column, spread: bool = False) -> Column:
    """The same words by page: an array of its lines, structs of y and of x, w and text of its words."""
    from veilspan.functions import blocks
    from veilspan.functions.text import let

    def line(said: Column, i: Column) -> Column:
        parts = F.when(said.startswith("|"), blocks.cells(said)).otherwise(F.array(said))
        y = F.when(said.startswith("Page "), F.lit(670)).otherwise(100 + 20 * i)
        return F.when((said != "") & ~said.startswith("|--"), let(parts, lambda words: of_words(y, words)))

    def of_words(y: Column, words: Column) -> Column:
        n = F.size(words)
        x = F.when(n > 0, F.sequence(F.lit(300), 300 + ledger_step(spread) * (n - 1), ledger_step(spread))).otherwise(F.array().cast("array<int>"))
        return F.struct(y.alias("y"), x.alias("x"), F.array_repeat(F.lit(100), n).alias("w"), words.alias("text"))

    return F.array_compact(F.transform(F.split(text, "\n"), line))


#: SQL that Spark and DuckDB read alike: the text of a ledger page from l_orderkey, page and rows.
LEDGER_TEXT = """CASE WHEN page = 0 THEN 'Ledger of goods' || chr(10) || chr(10) || '| Item ' || CAST(l_orderkey AS STRING) || ' | Supplier |' || chr(10) || '|---|---|' || chr(10) ELSE '' END
 || CASE WHEN l_orderkey % 7 = 3 AND page = 1 THEN '| Piece ' || CAST(l_orderkey AS STRING) || ' | Maker |' || chr(10) || '|---|---|' || chr(10) ELSE '' END
 || rows || CASE WHEN l_orderkey % 4 = 1 AND page = 1 THEN chr(10) || chr(10) || 'Closing prose' ELSE '' END
 || chr(10) || chr(10) || 'Page ' || CAST(page + 1 AS STRING)"""

"""Readers and writers: documents as bytes, recognised pages as JSON, payloads, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspan import schema
from veilspan.operators.docs import sniffed


def documents(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, content and format of files; an empty or unsupported one is an error."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length", "content", sniffed(F.col("content")).alias("format"))


def pages_json(spark: SparkSession, path: str) -> DataFrame:
    """Recognised pages of saved envelopes, an object or a list with one, a row for each page, a document's in order: doc_id (the file), page_index (its place where it is missing) and the page's fields. A page without words is an error."""
    raw = spark.read.schema(schema.ENVELOPE).option("multiLine", True).option("mode", "FAILFAST").json(path)
    rows = raw.select(F.input_file_name().alias("doc_id"), F.posexplode("pages").alias("pos", "p"))
    checked = F.when(F.size("p.words") > 0, F.col("p.words")).otherwise(F.raise_error(F.lit("page without words")).cast(T.ArrayType(schema.WORD)))
    pages = rows.select("doc_id", F.coalesce("p.page_index", "pos").alias("page_index"), "p.image_dimensions", "p.text", "p.lines", checked.alias("words"))
    return pages.sortWithinPartitions("doc_id", "page_index")


def payload(text: Column, ddl: str, required: tuple[str, ...]) -> Column:
    """A JSON payload as a struct. Text that isn't JSON, and required keys that are missing, are errors; further keys are ignored."""
    parsed = F.from_json(text, ddl, {"mode": "FAILFAST"})
    out = parsed
    for key in required:
        out = F.when(parsed[key].isNull(), F.raise_error(F.lit(f"payload has no {key}")).cast(f"struct<{ddl_struct(ddl)}>")).otherwise(out)
    return out


def ddl_struct(ddl: str) -> str:
    """A table schema as the inside of a struct type."""
    import re

    return re.sub(r"(^|,\s*)(\w+)\s+", r"\1\2:", ddl)


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """Elements of region manifests, boxes as left, top, right, bottom."""
    m = spark.read.schema(schema.REGION_MANIFEST).option("multiLine", True).json(path)
    e = m.select(F.input_file_name().alias("doc_id"), "dpi", "page_width_px", "page_height_px", F.explode("elements").alias("e"))
    return e.select("doc_id", "dpi", "page_width_px", "page_height_px", "e.id", "e.type", *[F.col("e.box_px")[k].alias(n) for k, n in enumerate(("left", "top", "right", "bottom"))], "e.expected_unaccounted")


def write_pages(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Pages or audits as parquet or JSON lines."""
    df.write.mode("overwrite").format(fmt).save(path)

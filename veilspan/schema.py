"""Schemas of pages and of what is derived from them.

Offsets are half-open, from 0, in code points; boxes are x, y, w, h in pixels.
"""

from pyspark.sql import types as T

INTERVAL = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
BOX = T.StructType([T.StructField(n, T.IntegerType()) for n in ("x", "y", "w", "h")])
DIMENSIONS = T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())])
LINE = T.StructType([T.StructField("line_id", T.StringType()), T.StructField("text", T.StringType()), T.StructField("box", BOX)])
WORD = T.StructType([T.StructField("text", T.StringType()), T.StructField("box", BOX), T.StructField("conf", T.IntegerType()), T.StructField("line_id", T.StringType()), T.StructField("char_span", INTERVAL)])
PAGE = T.StructType([T.StructField("page_index", T.IntegerType()), T.StructField("image_dimensions", DIMENSIONS), T.StructField("text", T.StringType()), T.StructField("lines", T.ArrayType(LINE)), T.StructField("words", T.ArrayType(WORD))])
ENVELOPE = T.StructType([T.StructField("page_count", T.IntegerType()), T.StructField("pages", T.ArrayType(PAGE))])
RAW_WORD = T.StructType([T.StructField("page_index", T.IntegerType()), T.StructField("seq", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("conf", T.StringType()), *[T.StructField(n, T.IntegerType()) for n in ("left", "top", "width", "height", "block_num", "par_num", "line_num")]])
ENTITY = T.StructType([T.StructField("entity_type", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType()), T.StructField("text", T.StringType())])
SUBSTITUTION = T.StructType([T.StructField("span", INTERVAL), T.StructField("placeholder", T.StringType()), T.StructField("replacement", T.StringType()), T.StructField("entity_type", T.StringType()), T.StructField("value", T.StringType())])
MAPPED = T.StructType([T.StructField("placeholder", T.StringType()), T.StructField("value", T.StringType()), T.StructField("first_start", T.IntegerType())])
ACTION = T.StructType([T.StructField("action", T.StringType()), T.StructField("token", T.StringType()), T.StructField("count", T.IntegerType()), T.StructField("reason", T.StringType()), T.StructField("fixed", T.BooleanType())])
RESTORED = T.StructType([T.StructField("page_index", T.IntegerType()), T.StructField("restored_text", T.StringType()), T.StructField("missing_placeholders", T.ArrayType(T.StringType())), T.StructField("unresolved_tokens", T.ArrayType(T.StringType()))])
REGION_MANIFEST = T.StructType([T.StructField("dpi", T.IntegerType()), T.StructField("page_width_px", T.IntegerType()), T.StructField("page_height_px", T.IntegerType()), T.StructField("elements", T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("type", T.StringType()), T.StructField("box_px", T.ArrayType(T.IntegerType())), T.StructField("expected_unaccounted", T.BooleanType())])))])

"""Steps that need software from outside: page images, recognition, models, translation, binary documents.

Each is a function that the caller gives; without one, the step fails instead of making
something up. All run on Arrow batches, so that a model is loaded once for each worker.
What can be checked of a result without that software is checked here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _through(df: DataFrame, fn: Batches | None, schema: str, what: str) -> DataFrame:
    if fn is None:
        raise NotImplementedError(f"{what} needs a function of the caller's")
    return df.mapInArrow(fn, schema)


def _each_document(fn: Batches) -> Batches:
    """``fn`` for one document at a time: one that gives no page, or pages that aren't numbered from 0 on, is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one, n = batch.slice(k, 1), 0
                for out in fn(iter([one])):
                    if out.column("page_index").to_pylist() != list(range(n, n + out.num_rows)):
                        raise ValueError(f"pages of {one.column('path')[0]} are out of order")
                    n += out.num_rows
                    yield out
                if not n:
                    raise ValueError(f"{one.column('path')[0]} has no pages")

    return run


def rasterize(files: DataFrame, fn: Batches | None = None) -> DataFrame:
    """path and content of documents to a row for each page, in order from 0. A document without pages is an error."""
    return _through(files.select("path", "content"), fn and _each_document(fn), "path string, page_index int, image binary, width int, height int", "rasterizing")


def recognize(images: DataFrame, fn: Batches | None = None) -> DataFrame:
    """Page images to raw words."""
    schema = "path string, page_index int, seq int, text string, conf string, left int, top int, width int, height int, block_num int, par_num int, line_num int"
    return _through(images, fn, schema, "recognition")


def draw(images: DataFrame, boxes: DataFrame, page: list[str], fn: Batches | None = None) -> DataFrame:
    """Page images with the boxes of their words (left, top, right, bottom) to redacted images. A page without boxes is drawn too."""
    own = boxes.groupBy(*page).agg(F.sort_array(F.collect_list(F.struct("top", "left", "bottom", "right"))).alias("boxes"))
    both = images.join(own, page, "left")
    return _through(both, fn, f"{', '.join(f'{c} {dict(images.dtypes)[c]}' for c in page)}, image binary", "drawing")


def named_entities(pages: DataFrame, fn: Batches | None = None) -> DataFrame:
    """Pages to entities of a model, a row for each."""
    return _through(pages, fn, "doc_id string, page_index int, entity_type string, start int, end int, score double, text string", "a language model")


def translate(pages: DataFrame, fn: Batches | None = None) -> DataFrame:
    """Anonymized pages to translated Markdown."""
    return _through(pages, fn, "doc_id string, page_index int, text string", "translation")


def write_documents(elements: DataFrame, doc: list[str], fn: Batches | None = None) -> DataFrame:
    """Elements of documents, as ``markdown.elements`` has them, to binary documents: each comes as one row, its elements in order."""
    names = ["page_index", "block_idx", "item_idx", "style", "text", "cells", "break_before"]
    whole = elements.groupBy(*doc).agg(F.sort_array(F.collect_list(F.struct(*names))).alias("elements"))
    return _through(whole, fn, f"{', '.join(f'{c} {dict(elements.dtypes)[c]}' for c in doc)}, content binary", "writing documents")


def identity(text: str = "text") -> Batches:
    """A translator for tests that returns its input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches

    return run

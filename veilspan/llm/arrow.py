"""Views of Arrow text columns as numpy bytes, a bounded number of them at a time."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_libc = ctypes.CDLL(None)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a string column one after the other as UTF-8, and the n+1 places where they begin and end. Null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, ends, data = column.buffers()
    at = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in parts of at most ``most`` bytes of text, or of one row. At the end, freed memory goes back to the system: the worker lives on."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if not len(column):
            continue
        _, at = text_bytes(column)
        first = 0
        while first < len(column):
            last = max(first + 1, int(np.searchsorted(at, at[first] + most, side="right")) - 1)
            last = min(last, len(column))
            yield batch.slice(first, last - first)
            first = last
    batch = column = at = None
    release()


def spread(df: DataFrame) -> DataFrame:
    """A table whose files give fewer parts than there are cores, dealt out over all of them; a larger one as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2000) -> Iterator[None]:
    """Within it, Arrow batches of what is planned and run have at most so many rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def get(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))

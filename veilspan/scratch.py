"""Written tables that cut lineage.

They live in the folder that the session names in ``spark.checkpoint.dir``, which
driver and executors share, so a lost executor never takes one with it. Tables stay as
long as DataFrames may read them: until ``drop``, or the end of the ``scope`` that they
were written in.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def root(spark: SparkSession) -> str:
    """The shared folder; a local one only in local mode, where nothing is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is unset; name a folder that all machines share")
    return f"{tempfile.gettempdir()}/checkpoints"


def fresh(spark: SparkSession, name: str) -> str:
    """A path that no other run uses."""
    path = f"{root(spark)}/{name}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what was written in it: nothing may read those tables afterwards."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            remove(spark, path)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once as Parquet and read back."""
    spark = df.sparkSession
    path = fresh(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a path, if it is there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def drop(df: DataFrame) -> None:
    """Remove a table that ``written`` made, once nothing reads it any more."""
    for name in df.inputFiles()[:1]:
        remove(df.sparkSession, name.rsplit("/", 1)[0])

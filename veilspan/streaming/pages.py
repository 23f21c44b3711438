"""Streams of pages: the same column functions, documents that are emitted once complete, drafts that wait for approval.

What waits is in keyed state, an entry for each page or draft, so that one more page writes
its own entry and not its document's. Such state needs the RocksDB state store: set
``spark.sql.streaming.stateStore.providerClass`` to STORE. Without ``checkpointLocation`` of
the query's own it doesn't outlast the query.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from veilspan.operators import detect


STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _has_store(spark: SparkSession) -> None:
    if spark.conf.get(PROVIDER, "") != STORE:
        raise ValueError(f"set {PROVIDER} to {STORE}: keyed state needs it")


def anonymized(stream: DataFrame, recognizers: tuple = detect.DEFAULT) -> DataFrame:
    """Adds entities to a stream of pages: stateless, so that it runs on batches and streams alike."""
    return stream.withColumn("entities", detect.detect(F.col("text"), recognizers))


def paired(left: DataFrame, right: DataFrame, key: list[str], time: str, delay: str) -> DataFrame:
    """Pages of two streams joined by key, within ``delay`` of each other."""
    a = left.withWatermark(time, delay).alias("a")
    b = right.withWatermark(time, delay).alias("b")
    same: Column = F.expr(f"a.{time} BETWEEN b.{time} - INTERVAL {delay} AND b.{time} + INTERVAL {delay}")
    for k in key:
        same = same & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    return a.join(b, same)


class Assembly(StatefulProcessor):
    """Pages of a document by page_index, how many it has and how many are there."""

    def __init__(self, give_up_ms: int | None):
        self.give_up_ms = give_up_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pages = handle.getMapState("pages", "page_index int", "text string")
        self.size = handle.getValueState("size", "page_count int, held int")

    def taken(self, rows: Iterator[pd.DataFrame]) -> tuple[int, int]:
        """Put pages into the state; page_count and the number of different pages after them."""
        want, held = self.size.get() if self.size.exists() else (0, 0)
        for pdf in rows:
            want = max(want, int(pdf["page_count"].max()))
            for index, text in zip(pdf["page_index"].tolist(), pdf["text"].tolist(), strict=True):
                held += not self.pages.containsKey((index,))
                self.pages.updateValue((index,), (text,))
        self.size.update((want, held))
        return want, held

    def quiet(self) -> None:
        """No timers; without a time mode there are none, and none may be asked for."""
        if self.give_up_ms is not None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)

    def given(self, key: tuple, want: int, complete: bool) -> Iterator[pd.DataFrame]:
        texts = sorted((k[0], v[0]) for k, v in self.pages.iterator())
        self.pages.clear()
        self.size.clear()
        self.quiet()
        yield pd.DataFrame({"doc_id": [key[0]], "page_count": [want], "text": ["\f".join(t or "" for _, t in texts)], "complete": [complete]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        want, held = self.taken(rows)
        if held >= want:
            yield from self.given(key, want, True)
        elif self.give_up_ms is not None:
            self.quiet()
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.give_up_ms)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.size.exists():
            yield from self.given(key, self.size.get()[0], False)

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues) -> None:
        self.taken(iter([initialState]))

    def close(self) -> None:
        pass


def complete_documents(pages: DataFrame, give_up_ms: int | None = None, initial: DataFrame | None = None) -> DataFrame:
    """A document's text, once as many pages as page_count have come: doc_id, page_count, text (its pages in order, with form feeds between them), complete.

    A page that comes again replaces itself; of several page_counts the largest counts. An
    incomplete document waits for ever, unless the caller says for how long after its last page:
    then it comes out as it is, with complete false. What comes after a document was given out
    begins it anew. ``initial``: pages that are there before the stream begins; a document
    that they complete comes out with its next page.
    """
    _has_store(pages.sparkSession)
    columns = ["doc_id", "page_index", "page_count", "text"]
    before = initial.select(columns).groupBy("doc_id") if initial is not None else None
    mode = "None" if give_up_ms is None else "ProcessingTime"
    return pages.select(columns).groupBy("doc_id").transformWithStateInPandas(Assembly(give_up_ms), "doc_id string, page_count int, text string, complete boolean", "append", mode, before)


class Approval(StatefulProcessor):
    """Whether a document is approved, and its drafts until then."""

    def __init__(self, remember_ms: int | None):
        self.remember_ms = remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ok = handle.getValueState("ok", "approved boolean", self.remember_ms)
        self.held = handle.getListState("held", "draft string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ok, new = self.ok.exists(), []
        for pdf in rows:
            if pdf["draft"].isna().any():
                ok = True
                self.ok.update((True,))
            new += pdf["draft"].dropna().tolist()
        if not ok:
            if new:
                self.held.appendList([(d,) for d in new])
            return
        if self.held.exists():
            new = [d[0] for d in self.held.get()] + new
            self.held.clear()
        if new:
            yield pd.DataFrame({"draft": new})

    def close(self) -> None:
        pass


def approved(drafts: DataFrame, approvals: DataFrame, remember_ms: int | None = None) -> DataFrame:
    """Drafts of a stream whose document a stream of approvals (doc_id, approved) approves, before or after they come.

    A draft waits in the state until then, with no timeout and no default; what isn't an
    approval changes nothing. Once a document is approved, later drafts of it go on at once:
    for ever, or for as long after its last approval as the caller has approvals remembered.
    """
    _has_store(drafts.sparkSession)
    schema = drafts.schema
    waiting = drafts.select(F.col("doc_id").cast("string").alias("key"), F.to_json(F.struct(*drafts.columns), {"ignoreNullFields": "false"}).alias("draft"))
    said = approvals.where("approved").select(F.col("doc_id").cast("string").alias("key"), F.lit(None).cast("string").alias("draft"))
    mode = "None" if remember_ms is None else "ProcessingTime"
    out = waiting.union(said).groupBy("key").transformWithStateInPandas(Approval(remember_ms), "draft string", "append", mode)
    return out.select(F.from_json("draft", schema).alias("d")).select("d.*")

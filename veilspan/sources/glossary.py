"""A glossary that lasts: snapshots, a commit file for each version, and batches that count once.

``data/`` has the snapshots, Parquet folders of fold, term, translation, verified;
``commits/`` a file for each version, a JSON text that names its snapshot and, for each
writer, the last batch that is in it. A version is there once its commit file is: it is
created only if there is none of its number, so that of two writers one goes on from the
other's version. What a failed write leaves is a folder that no version names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from veilspan.operators.docs import glossary_upsert

SCHEMA = "fold string, term string, translation string, verified boolean"
#: Times that a writer begins anew when others commit before it.
TRIES = 20


class GlossaryStore:
    """The glossary in one folder of a store that Spark writes to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, name: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        place, fs = self._at("commits")
        return sorted(int(f.getPath().getName().removesuffix(".json")) for f in fs.listStatus(place) if f.getPath().getName().endswith(".json")) if fs.exists(place) else []

    def commit(self, version: int) -> dict:
        """snapshot and batches of a version; version 0 is empty."""
        if version == 0:
            return {"snapshot": None, "batches": {}}
        place, fs = self._at(f"commits/{version}.json")
        stream = fs.open(place)
        try:
            return json.loads(bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def latest(self) -> int:
        return max(self.versions(), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        """The glossary of a version, the latest one if none is named."""
        snapshot = self.commit(self.latest() if version is None else version)["snapshot"]
        if snapshot is None:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/data/{snapshot}")

    def _committed(self, version: int, said: dict) -> bool:
        """Whether this call has made the version: false if there is one of its number."""
        place, fs = self._at(f"commits/{version}.json")
        try:
            stream = fs.create(place, False)
        except Exception:
            if fs.exists(place):
                return False
            raise
        try:
            stream.write(json.dumps(said).encode())
        finally:
            stream.close()
        return True

    def _next(self, change: Callable[[DataFrame], DataFrame], batch: tuple[str, int] | None) -> int:
        for _ in range(TRIES):
            base = self.latest()
            now = self.commit(base)
            if batch and now["batches"].get(batch[0], -1) >= batch[1]:
                return base
            snapshot = uuid.uuid4().hex
            change(self.read(base)).write.parquet(f"{self.path}/data/{snapshot}")
            batches = now["batches"] | ({batch[0]: batch[1]} if batch else {})
            if self._committed(base + 1, {"snapshot": snapshot, "batches": batches}):
                return base + 1
            place, fs = self._at(f"data/{snapshot}")
            fs.delete(place, True)
        raise RuntimeError("other writers commit before this one each time")

    def upsert(self, candidates: DataFrame, writer: str = "", batch_id: int | None = None) -> int:
        """Candidates (term, translation) by the rules of ``docs.glossary_upsert``: verified rows stay as they are. A batch that is in the glossary already changes nothing. Returns the version that has it."""
        return self._next(lambda old: glossary_upsert(old, candidates.select("term", "translation")), None if batch_id is None else (writer, batch_id))

    def verify(self, verified: DataFrame) -> int:
        """A reviewer's terms (fold, translation): such rows get that translation and no upsert changes them from then on."""
        own = verified.selectExpr("fold AS f", "translation AS t").dropDuplicates(["f"])

        def change(old: DataFrame) -> DataFrame:
            both = old.join(own, old["fold"] == own["f"], "left")
            return both.selectExpr("fold", "term", "coalesce(t, translation) AS translation", "verified OR f IS NOT NULL AS verified")

        return self._next(change, None)

    def sink(self, writer: str) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: a batch that Spark runs again after a failure counts once."""

        def put(batch: DataFrame, batch_id: int) -> None:
            self.upsert(batch, writer, batch_id)

        return put

"""A data source of recognised pages: ``spark.read.format("paged_envelopes")``.

A folder of it has parts, a page on each line as JSON, and ``_manifest.json``, which lists the
parts that count, with their numbers of pages and the byte offsets of every ``STEP``-th one.
The reader plans its partitions by part and range of pages from the manifest alone, so that one
long document is read by many tasks; it checks each page against the schema, and an error names
the file and the line. The writer's tasks write parts of new names in a folder of the job's
own; the commit moves those that count, puts the manifest in place in one move, and removes
that folder, as a job that fails does.

Options: ``path``; ``pagesPerPartition`` for reading. Paths are what ``pyarrow.fs`` opens from
executors: shared folders, and stores that it knows by their URI.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from veilspan import schema as S

NAME, MANIFEST, STEP = "paged_envelopes", "_manifest.json", 100
SCHEMA = T.StructType([T.StructField("doc_id", T.StringType(), False), T.StructField("page_index", T.IntegerType(), False), *[f for f in S.PAGE.fields if f.name != "page_index"]])


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def manifest(path: str) -> dict:
    """parts: name, pages, offsets, bytes; an error names the folder that has none."""
    fs, base = _open(path)
    if fs.get_file_info(f"{base}/{MANIFEST}").type == pafs.FileType.NotFound:
        raise FileNotFoundError(f"no {MANIFEST} in {path}")
    with fs.open_input_stream(f"{base}/{MANIFEST}") as f:
        return json.loads(f.read())


@dataclass
class Range(InputPartition):
    """Pages of one part, from a line on."""

    part: str
    line: int
    pages: int
    begin: int
    end: int


@dataclass
class Written(WriterCommitMessage):
    name: str | None
    pages: int = 0
    bytes: int = 0
    offsets: list[int] = field(default_factory=list)


class PagedReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.path, self.per = schema, options["path"].rstrip("/"), int(options.get("pagesPerPartition", "1000"))

    def partitions(self) -> list[Range]:
        out = []
        for part in manifest(self.path)["parts"]:
            step = max(1, self.per // STEP)  # of the manifest's offsets
            marks = part["offsets"][::step] + [part["bytes"]]
            out += [Range(part["name"], k * step * STEP, min(step * STEP, part["pages"] - k * step * STEP), a, b) for k, (a, b) in enumerate(zip(marks, marks[1:], strict=False))]
        return out or [Range("", 0, 0, 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.part:
            return
        kinds = to_arrow_schema(self.schema)
        fs, base = _open(self.path)
        with fs.open_input_file(f"{base}/{partition.part}") as f:
            f.seek(partition.begin)
            lines = f.read(partition.end - partition.begin).splitlines()
        where = f"{self.path}/{partition.part}"
        if len(lines) != partition.pages:
            raise ValueError(f"{where}: {len(lines)} pages from line {partition.line + 1} on, the manifest has {partition.pages}")
        for lo in range(0, len(lines), STEP):
            yield pa.RecordBatch.from_pylist([checked(x, f"{where}, line {partition.line + lo + k + 1}", kinds) for k, x in enumerate(lines[lo : lo + STEP])], schema=kinds)


def checked(line: bytes, where: str, kinds: pa.Schema) -> dict:
    """A page whose fields are of the schema's types; further fields are left out. What isn't one is an error that says where it is."""
    try:
        page = json.loads(line)
        if not isinstance(page, dict):
            raise ValueError("no JSON object")
        missing = [f.name for f in kinds if not f.nullable and page.get(f.name) is None]
        if missing:
            raise ValueError(f"no {', '.join(missing)}")
        return pa.RecordBatch.from_pylist([page], schema=kinds).to_pylist()[0]
    except (ValueError, TypeError, pa.ArrowException) as bad:
        raise ValueError(f"{where}: {bad}") from bad


class PagedWriter(DataSourceWriter):
    def __init__(self, schema: T.StructType, options: dict, overwrite: bool):
        names = [f.name for f in SCHEMA.fields]
        unknown = [f.name for f in schema.fields if f.name not in names or f.dataType.simpleString() != SCHEMA[f.name].dataType.simpleString()]
        lacking = [f.name for f in SCHEMA.fields if not f.nullable and f.name not in schema.fieldNames()]
        if unknown or lacking:
            raise ValueError(f"columns that pages don't have: {unknown}; that they must have: {lacking}")
        self.path, self.overwrite, self.job = options["path"].rstrip("/"), overwrite, f"_job-{uuid.uuid4().hex}"
        # here and not in tasks: what still runs when the job is given up can't make it again
        fs, base = _open(self.path)
        fs.create_dir(f"{base}/{self.job}", recursive=True)

    def write(self, iterator: Iterator[Row]) -> Written:
        fs, base = _open(self.path)
        said = Written(f"part-{uuid.uuid4().hex}.jsonl")
        with fs.open_output_stream(f"{base}/{self.job}/{said.name}") as f:
            for row in iterator:
                page = row.asDict(recursive=True)
                if page["doc_id"] is None or page["page_index"] is None:
                    raise ValueError("a page without doc_id or page_index")
                if said.pages % STEP == 0:
                    said.offsets.append(said.bytes)
                said.bytes += f.write(json.dumps(page, ensure_ascii=False).encode() + b"\n")
                said.pages += 1
        return said if said.pages else Written(None)

    def commit(self, messages: list[Written | None]) -> None:
        fs, base = _open(self.path)
        fs.create_dir(base, recursive=True)
        has = fs.get_file_info(f"{base}/{MANIFEST}").type != pafs.FileType.NotFound
        old = manifest(self.path)["parts"] if has else []
        new = [{"name": m.name, "pages": m.pages, "bytes": m.bytes, "offsets": m.offsets} for m in messages if m and m.name]
        for part in new:
            fs.move(f"{base}/{self.job}/{part['name']}", f"{base}/{part['name']}")
        beside = f"{base}/{MANIFEST}.{uuid.uuid4().hex}"
        with fs.open_output_stream(beside) as f:
            f.write(json.dumps({"parts": new if self.overwrite else old + new}).encode())
        fs.move(beside, f"{base}/{MANIFEST}")
        for part in old if self.overwrite else []:
            fs.delete_file(f"{base}/{part['name']}")
        self.cleared()

    def abort(self, messages: list[Written | None]) -> None:
        self.cleared()

    def cleared(self) -> None:
        """Without the job's folder."""
        fs, base = _open(self.path)
        if fs.get_file_info(f"{base}/{self.job}").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{base}/{self.job}")


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> PagedReader:
        return PagedReader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> PagedWriter:
        return PagedWriter(schema, self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the source known to a session by its name."""
    spark.dataSource.register(PagedSource)

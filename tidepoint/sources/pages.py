"""Saved query pages as a data source: ``spark.read.format("saved_pages")``.

A page is one query response with the range of its times. A write task appends its pages to one
file and lists them, with place and range, in an index next to it; a numbered commit names the
files of a write and the ranges within them, so a write that dies is never seen. With the
options ``start_ns`` and ``end_ns`` files outside the range make no task, and of the others only
the pages that share time with it are read. Read as a stream, each commit is new data.

The range is given by options and not by ``pushFilters``: Spark 4.1 keeps what a filter has left
with the loaded table, so a second filter on the same DataFrame would read the first one's pages.

The driver gets a row per file, the index of a file stays with the task that reads it. Paths
are local, or URIs that pyarrow's file systems know. One writer at a time.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

FORMAT = "saved_pages"
SCHEMA = "response string, first_ns bigint, last_ns bigint"
RANGE_COLUMNS = ("first_ns", "last_ns")
TASK_BYTES = 128 << 20
BATCH_BYTES = 8 << 20

@dataclass
class Written(WriterCommitMessage):
    """A file of pages: its name, size, and the least and greatest of each range column."""

    file: dict | None


def _folder(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub("^file:/+", "/", path).rstrip("/")
    if "://" in path:
        files, root = pafs.FileSystem.from_uri(path)
        return files, root.rstrip("/")
    return pafs.LocalFileSystem(), path.rstrip("/")


class _Pages:
    """Commits and files below a path; pages are read within the range of the options."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.start, self.end = (
            int(options[c]) if c in options else None for c in ("start_ns", "end_ns")
        )

    def commits(self) -> list[int]:
        files, root = _folder(self.path)
        listed = files.get_file_info(
            pafs.FileSelector(f"{root}/commits", allow_not_found=True)
        )
        names = [f.base_name for f in listed]
        return sorted(int(n.removesuffix(".json")) for n in names if re.fullmatch(r"\d+\.json", n))

    def files_of(self, commit: int) -> list[dict]:
        files, root = _folder(self.path)
        with files.open_input_stream(f"{root}/commits/{commit}.json") as stream:
            return json.loads(stream.read())

    def commit(self, written: list[dict]) -> None:
        files, root = _folder(self.path)
        files.create_dir(f"{root}/commits", recursive=True)
        number = max(self.commits(), default=0) + 1
        temporary = f"{root}/commits/{uuid.uuid4().hex}.tmp"
        with files.open_output_stream(temporary) as stream:
            stream.write(json.dumps(written).encode())
        files.move(temporary, f"{root}/commits/{number}.json")

    def parts(self, commits: list[int]) -> list[InputPartition]:
        """Tasks of bounded size over the files that may hold a page in the range."""
        found = []
        for commit in commits:
            for file in self.files_of(commit):
                if self._may_hold(file):
                    n = max(1, -(-file["bytes"] // TASK_BYTES))
                    found += [InputPartition((file["name"], k, n)) for k in range(n)]
        return found

    def _may_hold(self, file: dict) -> bool:
        first, last = file["first_ns"][0], file["last_ns"][1]
        after = self.start is None or (last is not None and last >= self.start)
        return after and (self.end is None or (first is not None and first < self.end))

    def read(self, part: tuple) -> Iterator[pa.RecordBatch]:
        name, k, n = part
        files, root = _folder(self.path)
        with files.open_input_file(f"{root}/data/{name}.index") as source:
            index = pq.read_table(source)
        a, b = (len(index) * i // n for i in (k, k + 1))
        index = index.slice(a, b - a)
        if self.start is not None:
            index = index.filter(pc.greater_equal(index.column("last_ns"), self.start))
        if self.end is not None:
            index = index.filter(pc.less(index.column("first_ns"), self.end))
        with files.open_input_file(f"{root}/data/{name}.pages") as source:
            texts, taken, begin = [], 0, 0
            for at, (offset, length) in enumerate(
                zip(index.column("offset").to_pylist(), index.column("length").to_pylist()), 1
            ):
                texts.append(None if length is None else source.read_at(length, offset))
                taken += length or 0
                if taken >= BATCH_BYTES or at == len(index):
                    ranges = index.slice(begin, at - begin).combine_chunks()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(texts, pa.binary()).cast(pa.string()),
                            *[
                                pa.array(ranges.column(c).to_pylist(), pa.int64())
                                for c in RANGE_COLUMNS
                            ],
                        ],
                        ["response", *RANGE_COLUMNS],
                    )
                    texts, taken, begin = [], 0, at


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = _folder(self.path)
        name, rows, offset = uuid.uuid4().hex, [], 0
        files.create_dir(f"{root}/data", recursive=True)
        with files.open_output_stream(f"{root}/data/{name}.pages") as stream:
            for batch in iterator:
                texts = batch.column("response").cast(pa.binary())
                ranges = [batch.column(c).to_pylist() for c in RANGE_COLUMNS]
                for text, first, last in zip(texts, *ranges):
                    body = text.as_py()
                    length = None if body is None else len(body)
                    stream.write(body or b"")
                    rows.append((offset, length, first, last))
                    offset += length or 0
        kinds = pa.schema([(c, pa.int64()) for c in ("offset", "length", *RANGE_COLUMNS)])
        columns = list(zip(*rows)) or [()] * 4
        index = pa.table([pa.array(c, pa.int64()) for c in columns], schema=kinds)
        with files.open_output_stream(f"{root}/data/{name}.index") as stream:
            pq.write_table(index, stream)
        ends = {c: list(pc.min_max(index.column(c)).as_py().values()) for c in RANGE_COLUMNS}
        return Written({"name": name, "bytes": offset, **ends} if rows else None)

    def commit(self, messages: list) -> None:
        written = [m.file for m in messages if m is not None and m.file]
        if written:
            _Pages({"path": self.path}).commit(written)

    def abort(self, messages: list) -> None:
        files, root = _folder(self.path)
        for message in messages:
            if message is not None and message.file:
                for kind in ("pages", "index"):
                    files.delete_file(f"{root}/data/{message.file['name']}.{kind}")


class _Reader(DataSourceReader):
    def __init__(self, pages: _Pages):
        self.pages = pages

    def partitions(self) -> list[InputPartition]:
        return self.pages.parts(self.pages.commits())

    def read(self, partition: InputPartition | None) -> Iterator[pa.RecordBatch]:
        # Without any file in the range there is one task without a part.
        return iter(()) if partition is None else self.pages.read(partition.value)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, pages: _Pages):
        self.pages = pages

    def initialOffset(self) -> dict:
        return {"commit": 0}

    def latestOffset(self) -> dict:
        return {"commit": max(self.pages.commits(), default=0)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        commits = self.pages.commits()
        return self.pages.parts([c for c in commits if start["commit"] < c <= end["commit"]])

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.pages.read(partition.value)


class SavedPages(DataSource):
    """Pages below the path given to ``load`` or ``save``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(_Pages(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("pages are only appended")
        return _Writer(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(_Pages(self.options))


def use_pages(spark: SparkSession) -> SparkSession:
    """Make ``saved_pages`` known to the session."""
    # Workers get the classes themselves and need not be able to import this library.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(SavedPages)
    return spark


def save_pages(pages: DataFrame, path: str) -> None:
    """Append ``response, first_ns, last_ns``: pages with the range of their times."""
    use_pages(pages.sparkSession)
    kinds = [f"cast({c} as {t}) as {c}" for c, t in (x.split() for x in SCHEMA.split(", "))]
    pages.selectExpr(*kinds).write.format(FORMAT).mode("append").save(path)


def read_pages(
    spark: SparkSession, path: str, start_ns: int | None = None, end_ns: int | None = None
) -> DataFrame:
    """Pages that share time with the half-open range; without a bound, also those without times."""
    reader = use_pages(spark).read.format(FORMAT)
    for name, bound in (("start_ns", start_ns), ("end_ns", end_ns)):
        reader = reader if bound is None else reader.option(name, bound)
    return reader.load(path)


def stream_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages as a stream that begins with the first commit."""
    return use_pages(spark).readStream.format(FORMAT).load(path)

"""A small table of which every version of a row is appended, and the last one counts."""

from __future__ import annotations

import threading
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepoint.operators.upsert import last_wins
from tidepoint.sinks.files import SharedFiles

COMPACT_FILES = 500


class LogTable:
    """Rows by key in an append-only Parquet log; ``seq`` orders the versions of a row.

    A save is one small file, so its cost does not grow with the table. After
    ``COMPACT_FILES`` files the last versions are written as a new generation, which readers
    follow once its marker is there; a run that dies before it leaves the old one in place.
    One process writes; its threads may share the table.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.schema = spark.createDataFrame([], schema).schema
        self._files = SharedFiles(spark)
        self._lock = threading.RLock()
        self._seq = self._appended = 0

    def _generations(self) -> list[int]:
        return [int(n) for n in self._files.names(f"{self.path}/generation")]

    def _folder(self) -> str:
        return f"{self.path}/log={max(self._generations(), default=0)}"

    def _next(self) -> int:
        """A number above all given before, also by a process that wrote earlier."""
        self._seq = max(self._seq + 1, time.time_ns())
        return self._seq

    def current(self, where: Column | None = None) -> DataFrame:
        """The last version of every row; ``where`` may test keys, before versions are told."""
        folder = self._folder()
        if not self._files.names(folder):
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(folder)
        return last_wins(rows if where is None else rows.where(where), self.keys, ["seq"])

    def append(self, rows: DataFrame) -> None:
        """Add versions. Columns that ``rows`` lacks are null."""
        with self._lock:
            seq, have = self._next(), set(rows.columns)
            columns = [
                (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in self.schema
                if f.name != "seq"
            ]
            typed = rows.select(*columns, F.lit(seq).cast("bigint").alias("seq"))
            typed.select(*self.schema.names).coalesce(1).write.mode("append").parquet(
                self._folder()
            )
            self._appended += 1
            if self._appended >= COMPACT_FILES:
                self._compact()

    def append_values(self, rows: Sequence[dict]) -> None:
        values = [tuple(row.get(name) for name in self.schema.names) for row in rows]
        self.append(self.spark.createDataFrame(values, self.schema))

    def _compact(self) -> None:
        old, number = self._folder(), max(self._generations(), default=0) + 1
        fresh = f"{self.path}/log={number}"
        self.current().coalesce(1).write.mode("overwrite").parquet(fresh)
        self._files.create(f"{self.path}/generation/{number}", "")
        self._files.remove(old)
        self._appended = 0

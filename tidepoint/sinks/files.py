"""Small metadata files in the shared file system, through Hadoop's client."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class SharedFiles:
    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _open(self, path: str):
        target = self._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._conf), target

    def names(self, folder: str) -> list[str]:
        fs, path = self._open(folder)
        if not fs.exists(path):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(path))

    def read(self, path: str) -> str:
        fs, target = self._open(path)
        stream = fs.open(target)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """Write a new file so that readers see all of it or nothing."""
        fs, target = self._open(path)
        if fs.exists(target):
            raise FileExistsError(path)
        _, draft = self._open(f"{path}.{uuid.uuid4().hex}.tmp")
        stream = fs.create(draft, False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        if not fs.rename(draft, target):
            raise FileExistsError(path)

    def remove(self, path: str) -> None:
        fs, target = self._open(path)
        fs.delete(target, True)

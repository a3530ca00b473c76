"""Manifests as a log of versions, for readers and writers that don't know of each other.

A version's rows are Parquet in a folder of their own; it counts once its entry is there, a small file named by its number that is created only if it is absent. Readers take the last entry and see all of its rows or none; a writer names the version it began from, and if another writer was faster its entry is taken: ConcurrentWrite, and nothing has changed. Rows of a write that failed are in no entry. All goes through the file system of the folder's path, on the driver only for entries.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class ConcurrentWrite(Exception):
    """Another writer committed the version that this one was to be."""


class Versions:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def _numbers(self) -> list[int]:
        log = self._path("log")
        return sorted(int(s.getPath().getName()) for s in self._fs.listStatus(log)) if self._fs.exists(log) else []

    def _entry(self, number: int) -> dict | None:
        """An entry; null if its writer was lost while it wrote."""
        stream = self._fs.open(self._path(f"log/{number:012d}"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except ValueError:
            return None
        finally:
            stream.close()

    def latest(self) -> int:
        """Number of the last version, 0 if there is none."""
        return next((n for n in reversed(self._numbers()) if self._entry(n)), 0)

    def read(self, number: int | None = None) -> DataFrame | None:
        """The rows of a version (default: the last one); null if there is none."""
        number = self.latest() if number is None else number
        if number == 0:
            return None
        entry = self._entry(number)
        if entry is None:
            raise ValueError(f"{self.folder} has no version {number}")
        from pyspark.sql.types import StructType

        return self.spark.read.schema(StructType.fromJson(entry["schema"])).parquet(f"{self.folder}/{entry['rows']}")

    def commit(self, df: DataFrame, base: int | None = None) -> int:
        """Write df as the version after base (default: the last one) and give its number."""
        base = self.latest() if base is None else base
        rows = f"rows/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder}/{rows}")
        try:
            later = [n for n in self._numbers() if n > base]
            if any(self._entry(n) for n in later):
                raise ConcurrentWrite(f"{self.folder}: version {base} is not the last")
            number = max([base, *later]) + 1
            self._fs.mkdirs(self._path("log"))
            try:
                stream = self._fs.create(self._path(f"log/{number:012d}"), False)
            except Py4JJavaError as e:
                raise ConcurrentWrite(f"{self.folder}: version {number} is taken") from e
            stream.write(bytearray(json.dumps({"rows": rows, "base": base, "schema": df.schema.jsonValue()}).encode()))
            stream.close()
        except ConcurrentWrite:
            self._fs.delete(self._path(rows), True)
            raise
        return number

    def clean(self, keep: int = 1) -> None:
        """Remove all versions but the last few, and rows that no entry names. Not while others write."""
        numbers = self._numbers()
        kept, gone = numbers[-keep:] if keep else [], numbers[:-keep] if keep else numbers
        named = {e["rows"].rsplit("/", 1)[1] for n in kept if (e := self._entry(n))}
        for n in gone:
            self._fs.delete(self._path(f"log/{n:012d}"), False)
        if self._fs.exists(self._path("rows")):
            for s in self._fs.listStatus(self._path("rows")):
                if s.getPath().getName() not in named:
                    self._fs.delete(s.getPath(), True)

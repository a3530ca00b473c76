"""Files that tasks write: sidecars of samples and the removal of what belongs to none, through the file system of the target.

Each task writes its samples' files into a folder aside, one per attempt of a task, and returns a row a file: name, length, digest and where it lies. Only rows of tasks that ended are seen, so what a lost or repeated attempt wrote is in no row and goes with the folder. The commit moves the files that have rows to their places, each replacing what is there, and is safe to repeat: a file that is in its place already is passed over. Renames run in tasks, too; nothing but counts comes to the driver.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WRITTEN = "name string, length long, digest string, aside string"


def _at(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def written(df: DataFrame, folder: str) -> DataFrame:
    """A row (WRITTEN) for each file of df (name, content: text or bytes), written into a folder aside of folder. Rows with a null content are empty files. Write the result before anything branches: see committed()."""
    aside = f"{folder.rstrip('/')}/.aside-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        own = f"{aside}/{context.partitionId()}-{context.taskAttemptId()}"
        fs, place = _at(own)
        fs.create_dir(place, recursive=True)
        for batch in batches:
            out = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with fs.open_output_stream(f"{place}/{name}") as f:
                    f.write(content or b"")
                out.append((name, len(content or b""), hashlib.sha256(content or b"").hexdigest(), f"{own}/{name}"))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 4, (pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["name", "length", "digest", "aside"])

    return df.select(F.col("name").cast("string").alias("name"), F.col("content").cast("binary").alias("content")).mapInArrow(run, WRITTEN)


def committed(files: DataFrame, folder: str) -> DataFrame:
    """name, state of each file of files (written(), itself written as a table; unique by name): moved to its place in folder, or there (an earlier commit moved it). A file that is in neither place is an error."""
    target = folder.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, place = _at(target)
        for batch in batches:
            states = []
            for name, length, aside in zip(*(batch.column(c).to_pylist() for c in (0, 1, 3)), strict=True):
                _, source = _at(aside)
                if fs.get_file_info(source).type == pafs.FileType.File:
                    fs.move(source, f"{place}/{name}")
                    states.append("moved")
                elif fs.get_file_info(f"{place}/{name}").type == pafs.FileType.File and fs.get_file_info(f"{place}/{name}").size == length:
                    states.append("there")
                else:
                    raise FileNotFoundError(f"{name} is neither aside nor in its place")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(states, pa.string())], names=["name", "state"])

    return files.select("name", "length", "digest", "aside").mapInArrow(run, "name string, state string")


def finished(files: DataFrame, folder: str) -> None:
    """Remove the folders aside of files, with what attempts that were lost left there."""
    for r in files.select(F.regexp_extract("aside", r"^(.*/\.aside-[0-9a-f]+)/", 1).alias("a")).distinct().collect():  # one a write
        fs, place = _at(r["a"])
        if fs.get_file_info(place).type == pafs.FileType.Directory:
            fs.delete_dir(place)


def orphaned(listing: DataFrame, wanted: DataFrame, folder: str, remove: bool = True) -> DataFrame:
    """name of each file of listing (name) whose stem, up to the first dot, is not among wanted (stem); with remove they are deleted where they lie in folder, by tasks. Deleting again does nothing."""
    gone = listing.select("name", F.substring_index("name", ".", 1).alias("stem")).join(wanted.select("stem"), "stem", "left_anti").select("name")
    if not remove:
        return gone
    target = folder.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, place = _at(target)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                if fs.get_file_info(os.path.join(place, name)).type == pafs.FileType.File:
                    fs.delete_file(os.path.join(place, name))
            yield batch

    return gone.mapInArrow(run, "name string")

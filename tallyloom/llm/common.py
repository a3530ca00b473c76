"""Helpers that the corpus operators share."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import shared_dir

#: White space as the contracts define it: code points 0x20 and 0x09 to 0x0D.
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Spark's setting under which an execution's shuffle files go when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_scratch: list[list[str]] = []


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that stored() writes inside are deleted at the end, but for those that are written to be kept: what goes on must be among these."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            _delete(spark, path)


def stored(df: DataFrame, name: str, keep: bool = False, **options: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage ends there, lost executors cost nothing, and branches read it once each. What the write shuffled is deleted when it ends, since nothing can ask for it again. keep: the table outlives the scratch() around it (but not one further out)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if len(_scratch) > keep:
        _scratch[-1 - keep].append(path)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


#: Rows of keys that are broadcast to find rows where they lie, at most, and of single numbers; beyond it both sides are shuffled.
FEW_KEYS, FEW_NUMBERS = 1_000_000, 4_000_000


def sized(keys: DataFrame, most: int = FEW_KEYS) -> DataFrame:
    """keys (narrow rows, cheap to count), to be broadcast if they are few enough, else as they are."""
    return F.broadcast(keys) if keys.count() <= most else keys


def among(rows: DataFrame, keys: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    """The rows whose columns on (nulls are equal) are among keys, or with how="left_anti" the others. Rows stay where they are while the keys are few enough to be broadcast."""
    keys = keys.select(*(F.col(c).alias(f"_{i}_key") for i, c in enumerate(on)))
    same = [F.col(c).eqNullSafe(F.col(f"_{i}_key")) for i, c in enumerate(on)]
    both = same[0]
    for c in same[1:]:
        both = both & c
    return rows.join(sized(keys), both, how)


#: Bytes of a batch that a Python worker works on at once.
SLICE = 8 << 20


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about size bytes or one row; what the worker no longer uses goes back to the machine at the end, since workers live on for other stages."""
    for batch in batches:
        few = max(1, batch.num_rows * size // max(size, batch.nbytes))
        for at in range(0, batch.num_rows, few):
            yield batch.slice(at, few)
    del batches
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def give_back() -> None:
    """What this process no longer uses goes back to the machine."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once a row: a one-element explode, over which the optimiser doesn't merge projections."""
    one = F.explode(F.array(F.struct(*(c.alias(k) for k, c in columns.items())))).alias("_once")
    return df.select(*(df[c] for c in df.columns if c not in columns), one).select(*(c for c in df.columns if c not in columns), "_once.*")

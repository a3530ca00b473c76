"""Identity and grouping keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_id(record_key: Column) -> Column:
    """A file-safe id: each : becomes __, each run of characters outside [A-Za-z0-9_-] one _. An empty key is an error."""
    safe = F.regexp_replace(F.replace(record_key, F.lit(":"), F.lit("__")), "[^A-Za-z0-9_-]+", "_")
    return F.when(safe == "", F.raise_error(F.lit("empty record key"))).otherwise(safe)


def hash_bucket(key: Column, n: int) -> Column:
    """The key's SHA-256, read as one whole number, modulo n: stable over runs, machines and engines."""
    digits = F.sequence(F.lit(1), F.lit(64))
    digest = F.sha2(key, 256)
    return F.aggregate(digits, F.lit(0).cast("bigint"), lambda a, i: F.pmod(a * 16 + F.conv(F.substring(digest, i, F.lit(1)), 16, 10).cast("bigint"), F.lit(n).cast("bigint")))


def chunk_id(sample: Column, index: Column) -> Column:
    return F.format_string("%s__chunk%03d", sample, index)


def stem(path: Column) -> Column:
    """File name up to the first dot."""
    return F.substring_index(F.element_at(F.split(path, "/"), -1), ".", 1)


def name_without_suffix(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has, with their number of rows: empty if the keys are unique."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")

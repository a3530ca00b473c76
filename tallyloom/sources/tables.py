"""Sources: manifests as CSV and JSON lines, folders of JSON documents, part states, settings files, file listings."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import keys


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path or glob matches anything in its file system."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV file with a header; all values are strings; a byte order mark is no part of the first name."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A manifest of JSON lines; no file is an empty manifest; a bad line is an error."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_part_states(spark: SparkSession, glob: str, schema: str, key: str, status: str, done: str = "complete") -> DataFrame:
    """Union of part files: of each key the last finished row, in the order of file names and lines. Rows that aren't finished hide none."""
    if not exists(spark, glob):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).json(glob).select("*", F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_line"))
    order = Window.partitionBy(key).orderBy(F.col("_file").desc(), F.col("_line").desc())
    return rows.where(F.col(status) == done).withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n", "_file", "_line")


def read_documents(spark: SparkSession, folder: str, schema: str, status: str = "analysis_status") -> DataFrame:
    """One row a JSON document of the folder: stem, the parsed fields; a document that is no JSON has status invalid_json and no fields."""
    if not exists(spark, f"{folder}/*.json"):
        return spark.createDataFrame([], f"stem string, {schema}")
    text = spark.read.option("wholetext", True).text(f"{folder}/*.json").select("value", F.col("_metadata.file_name").alias("file"))
    return parsed_documents(text.select(F.regexp_replace("file", r"\.json$", "").alias("stem"), "value"), "value", schema, status)


def parsed_documents(rows: DataFrame, column: str, schema: str, status: str) -> DataFrame:
    """rows with the fields of the JSON text in the column in its place; text that is no JSON has status invalid_json and no fields."""
    others = [c for c in rows.columns if c != column]
    parsed = rows.select(*others, F.from_json(column, f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}).alias("_p"))
    fields = [f.name for f in T.StructType.fromDDL(schema)]
    bad = F.col("_p").isNull() | F.col("_p._corrupt").isNotNull()
    return parsed.select(*others, *((F.when(bad, "invalid_json").otherwise(F.col(f"_p.{c}")) if c == status else F.when(~bad, F.col(f"_p.{c}"))).alias(c) for c in fields))


def settings_of(lines: Column) -> Column:
    """struct(key, value) of each KEY=VALUE line of an array; blanks, comments and lines without = are passed over."""
    bare = F.filter(F.transform(lines, lambda v: F.trim(v)), lambda v: ~v.startswith("#") & F.contains(v, F.lit("=")))
    return F.transform(bare, lambda v: F.struct(F.trim(F.substring_index(v, "=", 1)).alias("key"), F.trim(F.substring(v, F.locate("=", v) + 1, F.length(v))).alias("value")))


def read_settings(path: str, into: dict[str, str] | None = None) -> dict[str, str]:
    """KEY=VALUE lines; blanks, comments and lines without = are passed over; keys that are set stay; no file sets nothing."""
    out = {} if into is None else into
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in map(str.strip, f):
                if line and not line.startswith("#") and "=" in line:
                    key, value = line.split("=", 1)
                    out.setdefault(key.strip(), value.strip())
    return out


def read_config(path: str) -> Mapping:
    """A JSON document of settings."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def listing(spark: SparkSession, glob: str) -> DataFrame:
    """path, name, length of the files that match."""
    if not exists(spark, glob):
        return spark.createDataFrame([], "path string, name string, length long")
    return spark.read.format("binaryFile").load(glob).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def expected_stems(index: DataFrame) -> DataFrame:
    """Stems of the file names in a dataset index (samples: array of struct filename, ...)."""
    return index.select(F.explode("samples.filename").alias("f")).select(keys.name_without_suffix(F.col("f")).alias("stem")).distinct()

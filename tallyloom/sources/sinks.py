"""Sinks: atomic JSON lines, documents and CSV for the edge, versioned Parquet inside, links, indexes, reports."""

from __future__ import annotations

import json
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def replaced(path: str, text: str) -> None:
    """Write a file beside its place and move it there; readers see the old or the new one, and no rest stays after an error."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=os.path.dirname(path) or ".")
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            f.write(text)
        os.replace(temporary, path)
    except BaseException:
        if os.path.exists(temporary):
            os.unlink(temporary)
        raise


def write_manifest(df: DataFrame, folder: str) -> str:
    """A new version of a manifest as Parquet under folder; the committed path is returned and earlier versions stay readable."""
    path = f"{folder.rstrip('/')}/v-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def _sorted_keys(value: Column, kind: T.DataType) -> Column:
    """The value with the fields of all structs in it in the order of their names."""
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return F.when(value.isNotNull(), F.struct(*(_sorted_keys(value[f.name], f.dataType).alias(f.name) for f in fields)))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: _sorted_keys(v, kind.elementType))
    return value


def json_lines(df: DataFrame) -> DataFrame:
    """One column value: each row as JSON with sorted keys at every depth, nulls included."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    return df.select(F.to_json(F.struct(*(_sorted_keys(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields)), {"ignoreNullFields": "false"}).alias("value"))


def replaced_folder(df: DataFrame, path: str, form: str, **options: object) -> None:
    """Write df beside path and move it there: a job that fails leaves what was there, and readers see a whole folder. The old folder goes last."""
    spark, aside = df.sparkSession, f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.write.format(form).options(**options).save(f"{aside}.new")
    jvm = spark.sparkContext._jvm
    new, old, place = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{aside}.new", f"{aside}.old", path))
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had = fs.exists(place) and fs.rename(place, old)
    if not fs.rename(new, place):
        if had:
            fs.rename(old, place)
        raise OSError(f"{path} could not be replaced")
    if had:
        fs.delete(old, True)


def write_jsonl(df: DataFrame, path: str, *order: str) -> None:
    """Rows in order as JSON lines in part files of path, which is replaced as a whole."""
    replaced_folder(json_lines(df.orderBy(*order) if order else df), path, "text")


def write_json(path: str, value: object) -> None:
    replaced(path, json.dumps(value, ensure_ascii=False, indent=2) + "\n")


def csv_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as text, missing values as empty strings."""
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns))


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """The columns, missing values as empty strings, as CSV with a header."""
    replaced_folder(csv_rows(df, columns), path, "csv", header=True, emptyValue="")


def dataset_index(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """One row a group `part`: its samples as one nested array in order of key, as JSON. A part is a training shard of bounded size."""
    sample = F.struct(key, *fields)
    return df.groupBy("part").agg(F.array_sort(F.collect_list(sample)).alias("samples")).select("part", F.size("samples").alias("n_samples"), F.to_json(F.struct("samples")).alias("document"))


def sidecars(df: DataFrame, caption: str = "caption", variants: str = "caption_variants") -> DataFrame:
    """sample_id, document: caption, its variants in fixed order and optional fields with their own types; missing or empty optional fields are left out."""
    order = ("full", "composition", "production", "tags")
    by_kind = F.map_from_entries(F.transform(variants, lambda v: F.struct(v["type"], v["text"])))
    kinds = {f.name: f.dataType for f in df.schema}
    own = lambda c: F.nullif(F.col(c), F.lit("")) if isinstance(kinds[c], T.StringType) else F.col(c)
    optional = [own(c).alias(c) for c in ("language", "master_annotation", "bpm", "keyscale", "timesignature") if c in df.columns]
    return df.select("sample_id", F.to_json(F.struct(F.col(caption).alias("caption"), F.array(*(F.try_element_at(by_kind, F.lit(k)) for k in order)).alias("caption_variants"), *optional)).alias("document"))


def hard_link(source: str, target: str) -> str:
    """Link a file under another name, replacing what is there; a copy on the same disk costs nothing."""
    os.makedirs(os.path.dirname(target), exist_ok=True)
    if os.path.lexists(target):
        os.unlink(target)
    os.link(source, target)
    return target


def symlink(source: str, target: str) -> str:
    """Point target at source; a link to another file is replaced, anything else that is there stays."""
    os.makedirs(os.path.dirname(target), exist_ok=True)
    if os.path.islink(target) and os.path.realpath(target) != os.path.realpath(source):
        os.unlink(target)
    if not os.path.lexists(target):
        os.symlink(source, target)
    return target


def linked_set(sources: dict[str, str], folder: str) -> list[str]:
    """Make folder hold links of the given names to the given files and no others; returns the names of links that went. Files that are no links stay."""
    for name, source in sources.items():
        symlink(source, os.path.join(folder, name))
    gone = sorted(n for n in os.listdir(folder) if n not in sources and os.path.islink(os.path.join(folder, n))) if os.path.isdir(folder) else []
    for name in gone:
        os.unlink(os.path.join(folder, name))
    return gone


#: Endings of a sample's files.
TRIPLET = (".flac", ".json", ".lyrics.txt")


def write_sidecars(rows: list[dict], folder: str) -> list[str]:
    """<sample_id>.json and <sample_id>.lyrics.txt of each row (sample_id, document, lyrics); returns the paths. rows: a part's, of a bounded size."""
    out = []
    for row in rows:
        for ending, text in ((".json", row["document"] + "\n"), (".lyrics.txt", row["lyrics"])):
            replaced(path := os.path.join(folder, row["sample_id"] + ending), text)
            out.append(path)
    return out


def linked_triplets(ids: list[str], source: str, folder: str) -> list[str]:
    """Make folder hold links to the three files of each sample in source and no others."""
    return linked_set({sid + e: os.path.join(source, sid + e) for sid in ids for e in TRIPLET}, folder)


def unique_inputs(rows: list[tuple[str, str]], folder: str) -> list[str]:
    """Hard links <sample id><suffix> for (sample id, path): base names that clash no more."""
    return [hard_link(os.path.realpath(path), os.path.join(folder, sid + os.path.splitext(path)[1])) for sid, path in rows]


def remove_orphans(folder: str, wanted: set[str]) -> list[str]:
    """Delete files whose stem (up to the first dot) is not wanted; returns their names."""
    gone = sorted(n for n in os.listdir(folder) if n.split(".", 1)[0] not in wanted)
    for name in gone:
        os.unlink(os.path.join(folder, name))
    return gone

"""Files that tasks write: attempts that are lost, commits that are repeated, orphans."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tallyloom.sources import files


def test_a_lost_attempt_leaves_nothing(spark, tmp_path):
    folder, table = f"file://{tmp_path}/out", f"file://{tmp_path}/table"
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "s3.json").write_text("old")
    df = spark.range(40).select(F.concat(F.lit("s"), F.col("id"), F.lit(".json")).alias("name"), F.concat(F.lit('{"n": '), F.col("id"), F.lit("}")).alias("content")).repartition(4)
    rows = files.written(df, folder)
    rows.write.parquet(table)
    lost = files.written(df.limit(3), folder)  # a whole write whose rows nobody keeps
    assert lost.count() == 3
    made = spark.read.schema(files.WRITTEN).parquet(table)
    # an attempt of a task that died after it wrote: its folder is beside the others
    (aside,) = {r["aside"].removeprefix("file://").rsplit("/", 2)[0] for r in made.collect()}
    os.makedirs(f"{aside}/0-999")
    with open(f"{aside}/0-999/s0.json", "w") as f:
        f.write("half")
    assert {r["state"] for r in files.committed(made, folder).collect()} == {"moved"}
    assert {r["state"] for r in files.committed(made, folder).collect()} == {"there"}  # once more, as after a lost commit
    files.finished(made, folder)
    names = sorted(n for n in os.listdir(tmp_path / "out") if n.startswith("s"))
    assert names == sorted(f"s{i}.json" for i in range(40)) and (tmp_path / "out" / "s3.json").read_text() == '{"n": 3}' and not os.path.exists(aside)
    digests = {r["name"]: (r["length"], r["digest"]) for r in made.collect()}
    assert all(digests[n] == (len(t), hashlib.sha256(t).hexdigest()) for n in names for t in [(tmp_path / "out" / n).read_bytes()])
    os.unlink(tmp_path / "out" / "s7.json")
    with pytest.raises(Exception, match="neither aside nor in its place"):
        files.committed(made, folder).collect()


def test_orphans_go_once(spark, tmp_path):
    for name in ("a.flac", "a.lyrics.txt", "b.flac", "c.x.json"):
        (tmp_path / name).write_text(name)
    listing = spark.createDataFrame([(n,) for n in ("a.flac", "a.lyrics.txt", "b.flac", "c.x.json")], "name string")
    wanted = spark.createDataFrame([("a",), ("c",)], "stem string")
    assert [r["name"] for r in files.orphaned(listing, wanted, f"file://{tmp_path}", remove=False).collect()] == ["b.flac"] and (tmp_path / "b.flac").exists()
    for _ in range(2):
        assert [r["name"] for r in files.orphaned(listing, wanted, f"file://{tmp_path}").collect()] == ["b.flac"]
    assert sorted(os.listdir(tmp_path)) == ["a.flac", "a.lyrics.txt", "c.x.json"]

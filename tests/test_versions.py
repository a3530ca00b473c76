"""The log of versions: readers between writers, writers at the same time, writers that are lost."""

import pytest

from tallyloom.sources.versions import ConcurrentWrite, Versions


def test_two_writers_and_a_reader(spark, tmp_path):
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "v long")
    told = lambda df: sorted(r["v"] for r in df.collect())
    a, b = (Versions(spark, f"file://{tmp_path}/m") for _ in range(2))
    assert a.latest() == 0 and a.read() is None
    assert a.commit(rows(1)) == 1
    base = b.latest()
    reader = a.read()
    assert a.commit(rows(1, 2)) == 2
    assert told(reader) == [1] and told(a.read()) == [1, 2]  # a snapshot stays what it was
    with pytest.raises(ConcurrentWrite):
        b.commit(rows(9), base)
    assert told(b.read()) == [1, 2] and len(list((tmp_path / "m" / "rows").iterdir())) == 2  # nothing is left of it
    assert b.commit(rows(1, 2, 3), b.latest()) == 3 and told(a.read(1)) == [1] and told(a.read()) == [1, 2, 3]


def test_lost_writers(spark, tmp_path):
    log = Versions(spark, f"file://{tmp_path}/m")
    df = spark.createDataFrame([(1, None)], "v long, s struct<x:int,y:array<string>>")
    log.commit(df)
    df.write.parquet(f"file://{tmp_path}/m/rows/lost")  # rows without an entry
    (tmp_path / "m" / "log" / "000000000002").write_text('{"rows": "ro')  # an entry that was cut off
    assert log.latest() == 1 and log.read().count() == 1 and log.read().schema == df.schema
    assert log.commit(df.unionAll(df)) == 3 and log.read().count() == 2
    log.clean()
    assert log.latest() == 3 and log.read().count() == 2 and len(list((tmp_path / "m" / "rows").iterdir())) == 1
    with pytest.raises(Exception, match="(?i)not.*exist|no such"):
        log.read(1).count()
    log.clean(0)
    assert log.latest() == 0 and log.commit(df) == 1

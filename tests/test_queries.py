"""Every query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from tallyloom.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    yield con
    con.close()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:26]
    return v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_same_rows(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    found = duck.execute(catalog.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert got == sorted(repr([plain(r[names.index(c)]) for c in columns]) for r in found.fetchall())
    assert got


def test_flagship_needs_no_corpus_package(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalog.SQL) <= set(__spark_entry__.oracle_sql())

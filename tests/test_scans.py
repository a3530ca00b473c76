"""Scans over hot keys, the balance of large groups and the range join against plain versions."""

import random
from bisect import bisect_left

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import balance, folds, intervals, ranges


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def spans(spark):
    rng = random.Random(2)
    rows = []
    for i in range(2000):
        start = rng.randrange(100_000)
        rows.append((rng.choice(["hot"] * 8 + ["a", None]), start, start + rng.choice([0, 1, 5, 12, 12, 300 if i % 50 == 0 else 3, 40_000 if i == 7 else 2])))
    return spark.createDataFrame(rows, "k string, start long, end long")


@pytest.mark.parametrize("tolerance", [0, 7])
@pytest.mark.parametrize("width", [90, 5_000, 10**9])
def test_merge_and_subtract_by_buckets(spark, spans, width, tolerance):
    assert rows_of(intervals.merged_intervals(spans, ["k"], tolerance, width)) == rows_of(intervals.merged_intervals(spans, ["k"], tolerance))
    cut = spans.where("start % 9 = 0")
    assert rows_of(intervals.subtracted(spans, cut, ["k"], tolerance, width)) == rows_of(intervals.subtracted(spans, cut, ["k"], tolerance))


@pytest.mark.parametrize("width", [10, 4_000])
def test_next_by_buckets(spark, spans, width):
    rows = spans.withColumn("i", F.monotonically_increasing_id()).cache()
    args = (["k"], "start", F.col("end") % 5 == 0, 60, "next")
    assert rows_of(intervals.next_within(rows, *args, width=width)) == rows_of(intervals.next_within(rows, *args))


@pytest.mark.parametrize("width", [None, 10**9, 3_000])
def test_next_of_a_hot_key_takes_a_step_a_row(spark, width):
    # a frame up to the end of its partition costs the square of its rows: minutes here
    n = 60_000
    at = lambda i: i * 7919 % n * 5
    rows = spark.range(n).select(F.lit("hot").alias("k"), F.pmod(F.col("id") * 7919, F.lit(n)) * 5, "id").toDF("k", "at", "i").unionByName(spark.createDataFrame([("hot", None, -1)], "k string, at long, i long"))
    out = intervals.next_within(rows, ["k"], "at", F.col("i") % 3 == 0, 9, "next", width=width)
    assert "FOLLOWING" not in out._jdf.queryExecution().analyzed().toString().upper()
    wanted = sorted(at(i) for i in range(0, n, 3))
    got = {r["i"]: r["next"] for r in out.select("i", "next").collect()}
    assert got.pop(-1) is None and len(got) == n
    for i, v in got.items():
        j = bisect_left(wanted, at(i))
        assert v == (wanted[j] if j < len(wanted) and wanted[j] <= at(i) + 9 else None)


def test_a_hot_key_is_many_tasks(spark):
    one = spark.range(20_000).select(F.floor(F.col("id") / 10**9).alias("k"), (F.col("id") * 10).alias("start"), (F.col("id") * 10 + 3).alias("end"))
    tasks = lambda df: len([n for n in df.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect() if n])
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # the last exchange is by key and island; the rows come out of as many tasks as there are islands to deal out
        out = intervals.merged_intervals(one, ["k"], 0, 20_000)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(k#" in plan and "_step#" in plan and tasks(out) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_map_of_a_block_is_the_fold():
    rng = random.Random(6)
    for _ in range(200):
        weights = sorted((rng.randrange(60) for _ in range(rng.randint(1, 25))), reverse=True)
        low, high = -150, 150
        whole = balance.summed_up(weights, low, high, 10**6)
        some = balance.summed_up(weights, low, high, 4)
        for d in range(low, high + 1):
            end = balance.folded(weights, d)[1]
            assert balance.after(whole, d) == end and balance.after(some, d) in (None, end)
        assert len(some) <= 4 and balance.after(whole, high + 1) is None


@pytest.mark.parametrize("kind", ["even", "heavy", "equal", "steep", "durations"])
def test_balance_in_blocks(spark, kind):
    rng = random.Random(kind)
    make = {"even": lambda i: rng.randrange(1000, 2000), "heavy": lambda i: int(1.02 ** rng.randrange(900)), "equal": lambda i: 7, "steep": lambda i: 2 ** (i % 50), "durations": lambda i: rng.randrange(30_000, 240_000)}[kind]
    rows = [("one" if i % 10 else rng.choice(["x", None]), make(i), i, f"row{i}") for i in range(3000)] + [("one", None, 3000, "none"), ("x", 5, 3001, "twice"), ("x", 5, 3001, "twice")]
    df = spark.createDataFrame(rows, "grp string, w long, i long, name string")
    got = balance.balanced(df.withColumn("part", F.lit("clash")), ["grp"], "w", "i", blocks=9)
    assert rows_of(got) == rows_of(folds.balanced(df, ["grp"], "w", "i"))
    if kind == "durations":
        seconds = df.withColumn("w", F.col("w") / 1000)
        assert rows_of(balance.balanced(seconds, ["grp"], "w", "i", 0.001, blocks=7).drop("w")) == rows_of(got.drop("w"))


def test_blocks_grow_with_the_rows(spark, monkeypatch):
    # each block may be a job after the one before it, so shuffle partitions must not make more of them
    asked, starts = [], balance._starts
    monkeypatch.setattr(balance, "_starts", lambda *a: asked.append(len(a[-1][0][1])) or starts(*a))
    df = spark.range(3000).select(F.lit("one").alias("grp"), F.pmod(F.xxhash64("id"), F.lit(900)).alias("w"), "id")
    expected = rows_of(folds.balanced(df, ["grp"], "w", "id"))
    assert rows_of(balance.balanced(df, ["grp"], "w", "id")) == expected and asked == []
    monkeypatch.setattr(balance, "BLOCK", 1000)
    assert rows_of(balance.balanced(df, ["grp"], "w", "id")) == expected and asked == [3]


def test_balance_of_few_rows(spark):
    empty = spark.createDataFrame([], "grp int, w int, i int")
    assert balance.balanced(empty, ["grp"], "w", "i").count() == 0
    with pytest.raises(Exception, match="negative weight"):
        balance.balanced(spark.createDataFrame([(1, -1, 1)], "grp int, w int, i int"), ["grp"], "w", "i").collect()


def test_balance_takes_many_tasks(spark):
    big = spark.range(1_000_000).select(F.floor(F.col("id") / 10**9).alias("grp"), F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("w"), "id")
    out = balance.balanced(big, ["grp"], "w", "id", blocks=24)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 1_000_000 and len(sizes) >= 4
    load = {r["part"]: r["s"] for r in out.groupBy("part").agg(F.sum("w").alias("s")).collect()}
    assert abs(load[0] - load[1]) <= 2


@pytest.mark.parametrize("width", [None, 3, 1000.0])
def test_range_join(spark, width):
    rng = random.Random(8)

    def side(n, seed):
        out = []
        for i in range(n):
            start = rng.randrange(-500, 3000)
            out.append((rng.choice(["a", "b", None]), start if rng.random() > 0.02 else None, start + rng.choice([0, 1, 4, 30, 30, 500, -5]), i))
        return [*out, ("a", -1000, 5000, n)]  # spans all bins

    a, b = side(300, 1), side(200, 2)
    schema = "k string, start long, end long, i int"
    out = ranges.overlapping(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["k"], width=width)
    ok = lambda x: None not in x[:3] and x[2] >= x[1]
    expected = sorted((x[3], y[3]) for x in a for y in b if ok(x) and ok(y) and x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    assert sorted((r["left_i"], r["right_i"]) for r in out.collect()) == expected and len(expected) > 500
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert out.columns == ["k", "left_start", "left_end", "left_i", "right_start", "right_end", "right_i"]
    assert ranges.overlapping(spark.createDataFrame([], schema), spark.createDataFrame(b, schema), ["k"], width=width).count() == 0

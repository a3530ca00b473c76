"""The tracker as a stream: batches, a restart and an initial state."""

import pytest

from tallyloom.operators import folds
from tallyloom.streaming import tracker

RUNS = "run string, step int, loss double"


@pytest.fixture
def store(spark):
    (key, provider), = tracker.STATE_STORE.items()
    spark.conf.set(key, provider)
    yield
    spark.conf.unset(key)


def feed(spark, tmp_path, rows, name, **more):
    """The rows of a query that takes what has come, on one checkpoint."""
    spark.createDataFrame(rows, RUNS).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    out = tracker.tracked(spark.readStream.schema(RUNS).parquet(f"file://{tmp_path}/in"), "run", "step", "loss", patience=2, **more)
    query = out.writeStream.format("parquet").option("path", f"file://{tmp_path}/{name}").option("checkpointLocation", f"file://{tmp_path}/check-{name}").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"file://{tmp_path}/{name}")


def test_stream_goes_on_after_a_restart(spark, tmp_path, store):
    losses = [5.0, 4.0, 4.5, None, 3.0, 3.1, 3.2, 2.999999999, 1.0]
    rows = [("r", i, x) for i, x in enumerate(losses)] + [("s", i, 7.0 - i) for i in range(6)]
    want = sorted(map(tuple, folds.tracked(spark.createDataFrame(rows, RUNS), ["run"], "step", "loss", patience=2).collect()), key=repr)
    for low, high in ((0, 3), (3, 4), (4, 9)):
        got = feed(spark, tmp_path, [r for r in rows if low <= r[1] < high][::-1], "out")
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_initial_state(spark, tmp_path, store):
    known = spark.createDataFrame([("r", 4.0, 1, 1), ("quiet", 2.0, 9, 0)], "run string, best_loss double, best_step long, stale int")
    got = feed(spark, tmp_path, [("r", 3, 4.5), ("t", 0, 1.0)], "out", state=known)
    assert {r["run"]: (r["best_loss"], r["best_step"], r["stale"], r["stop"]) for r in got.collect()} == {"r": (4.0, 1, 2, True), "t": (1.0, 0, 0, False)}
    got = feed(spark, tmp_path, [("quiet", 12, 2.5), ("t", 1, 0.5)], "out", state=known)
    assert {r["run"]: (r["best_loss"], r["best_step"], r["stale"]) for r in got.where("step IN (1, 12)").collect()} == {"quiet": (2.0, 9, 1), "t": (0.5, 1, 0)}
    with pytest.raises(ValueError, match="must be"):
        tracker.tracked(got, "run", "step", "loss", every=0)

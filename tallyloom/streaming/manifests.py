"""Manifests as streams: rows that arrive as JSON lines are checked against what is done and upserted, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.resume import latest, pending, upsert


def follow(spark: SparkSession, inbox: str, schema: str, key: str, state: Callable[[], DataFrame], commit: Callable[[DataFrame], None], work: Callable[[DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """A query that takes each batch of new files, drops keys that are done, works on the rest and commits the upserted state.

    state() gives the committed rows (with a status column) and commit() replaces them; a batch that is replayed finds its keys done, so work runs once a key.
    """

    def batch(rows: DataFrame, number: int) -> None:
        old = state()
        todo = pending(latest(rows, [key], F.col("_order")).drop("_order"), old.where("status = 'complete'"), [key])
        commit(upsert(old, work(todo), [key]))

    stream = spark.readStream.schema(schema).json(inbox).withColumn("_order", F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_path")))
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Activity sessions of each user over event time: rows closer than the gap are one session; rows later than the watermark are dropped. A stream's near relative of merged intervals."""
    return events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap)).agg(F.count("*").alias("n_events")).select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n_events")

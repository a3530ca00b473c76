"""Early stopping over a stream of checks: the state of each training run is kept by the query.

A run's state (best loss, its step, checks since) is a value of the query's state, so a query that is started again on its checkpoint goes on where it stopped, and runs that are known from elsewhere come as an initial state. State needs the RocksDB provider (STATE_STORE), which the session must name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyloom.operators.folds import FRESH

STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
_STATE = "best_loss double, best_step bigint, stale int, stop boolean"


class Tracker(StatefulProcessor):
    def __init__(self, run: str, step: str, loss: str, patience: int, margin: float):
        self.names, self.patience, self.margin = (run, step, loss), patience, margin

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "best_loss double, best_step bigint, stale int")

    def _held(self) -> tuple:
        return self.state.get() if self.state.exists() else FRESH

    def _rows(self, run, rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame([(run, *r) for r in rows], columns=[*self.names, "best_loss", "best_step", "stale", "stop"])
        return out.astype({self.names[1]: "Int64", self.names[2]: "float64", "best_step": "int64", "stale": "int32"})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best, at, stale = self._held()
        _, step, loss = self.names
        out = []
        for s, x in sorted((int(s), None if pd.isna(x) else float(x)) for part in rows for s, x in zip(part[step], part[loss], strict=True)):
            better = x is not None and x < best - self.margin
            best, at, stale = (x, s, 0) if better else (best, at, stale + 1)
            out.append((s, x, best, at, stale, self.patience > 0 and stale >= self.patience))
        self.state.update((best, at, stale))
        yield self._rows(key[0], out)

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues) -> None:
        r = initialState.iloc[0]
        self.state.update((float(r["best_loss"]), int(r["best_step"]), int(r["stale"])))

    def close(self) -> None:
        pass


def tracked(checks: DataFrame, run: str, step: str, loss: str, every: int = 1, patience: int = 0, margin: float = 1e-8, state: DataFrame | None = None) -> DataFrame:
    """The rows that folds.tracked gives, from a stream of checks: run, step, loss, best_loss, best_step, stale, stop.

    Checks of a run must come in the order of their steps over batches; within a batch they are sorted. state: rows (run, best_loss, best_step, stale), unique by run, that runs go on from; it is read when the query is first started.
    """
    if every < 1 or patience < 0:
        raise ValueError(f"every must be 1 or more and patience 0 or more, not {every} and {patience}")
    rows = checks.where(F.pmod(F.col(step), F.lit(every)) == 0).select(run, F.col(step).cast("bigint").alias(step), F.col(loss).cast("double").alias(loss))
    out = T.StructType([*rows.schema.fields, *T.StructType.fromDDL(_STATE).fields])
    first = None if state is None else state.select(run, F.col("best_loss").cast("double").alias("best_loss"), F.col("best_step").cast("bigint").alias("best_step"), F.col("stale").cast("int").alias("stale")).groupBy(run)
    return rows.groupBy(run).transformWithStateInPandas(Tracker(run, step, loss, patience, margin), out, "Append", "None", first)

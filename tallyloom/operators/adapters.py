"""Adapters for work outside Spark (probes, encoders, models behind an API): small batches in mapInPandas, one row out for each row in.

A client is made once a task by a factory and called per row; whatever it raises becomes an error row, never a failed job. Write an adapter's result before branching, or each branch calls it again.
"""

from __future__ import annotations

import json
import random
import subprocess
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

from tallyloom.functions.features import RETRYABLE


class Client(Protocol):
    def __call__(self, row: dict) -> dict: ...


class Rejected(Exception):
    """An answer with a status code; others than the retryable ones end the attempts."""

    def __init__(self, code: int, text: str = ""):
        super().__init__(f"{code} {text}".strip())
        self.code = code


def run(command: list[str], timeout: float = 1800, log: bool = False) -> tuple[bool, str]:
    """(whether the command ended well, its output (with log: what it reported, too) or the last 1000 characters of its error on one line)."""
    try:
        done = subprocess.run(command, capture_output=True, text=True, timeout=timeout, check=False, encoding="utf-8", errors="replace")
    except (OSError, subprocess.TimeoutExpired) as e:
        return False, str(e)[-1000:].replace("\n", " ")
    if done.returncode:
        return False, (done.stderr or done.stdout)[-1000:].replace("\n", " ")
    return True, f"{done.stderr}\n{done.stdout}" if log else done.stdout


def logged(command: list[str], timeout: float = 1800) -> tuple[bool, str]:
    return run(command, timeout, True)


def retried(call: Client, row: dict, attempts: int = 5, sleep: Callable[[float], None] = time.sleep) -> tuple[dict | None, str | None, int]:
    """(result, error, attempts made). Status codes that are not retryable end at once; anything else is tried again after min(60, 2**attempt + jitter) seconds."""
    error = None
    for n in range(1, attempts + 1):
        try:
            return call(row), None, n
        except Rejected as e:
            error = str(e)
            if e.code not in RETRYABLE:
                return None, error, n
        except Exception as e:  # noqa: BLE001  an error row, not a failed job
            error = f"{type(e).__name__}: {e}"
        if n < attempts:
            sleep(min(60.0, 2.0**n + random.random()))
    return None, error, attempts


def escalated(tiers: list[Client], row: dict, attempts: int = 5, valid: Callable[[dict], list[str]] = lambda r: [], sleep: Callable[[float], None] = time.sleep) -> tuple[dict | None, str | None, int]:
    """Tiers of effort in turn, until one gives a result without error codes; a validator that raises counts as an error code."""
    error, made = "no tier", 0
    for tier in tiers:
        result, error, n = retried(tier, row, attempts, sleep)
        made += n
        if result is None:
            continue
        try:
            codes = valid(result)
        except Exception as e:  # noqa: BLE001
            codes = [f"validator:{type(e).__name__}"]
        if not codes:
            return result, None, made
        error = ",".join(codes)
    return None, error, made


def adapted(df: DataFrame, factory: Callable[[], Client], key: str, attempts: int = 5, sleep: Callable[[float], None] | None = None) -> DataFrame:
    """key, result (JSON), error, attempts for each row of df."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for batch in batches:
            rows = [(r[key], *retried(client, r, attempts, sleep or time.sleep)) for r in batch.to_dict("records")]
            yield pd.DataFrame([(k, None if out is None else json.dumps(out), error, n) for k, out, error, n in rows], columns=[key, "result", "error", "attempts"])

    kind = next(f.dataType.simpleString() for f in df.schema if f.name == key)
    return df.mapInPandas(work, f"{key} {kind}, result string, error string, attempts int")


class Recorded:
    """A client that gives the answer a row carries as JSON (say, of an earlier run), and refuses rows without one."""

    def __init__(self, column: str):
        self.column = column

    def __call__(self, row: dict) -> dict:
        if row[self.column] is None:
            raise Rejected(404, "no recorded answer")
        return json.loads(row[self.column])

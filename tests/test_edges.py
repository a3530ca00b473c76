"""Sources, sinks, adapters and streams on files."""

import json
import os

from tallyloom.operators import adapters
from tallyloom.sources import sinks, tables
from tallyloom.streaming import manifests


def test_csv_with_mark_and_missing_manifest(spark, tmp_path):
    (tmp_path / "c.csv").write_bytes("﻿k,v\n1,é\n".encode())
    assert [tuple(r) for r in tables.read_csv(spark, str(tmp_path / "c.csv"), ["k", "v"]).collect()] == [("1", "é")]
    assert tables.read_jsonl(spark, str(tmp_path / "none.jsonl"), "k string").count() == 0


def test_jsonl_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b", None), ("a", "ü")], "k string, v string")
    sinks.write_jsonl(df, str(tmp_path / "m"), "k")
    assert sorted((r["k"], r["v"]) for r in tables.read_jsonl(spark, str(tmp_path / "m"), "k string, v string").collect()) == [("a", "ü"), ("b", None)]
    assert sinks.json_lines(df.where("k = 'b'")).first()["value"] == '{"k":"b","v":null}'


def test_part_states(spark, tmp_path):
    (tmp_path / "s_part0.jsonl").write_text('{"k":"x","st":"complete","v":1}\n{"k":"x","st":"failed","v":2}\n')
    (tmp_path / "s_part1.jsonl").write_text('{"k":"y","st":"complete","v":3}\n{"k":"y","st":"complete","v":4}\n')
    got = tables.read_part_states(spark, str(tmp_path / "s_part*.jsonl"), "k string, st string, v int", "k", "st")
    assert sorted((r["k"], r["v"]) for r in got.collect()) == [("x", 1), ("y", 4)]


def test_documents_with_a_broken_one(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"analysis_status": "complete", "bpm": 120}')
    (tmp_path / "b.json").write_text("{broken")
    got = tables.read_documents(spark, str(tmp_path), "analysis_status string, bpm int")
    assert sorted(tuple(r) for r in got.collect()) == [("a", "complete", 120), ("b", "invalid_json", None)]
    assert sorted(r["name"] for r in tables.listing(spark, str(tmp_path / "*.json")).collect()) == ["a.json", "b.json"]


def test_settings(tmp_path):
    (tmp_path / "env").write_text("# c\n\nA = 1=2\nB=x\nno\n")
    assert tables.read_settings(str(tmp_path / "env"), {"B": "kept"}) == {"B": "kept", "A": "1=2"}


def test_links_and_orphans(tmp_path):
    for d in "ab":
        (tmp_path / d).mkdir()
        (tmp_path / d / "instrumental.flac").write_text(d)
    made = sinks.unique_inputs([("catalog__001", str(tmp_path / "a/instrumental.flac")), ("catalog__002", str(tmp_path / "b/instrumental.flac"))], str(tmp_path / "in"))
    assert sorted(map(os.path.basename, made)) == ["catalog__001.flac", "catalog__002.flac"]
    assert os.stat(made[0]).st_ino == os.stat(tmp_path / "a/instrumental.flac").st_ino and not os.path.islink(made[0])
    assert sinks.remove_orphans(str(tmp_path / "in"), {"catalog__001"}) == ["catalog__002.flac"]
    sinks.write_json(str(tmp_path / "r.json"), {"ok": True})
    assert json.loads((tmp_path / "r.json").read_text()) == {"ok": True}


def test_csv_sink_and_index(spark, tmp_path):
    df = spark.createDataFrame([(0, "b", None), (0, "a", "y")], "part int, sample_id string, note string")
    sinks.write_csv(df, str(tmp_path / "csv"), ["sample_id", "note"])
    assert sorted(tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).na.fill("").collect()) == [("a", "y"), ("b", "")]
    row = sinks.dataset_index(df, "sample_id", ["note"]).first()
    assert row["n_samples"] == 2 and [s["sample_id"] for s in json.loads(row["document"])["samples"]] == ["a", "b"]


def test_adapter_rows_and_errors(spark):
    def factory():
        def call(row):
            if row["k"] == "bad":
                raise ValueError("no")
            return {"v": row["k"].upper()}

        return call

    df = spark.createDataFrame([("a",), ("bad",)], "k string")
    got = {r["k"]: (r["result"], r["error"], r["attempts"]) for r in adapters.adapted(df, factory, "k", attempts=2, sleep=lambda s: None).collect()}
    assert got["a"] == ('{"v": "A"}', None, 1) and got["bad"][1:] == ("ValueError: no", 2)


class FakeClient:
    """Answers from a function of the row and counts its calls."""

    def __init__(self, answer):
        self.answer, self.calls = answer, 0

    def __call__(self, row):
        self.calls += 1
        return self.answer(row)


def test_retries():
    codes = iter([429, 500])

    def call(row):
        code = next(codes, None)
        if code:
            raise adapters.Rejected(code)
        return {"ok": 1}

    assert adapters.retried(call, {}, sleep=lambda s: None) == ({"ok": 1}, None, 3)
    client = FakeClient(lambda row: (_ for _ in ()).throw(adapters.Rejected(400)))
    assert adapters.retried(client, {}, sleep=lambda s: None)[2] == 1 and client.calls == 1
    bad = adapters.escalated([lambda r: {"t": 0}, lambda r: {"t": 1}], {}, valid=lambda r: [] if r["t"] else ["short"], sleep=lambda s: None)
    assert bad == ({"t": 1}, None, 2)


def test_stream_resumes(spark, tmp_path):
    inbox, store, calls = tmp_path / "in", {"path": None}, []
    inbox.mkdir()
    kind = "k string, status string"

    def state():
        return spark.read.parquet(store["path"]) if store["path"] else spark.createDataFrame([], kind)

    def commit(df):
        store["path"] = sinks.write_manifest(df, str(tmp_path / "state"))

    def work(df):
        rows = [r["k"] for r in df.collect()]
        calls.extend(rows)
        return spark.createDataFrame([(k, "complete") for k in rows], kind)

    for name, text in (("a", '{"k":"x"}\n{"k":"y"}\n'), ("b", '{"k":"x"}\n{"k":"z"}\n')):
        (inbox / f"{name}.json").write_text(text)
        manifests.follow(spark, str(inbox), "k string", "k", state, commit, work, str(tmp_path / "cp")).awaitTermination()
    assert sorted(calls) == ["x", "y", "z"] and state().count() == 3


def test_sessions(spark, tmp_path):
    rows = spark.sql("SELECT 1 AS user_id, timestamp'2024-01-01 00:00:00' AS ts UNION ALL SELECT 1, timestamp'2024-01-01 00:10:00' UNION ALL SELECT 1, timestamp'2024-01-01 05:00:00'")
    assert sorted(r["n_events"] for r in manifests.sessions(rows).collect()) == [1, 2]

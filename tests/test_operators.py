"""Small cases of the operators, with results worked out by hand."""

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import features, keys, nulls, text_rules
from tallyloom.operators import folds, gates, intervals, resume, variants
from tallyloom.plans import curation
from tallyloom.sources import sinks


def value(spark, expr, row="SELECT 1 AS one"):
    return spark.sql(row).select(expr.alias("v")).first()["v"]


def spans(spark, *pairs):
    return F.array(*(F.struct(F.lit(float(a)).alias("start"), F.lit(float(b)).alias("end")) for a, b in pairs)) if pairs else F.array().cast("array<struct<start:double,end:double>>")


@pytest.mark.parametrize(("key", "expected"), [("src:12", "src__12"), ("a b/c:1", "a_b_c__1")])
def test_sample_id(spark, key, expected):
    assert value(spark, keys.sample_id(F.lit(key))) == expected


def test_empty_sample_id_is_an_error(spark):
    with pytest.raises(Exception, match="empty record key"):
        value(spark, keys.sample_id(F.lit("")))


def test_hash_bucket_is_the_digest_modulo_n(spark):
    import hashlib

    for n in (2, 3, 7):
        assert value(spark, keys.hash_bucket(F.lit("track-1"), n)) == int(hashlib.sha256(b"track-1").hexdigest(), 16) % n


def test_null_rules(spark):
    row = "SELECT '' AS a, 'x' AS b, CAST(NULL AS STRING) AS n"
    assert value(spark, nulls.first_truthy(F.col("n"), F.col("a"), F.col("b")), row) == "x"
    assert value(spark, nulls.is_in(F.col("n"), "x"), row) is False
    assert value(spark, nulls.differs(F.col("n"), F.col("b")), row) is True
    assert value(spark, nulls.int_or_zero(F.col("b")), row) == 0


@pytest.mark.parametrize(("d", "n"), [(9, 0), (10, 0), (35, 1), (36, 2), (60, 2), (61, 3)])
def test_chunks(spark, d, n):
    df = spark.createDataFrame([(float(d),)], "d double")
    assert intervals.chunked(df, "d").count() == n


def test_merge_and_clean_runs(spark):
    merged = value(spark, intervals.merge_array(spans(spark, (0, 30), (25, 55), (55.05, 60), (70, 80))))
    assert [tuple(x) for x in merged] == [(0, 60), (70, 80)]
    good, bad = spans(spark, (0, 30), (25, 55), (75, 105), (100, 160)), spans(spark, (50, 80))
    assert [tuple(x) for x in value(spark, intervals.clean_runs(good, bad))] == [(0, 50), (80, 160)]
    assert value(spark, intervals.clean_runs(spans(spark), bad)) == []
    # edges that only meet don't cut
    assert [tuple(x) for x in value(spark, intervals.clean_runs(spans(spark, (0, 60)), spans(spark, (60, 70))))] == [(0, 60)]


def test_relational_subtraction_equals_the_array_form(spark):
    good = spark.createDataFrame([("k", 0, 30), ("k", 25, 55), ("k", 75, 105), ("k", 100, 160)], "key string, start long, end long")
    bad = spark.createDataFrame([("k", 50, 80)], good.schema)
    assert sorted((r["start"], r["end"]) for r in intervals.subtracted(good, bad, ["key"]).collect()) == [(0, 50), (80, 160)]


def test_longest_takes_the_earliest_of_equals(spark):
    df = spark.createDataFrame([("k", 100, 160), ("k", 0, 60)], "key string, start long, end long")
    assert tuple(intervals.longest(df, ["key"]).first())[1:] == (0, 60)


def test_best_window(spark):
    sections = "array(named_struct('label','Intro','start',0D,'end',80D),named_struct('label','Theme','start',80D,'end',180D),named_struct('label','Drop','start',180D,'end',300D),named_struct('label','Final Drop','start',300D,'end',400D))"
    df = spark.sql(f"SELECT 400D AS d, transform(sequence(0,400,4), x -> CAST(x AS DOUBLE)) AS b, {sections} AS s")
    weight = lambda label: features.lookup(features.WEIGHTS, label, 1.0)
    best = df.select(intervals.best_window(F.col("d"), F.col("b"), F.col("s"), weight, 240.0).alias("w")).first()["w"]
    assert (best["start"], best["end"], best["score"]) == (160.0, 400.0, 1020.0)
    short = df.select(intervals.best_window(F.lit(180.0), F.col("b"), F.col("s"), weight, 240.0).alias("w")).first()["w"]
    assert (short["start"], short["end"]) == (0.0, 180.0)


@pytest.mark.parametrize(("raw", "expected"), [(["chorus", "verse", "chorus"], ["Drop", "Theme", "Final Drop"]), (["chorus"], ["Drop"]), (["xyz"], ["Theme"]), ([], [])])
def test_section_labels(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "raw array<string>")
    assert df.select(features.section_labels(F.col("raw")).alias("v")).first()["v"] == expected


def test_array_rules(spark):
    df = spark.createDataFrame([([1, 2, 3, 4] * 4, [0.0, 1.0, 2.0, 3.0]), ([1, 2, 3] * 5, [0.0] * 4)], "p array<int>, d array<double>")
    assert [r["v"] for r in df.select(features.time_signature(F.col("p"), F.col("d")).alias("v")).collect()] == ["4", None]
    bpm = spark.createDataFrame([(v,) for v in (40.0, 250.0, 39.0, 251.0, 128.9)], "v double")
    assert [r["v"] for r in bpm.select(features.int_in_range(F.col("v"), 40, 250).alias("v")).collect()] == [40, 250, None, None, 128]


def test_collapse_and_lyrics(spark):
    df = spark.createDataFrame([(["a", "a", "b", "a"],), ([],)], "v array<string>")
    assert [r["v"] for r in df.select(features.collapse(F.col("v")).alias("v")).collect()] == [["a", "b", "a"], []]
    text = spark.createDataFrame([([],), (["Intro", "Drop"],)], "v array<string>").select(features.lyrics(F.col("v")).alias("v")).collect()
    assert [r["v"] for r in text] == ["[Instrumental]\n", "[Intro]\n[Instrumental]\n\n[Drop]\n[Instrumental]\n"]


def test_names(spark):
    df = spark.createDataFrame([("Aaaa feat. Bbbb & Cccc",), ("Ab & Cdef",)], "v string")
    assert [r["v"] for r in df.select(text_rules.names(F.col("v")).alias("v")).collect()] == [["aaaa", ". bbbb", "cccc"], ["cdef"]]
    assert df.select(text_rules.names(F.col("v"), strict=True).alias("v")).first()["v"] == ["aaaa", "bbbb", "cccc"]


@pytest.mark.parametrize(("n", "ok"), [(39, False), (40, True), (80, True), (81, False)])
def test_caption_length(spark, n, ok):
    df = spark.createDataFrame([(" ".join(["word"] * n),)], "t string")
    codes = text_rules.error_codes((~text_rules.word_count(F.col("t")).between(40, 80), "word_count"))
    assert (df.select(codes.alias("v")).first()["v"] == []) is ok


def test_silence_ratio(spark):
    ratio = features.silence_ratio(F.lit("silence_duration: 2.5 x silence_duration: 3.0"), r"silence_duration: ([0-9.]+)", F.lit(11.0))
    assert value(spark, ratio) == 0.5
    assert value(spark, features.silence_ratio(F.lit("x"), "([0-9])", F.lit(0.0))) is None


def test_snap_and_backoff(spark):
    beats = F.array(*map(F.lit, (1.0, 4.0, 9.0)))
    assert value(spark, features.snap(beats, F.lit(2.0))) == 4.0
    assert value(spark, features.snap(beats, F.lit(5.0))) == 5.0
    assert [value(spark, features.backoff_seconds(F.lit(n))) for n in (0, 3, 9)] == [1.0, 8.0, 60.0]


def test_first_failed_gate_wins(spark):
    reason = gates.first_failure([(F.lit(None).cast("boolean"), "null"), (F.lit(True), "first"), (F.lit(True), "second")])
    assert value(spark, reason) == "first"
    found = gates.result(spark.range(3).agg(F.count("*").alias("n")), F.col("n") == 3)
    assert found.ok and found.report == {"n": 3}
    with pytest.raises(ValueError, match="3 rows"):
        gates.expect_rows(spark.range(3), 240)


def test_resume(spark):
    source = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    state = spark.createDataFrame([("a", "complete"), ("b", "failed")], "k string, status string")
    assert sorted(r["k"] for r in resume.pending(source, state.where("status = 'complete'"), ["k"]).collect()) == ["b", "c"]
    left, right = spark.createDataFrame([("k", 1, 2)], "k string, x int, y int"), spark.createDataFrame([("k", None)], "k string, y int")
    assert tuple(resume.merged(left, right, ["k"]).first()) == ("k", 1, None)
    e, a = spark.createDataFrame([("a",), ("b",)], "k string"), spark.createDataFrame([("b",), ("c",)], "k string")
    assert {(r["k"], r["status"]) for r in resume.reconciled(e, a, ["k"]).collect()} == {("a", "missing"), ("b", "matched"), ("c", "extra")}
    assert resume.first_n(source, -3, "k").count() == 0


def test_group_split_keeps_groups_whole(spark):
    rows = spark.createDataFrame([("a", "s"), ("b", "s"), ("c", "o")], "id string, g string")
    split = {r["id"]: r["split"] for r in folds.group_split(rows, "g", 0.34).collect()}
    assert set(split) == {"a", "b", "c"} and split["a"] == split["b"]
    assert sorted(k for k, v in split.items() if v == "validation") in (["a", "b"], ["c"])


def test_balance(spark):
    rows = spark.createDataFrame([("g", i, w) for i, w in enumerate((9, 7, 6, 5))], "g string, id long, w long")
    assert [r["part"] for r in folds.balanced(rows, ["g"], "w", "id").orderBy("id").collect()] == [0, 1, 1, 0]


def test_early_stopping(spark):
    rows = spark.createDataFrame([("r", i + 1, v) for i, v in enumerate((1.0, 0.9, 0.9, 0.95))], "r string, epoch long, loss double")
    out = folds.tracked(rows, ["r"], "epoch", "loss", patience=2).orderBy("epoch").collect()
    assert [(x["best_loss"], x["best_step"], x["stale"], x["stop"]) for x in out] == [(1.0, 1, 0, False), (0.9, 2, 0, False), (0.9, 2, 1, False), (0.9, 2, 2, True)]


def test_mean_of_means(spark):
    rows = spark.createDataFrame([(1, 1.0), (2, 3.0)], "b int, v double")
    assert folds.mean_of_means(rows, "b", "v").first()["mean_of_means"] == 2.0
    with pytest.raises(Exception, match="no batches"):
        folds.mean_of_means(rows.where("b > 9"), "b", "v").collect()


def test_variants(spark):
    df = spark.createDataFrame([([" a ", "", "b"], "cap"), (None, "cap")], "v array<string>, c string")
    assert [r["v"] for r in df.select(variants.prompts(F.col("v"), F.col("c")).alias("v")).collect()] == [["a", "b"], ["cap"]]
    assert value(spark, variants.chosen(F.array(F.lit("x"), F.lit("y")), F.lit("id"), F.lit(1), training=False)) == "x"


def test_prepare_gates(spark):
    base = ("id", "1", "vid", "p.flac", "COMPLETE", "")
    cp = spark.createDataFrame([(f"s:{i}", *base) for i in range(5)] + [("s:9", *base[:4], "FAILED", "")], "record_key string, source_id string, source_rank string, video_id string, audio_path string, status string, reason string")
    sel = spark.createDataFrame([("s:0", "t", "a", "v")], "record_key string, expected_title string, expected_artist string, expected_version string")
    kind = "record_key string, file_exists boolean, probe_error string, has_audio boolean, source_duration double, encode_error string, canonical_error string, duration double, sample_rate int, channels int, decode_error string, silence_ratio double, preview_error string"
    probe = lambda k, d, ratio: (k, True, None, True, d, None, None, d, 48000, 2, None, ratio, None)
    probes = spark.createDataFrame([probe("s:0", 30.0, 0.8), probe("s:1", 29.999, 0.0), probe("s:2", 600.0, 0.8001), ("s:3", False, *[None] * 11)], kind)
    got = {r["record_key"]: r["reject_reason"] for r in curation.prepare(cp, sel, probes).collect()}
    assert got == {"s:0": None, "s:1": "source_duration_out_of_range:29.999", "s:2": "mostly_silence:0.8001", "s:3": "source_missing", "s:4": "source_missing", "s:9": "not_downloaded:FAILED"}


def test_selection_cascade(spark):
    vocal = spark.createDataFrame([("a", "complete", "instrumental", 1.0), ("b", "complete", "lyrics", 1.0), ("c", "complete", "lyrics", 1.0), ("d", "complete", "lyrics", 1.0), ("e", "complete", "uncertain", 1.0)], "sample_id string, classification_status string, vocal_status string, duration double")
    kind = "sample_id string, classification_status string, vocal_status string"
    full = spark.createDataFrame([("b", "complete", "instrumental"), ("c", "complete", "lyrics")], kind)
    clean = spark.createDataFrame([("c", "complete", "lyrics")], kind)
    search = spark.createDataFrame([("c", "rejected", None, None)], "sample_id string, search_status string, section_start double, section_end double")
    got = {r["sample_id"]: (r["audio_source"], r["pending_reason"], r["clean_target"]) for r in curation.select(vocal, full, clean, search).collect()}
    assert got == {"a": ("original", None, False), "b": ("separated_full", None, False), "c": ("rejected", None, False), "d": ("pending", "vocal_check_incomplete", True), "e": ("pending", "vocal_check_incomplete", False)}


def test_consistency(spark):
    df = spark.createDataFrame([("lyrics", "keep_original", 0.5, "x"), ("lyrics", "separate_vocals", 0.5, "x"), (None, None, 2.0, " ")], "s string, a string, p double, r string")
    got = [r["v"] for r in df.select(curation.consistent(*map(F.col, "sapr")).alias("v")).collect()]
    assert got == [["inconsistent_action"], [], ["blank_reason", "invalid_prominence", "invalid_vocal_status"]]


def test_sidecar_leaves_out_what_is_missing(spark):
    df = spark.createDataFrame([("s", "cap", [("tags", "T"), ("full", "F")], "", "C major")], "sample_id string, caption string, caption_variants array<struct<type:string,text:string>>, bpm string, keyscale string")
    assert sinks.sidecars(df).first()["document"] == '{"caption":"cap","caption_variants":["F",null,null,"T"],"keyscale":"C major"}'

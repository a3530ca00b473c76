"""The stages with fake clients, media clients with fake programs, folds on the rows that break things, sinks and sources."""

import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tallyloom.functions import annotation, features, keys
from tallyloom.operators import adapters, contained, folds, intervals, media, variants
from tallyloom.plans import curation, stages
from tallyloom.sources import sinks, tables

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import the tests

TAXONOMY = {"primary_genres": ["house", "trance"], "style_families": ["melodic"], "moods": ["calm"], "instruments": ["piano", "unknown"], "instrument_roles": ["lead"]}
CAPTION = "Instrumental " + " ".join(["soft"] * 49)
GOOD = {"primary_genre": "house", "secondary_genres": ["trance"], "style_families": ["melodic"], "moods": ["calm"], "main_instruments": [{"name": "piano", "role": "lead", "confidence": 0.9}], "canonical_caption": CAPTION, "caption_variants": [{"type": t, "text": CAPTION if t == "full" else t} for t in annotation.VARIANTS], "annotation_confidence": 0.9}


def no_sleep(seconds):
    pass


@pytest.mark.parametrize(
    ("change", "codes"),
    [
        ({}, []),
        ({"primary_genre": "polka"}, ["invalid_primary_genre"]),
        ({"primary_genre": None, "secondary_genres": None}, ["invalid_primary_genre"]),
        ({"secondary_genres": ["polka"], "moods": ["loud"], "style_families": ["odd"]}, ["invalid_moods", "invalid_secondary_genres", "invalid_style_families"]),
        ({"main_instruments": [{"name": "kazoo", "role": "solo", "confidence": 0.1}]}, ["invalid_instrument", "invalid_instrument_role", "low_confidence_instrument"]),
        ({"main_instruments": [{"name": "unknown", "role": "lead", "confidence": 0.1}]}, []),
        ({"main_instruments": [{"name": "piano", "role": "lead", "confidence": 0.55}]}, []),
        ({"caption_variants": GOOD["caption_variants"][:3]}, ["caption_variant_types"]),
        ({"canonical_caption": CAPTION + " more"}, ["full_variant_must_equal_canonical"]),
        ({"canonical_caption": "Soft words"}, ["canonical_caption_not_instrumental", "canonical_caption_word_count:2", "full_variant_must_equal_canonical"]),
        ({"caption_variants": [{"type": t, "text": CAPTION if t == "full" else "A Masterpiece at 128 BPM by Some One"} for t in annotation.VARIANTS]}, ["artist_name_in_caption", "banned_hype_or_style_phrase", "bpm_leaked_into_caption"]),
        ({"annotation_confidence": 1.5}, ["invalid_annotation_confidence"]),
    ],
)
def test_annotation_errors(spark, change, codes):
    rows = spark.createDataFrame([(json.dumps(GOOD | change), "Some One feat. Al")], "j string, artist string").select(F.from_json("j", annotation.RESULT).alias("r"), "artist")
    assert rows.select(annotation.errors(F.col("r"), F.col("artist"), TAXONOMY)).first()[0] == codes


def test_prompt_holds_metadata_and_features(spark):
    mir = F.struct(F.lit(120).alias("bpm"), F.lit("A minor").alias("keyscale"), F.lit(None).cast("double").alias("key_confidence"), F.lit("4").alias("timesignature"), F.lit(None).cast("array<struct<label:string,raw_label:string,start:double,end:double>>").alias("sections"))
    text = spark.range(1).select(annotation.prompt("Listen.", json.dumps(TAXONOMY), F.lit("é"), F.lit(None).cast("string"), F.lit(""), F.lit("original"), F.lit(None).cast("string"), F.lit(0.0), F.lit(30.5), mir)).first()[0]
    first, metadata, found, taxonomy = text.split("\n")
    assert first == "Listen." and json.loads(taxonomy.removeprefix("Taxonomy: ")) == TAXONOMY
    assert json.loads(metadata.removeprefix("Metadata: ")) == {"title_for_identity_only": "é", "artist_for_identity_only_do_not_copy_to_captions": "", "version": "", "audio_source": "original", "vocal_status": "instrumental", "annotation_window_seconds": [0.0, 30.5]}
    assert json.loads(found.removeprefix("MIR: ")) == {"bpm": 120, "keyscale": "A minor", "key_confidence": None, "timesignature": "4", "sections": []}


class Classifier:
    """Writes a file for each call, so that calls on any worker are counted."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self, row):
        n = len([f for f in os.listdir(self.folder) if f.startswith(row["sample_id"] + ".")])
        open(os.path.join(self.folder, f"{row['sample_id']}.{n}"), "w").close()
        if row["sample_id"] == "refused":
            raise adapters.Rejected(403, "no")
        if row["sample_id"] == "busy" and n == 0:
            raise adapters.Rejected(429, "later")
        return {"vocal_status": "lyrics", "recommended_action": "keep_original" if row["sample_id"] == "odd" else "separate_vocals", "lyrics_prominence": 0.4, "reason": "sung"}


def test_classify_goes_on_where_it_stopped(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    calls = lambda: sorted(f.name for f in (tmp_path / "calls").iterdir())
    audio = spark.createDataFrame([("a", True), ("busy", True), ("odd", True), ("refused", True), ("bad", False), ("none", None)], "sample_id string, audio_valid boolean")
    factory = lambda: Classifier(str(tmp_path / "calls"))
    run = lambda done=None, limit=None: stages.kept(stages.classify(audio, factory, f"file://{tmp_path}/k", done, limit, 3, no_sleep), f"file://{tmp_path}/k")
    out = run()
    got = {r["sample_id"]: (r["classification_status"], r["vocal_status"], r["classification_error"], r["classification_attempts"]) for r in out.collect()}
    assert got == {"a": ("complete", "lyrics", None, 1), "busy": ("complete", "lyrics", None, 2), "odd": ("failed", None, "validation:inconsistent_action", 3), "refused": ("failed", None, "403 no", 1)}
    assert calls() == ["a.0", "busy.0", "busy.1", "odd.0", "odd.1", "odd.2", "refused.0"]
    again = run(out)
    assert again.count() == 4 and "a.1" not in calls() and "busy.2" not in calls() and "odd.5" in calls()
    assert {r["sample_id"] for r in run(None, 1).collect()} == {"a"}


class Annotator:
    def __init__(self, effort):
        self.effort = effort

    def __call__(self, row):
        assert row["prompt"].startswith("Listen.\nMetadata: ")
        if self.effort == "minimal" and row["sample_id"] != "a":
            return GOOD | {"annotation_confidence": 0.5}
        return GOOD | ({"primary_genre": "polka"} if row["sample_id"] == "c" else {})


def mir_of(spark, ids, downbeats=()):
    sections = F.array(F.struct(F.lit("Drop").alias("label"), F.lit("chorus").alias("raw_label"), F.lit(100.0).alias("start"), F.lit(200.0).alias("end")))
    return spark.createDataFrame([(i,) for i in ids], "sample_id string").select("sample_id", F.lit("complete").alias("analysis_status"), F.lit(120).alias("bpm"), F.lit("").alias("keyscale"), F.lit(0.4).alias("key_confidence"), F.lit("4").alias("timesignature"), F.array(*map(F.lit, downbeats)).cast("array<double>").alias("downbeats"), sections.alias("sections"))


def test_annotate_escalates(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"k{i}", "Some One", d, "accepted") for i, d in (("a", 100.0), ("b", 100.0), ("c", 100.0), ("long", 900.0), ("bare", 100.0))] + [("out", "k", "x", 100.0, "pending")], "sample_id string, record_key string, expected_artist string, duration double, quality_status string")
    tiers = [lambda: Annotator("minimal"), lambda: Annotator("low")]
    out = stages.annotate(rows, mir_of(spark, ["a", "b", "c", "long", "out"]), TAXONOMY, tiers, f"file://{tmp_path}/k", "Listen.", attempts=2, sleep=no_sleep)
    got = {r["sample_id"]: (r["annotation_status"], r["annotation_error"], r["annotation_reasoning_effort"]) for r in out.collect()}
    assert got == {"a": ("accepted", None, "minimal"), "b": ("accepted", None, "low"), "c": ("manual_review", "validation:invalid_primary_genre", "low"), "long": ("manual_review", "no_valid_downbeat_window", None), "bare": ("manual_review", "mir_missing", None)}
    review = {r["sample_id"]: r.asDict() for r in stages.for_review(out).collect()}
    assert set(review) == {"c", "long", "bare"} and review["bare"] == {"sample_id": "bare", "record_key": "kbare", "expected_title": "", "expected_artist": "Some One", "review_reason": "mir_missing"}
    more = stages.annotate(rows, mir_of(spark, ["a", "b", "c", "long", "bare"]), TAXONOMY, tiers, f"file://{tmp_path}/k", "Listen.", done=stages.kept(out, f"file://{tmp_path}/k"), attempts=1, sleep=no_sleep)
    assert {r["sample_id"] for r in more.where("annotation_status = 'accepted'").collect()} == {"a", "b", "bare"} and more.count() == 5


class Renderer:
    def __call__(self, row):
        if row["sample_id"] == "broken":
            raise RuntimeError("trim_failed")
        return {"duration": 20.0 if row["sample_id"] == "short" else row["trim_end"] - row["trim_start"], "sample_rate": 48000, "channels": 2}


def test_build(spark, tmp_path):
    ids = [("a", 100.0), ("b", 100.0), ("c", 60.0), ("d", 300.0), ("short", 50.0), ("broken", 50.0), ("nobeat", 500.0)]
    training = spark.createDataFrame([(i, f"k{i}", d, "accepted", "same" if i in "ab" else None, "" if i == "c" else None) for i, d in ids], "sample_id string, record_key string, duration double, quality_status string, raw_path string, video_id string")
    annotated = training.select("sample_id", F.lit("accepted").alias("annotation_status"), F.from_json(F.lit(json.dumps(GOOD)), annotation.RESULT).alias("annotation"))
    mir = mir_of(spark, ["a", "b", "c", "short", "broken", "nobeat"]).unionByName(mir_of(spark, ["d"], [0.0, 50.0, 120.0, 250.0]))
    assert stages.preflight(training, annotated.where("sample_id <> 'a'"), mir.where("sample_id <> 'b'")).collect() and stages.preflight(training, annotated, mir).count() == 0
    out = stages.build(training, annotated, mir, Renderer, f"file://{tmp_path}/k", ratio=0.3)
    rows = {r["sample_id"]: r for r in out.records.collect()}
    assert set(rows) == {"a", "b", "c", "d"} and rows["a"]["split"] == rows["b"]["split"]
    assert (rows["d"]["trim_start"], rows["d"]["trim_end"], rows["d"]["trimmed"], rows["d"]["lyrics"]) == (50.0, 250.0, True, "[Drop]\n[Instrumental]\n")
    assert rows["a"]["lyrics"] == "[Instrumental]\n" and not rows["a"]["trimmed"]
    assert json.loads(rows["a"]["document"]) == {"caption": CAPTION, "caption_variants": [CAPTION, "composition", "production", "tags"], "language": "instrumental", "master_annotation": GOOD, "bpm": 120, "timesignature": "4"}
    assert rows["d"]["final_json_path"] == f"data/final_dataset/{rows['d']['split']}/d.json" and rows["d"]["final_audio_path"].endswith("/d.flac") and rows["d"]["final_lyrics_path"].endswith("/d.lyrics.txt")
    assert {r["sample_id"]: r["reason"] for r in out.errors.collect()} == {"short": "output_duration_invalid:20.0", "broken": "RuntimeError: trim_failed", "nobeat": "overlength_audio_has_no_downbeats"}
    assert all((r["part"] is None) == (r["split"] == "validation") for r in rows.values())
    report = out.report.first()
    assert (report["status"], report["input_records"], report["validated_records"], report["shared_audio_records_preserved"], report["n_errors"], report["trimmed_records"]) == ("failed", 7, 4, 5, 3, 1)  # five samples name no audio
    assert report["part0_hours"] == round(sum(r["final_duration"] for r in rows.values() if r["part"] == 0) / 3600, 3)


def test_build_waits_for_all(spark, tmp_path):
    training = spark.createDataFrame([(i, f"k{i}", 100.0, "accepted") for i in "abc"], "sample_id string, record_key string, duration double, quality_status string")
    annotated = training.select("sample_id", F.lit("accepted").alias("annotation_status"), F.from_json(F.lit(json.dumps(GOOD)), annotation.RESULT).alias("annotation"))
    out = stages.build(training, annotated.where("sample_id <> 'b'"), mir_of(spark, ["a", "b"]), Renderer, f"file://{tmp_path}/k")
    assert {tuple(r) for r in out.errors.collect()} == {("b", "kb", "annotation_missing"), ("c", "kc", "mir_missing")} and out.records.count() == 0
    report = out.report.first()
    assert (report["status"], report["n_errors"], report["input_records"], report["validated_records"]) == ("preflight_failed", 2, 3, 0)


def test_question_holds_what_is_known(spark):
    row = spark.createDataFrame([("a", 'é "x"', None)], "sample_id string, t string, a string")
    text = row.select(annotation.question("Listen.", F.col("sample_id"), F.col("t"), F.col("a"), F.lit("mix"))).first()[0]
    head, known = text.split(" Metadata: ")
    assert head == "Listen." and json.loads(known) == {"sample_id": "a", "expected_title": 'é "x"', "expected_artist": "", "expected_version": "mix"}


class Busy:
    """Refuses each row of its list as often as it says, and writes when it was called."""

    def __init__(self, folder, times, lost=False):
        self.folder, self.times, self.lost = folder, times, lost

    def __call__(self, row):
        sid = row["sample_id"]
        assert json.loads(row["prompt"].removeprefix(" Metadata: "))["sample_id"] == sid
        n = len([f for f in os.listdir(self.folder) if f.startswith(sid + ".")])
        open(os.path.join(self.folder, f"{sid}.{n}"), "w").close()
        if n < self.times.get(sid, 0):
            raise adapters.Rejected(429, "later")
        return {"vocal_status": "lyrics", "recommended_action": "separate_vocals", "lyrics_prominence": 0.4, "reason": "sung", "usage": {"tokens": 7}}


def test_pauses_last_over_rounds_and_restarts(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    audio = spark.createDataFrame([("a", True), ("b", True), ("c", True)], "sample_id string, audio_valid boolean")
    clock, slept = [1000.0], []

    def sleep(seconds):
        slept.append(seconds)
        clock[0] += seconds

    class Lost(Exception):
        pass

    def lose(seconds):
        raise Lost

    factory = lambda: Busy(str(tmp_path / "calls"), {"b": 3, "c": 9})
    run = lambda how: stages.classify(audio, factory, f"file://{tmp_path}/k", attempts=5, sleep=how, model="m", clock=lambda: clock[0], calls=2)
    with pytest.raises(Lost):
        run(lose)  # the driver is lost in the first pause
    assert sorted(os.listdir(tmp_path / "calls")) == ["a.0", "b.0", "c.0"]
    clock[0] += 0.5
    rows = {r["sample_id"]: r for r in run(sleep).collect()}
    assert (rows["a"]["classification_attempts"], rows["b"]["classification_attempts"], rows["c"]["classification_attempts"]) == (1, 4, 5)
    assert rows["c"]["classification_error"] == "429 later" and rows["b"]["classification_status"] == "complete" and json.loads(rows["a"]["classification_usage"]) == {"tokens": 7}
    assert sorted(os.listdir(tmp_path / "calls")) == ["a.0", *(f"b.{i}" for i in range(4)), *(f"c.{i}" for i in range(5))]
    assert rows["a"]["classified_at"] == "1970-01-01T00:16:40.000000+00:00" and rows["a"]["classification_model"] == "m" and rows["c"]["classified_at"] > rows["b"]["classified_at"]
    # pauses of 2, 4, 8, 16 seconds and a fraction each, half a second of the first went by before the restart
    assert 29.5 <= sum(slept) <= 34 and 1.5 <= slept[0] < 2.5
    with pytest.raises(Lost):
        run(lose)
    assert "a.1" in os.listdir(tmp_path / "calls")  # the run before ended, so this one began anew


def test_selection(spark):
    vocal = spark.createDataFrame([("o", "instrumental", "failed"), ("f", "lyrics", "complete"), ("w", "lyrics", "complete"), ("u", "uncertain", "complete"), ("n", None, "failed")], "sample_id string, vocal_status string, classification_status string").withColumns({"duration": F.lit(9.0), "canonical_path": F.concat(F.lit("/"), "sample_id")})
    # of two checks the last counts; a failed recheck without a status still says that the sample was separated
    full = spark.createDataFrame([("f", "complete", "lyrics", "1"), ("f", "complete", "instrumental", "2"), ("w", "failed", None, "1")], "sample_id string, classification_status string, vocal_status string, classified_at string")
    none = spark.createDataFrame([], "sample_id string, classification_status string, vocal_status string")
    search = spark.createDataFrame([], "sample_id string, search_status string")
    rows = {r["sample_id"]: r for r in curation.select(vocal, full, none, search).collect()}
    assert len(rows) == 5
    assert {i: (r["audio_source"], r["pending_reason"]) for i, r in rows.items()} == {"o": ("original", None), "f": ("separated_full", None), "w": ("pending", "needs_clean_separation"), "u": ("pending", "vocal_check_incomplete"), "n": ("pending", "vocal_check_incomplete")}
    assert {i for i, r in rows.items() if r["clean_target"]} == {"w"} and rows["f"]["separator_preset"] == "instrumental_full"


def test_separated_manifest_and_sections(spark):
    manifest = spark.createDataFrame([("a", "lyrics", "/a", 10.0), ("b", "lyrics", "/b", 10.0), ("c", "instrumental", "/c", 10.0)], "sample_id string, vocal_status string, canonical_path string, duration double")
    parts = spark.createDataFrame([("a", "complete", "/sa"), ("b", "failed", None)], "sample_id string, separation_status string, separated_path string").withColumns({"preview_path": F.lit("p"), "duration": F.lit(9.9), "sample_rate": F.lit(48000), "channels": F.lit(2)})
    rows, missing = curation.separated(manifest, parts, "instrumental_full")
    assert [(r["sample_id"], r["canonical_path"], r["original_canonical_path"], r["duration"]) for r in rows.collect()] == [("a", "/sa", "/a", 9.9)]
    assert [r[0] for r in missing.collect()] == ["b"]
    chunks = spark.createDataFrame([("a", 0.0, 30.0, "complete", "instrumental"), ("a", 25.0, 80.12345, "complete", "vocal_chops"), ("a", 75.0, 100.0, "complete", "lyrics"), ("b", 0.0, 30.0, "failed", None)], "sample_id string, chunk_start double, chunk_end double, classification_status string, vocal_status string")
    beats = spark.createDataFrame([("a", [1.23456, 74.99999])], "sample_id string, beats array<double>")
    got = {r["sample_id"]: (r["section_start"], r["section_end"], r["search_status"]) for r in curation.sections(chunks, beats).collect()}
    assert got == {"a": (1.235, 75.0, "accepted"), "b": (None, None, "rejected")}


def test_identity_override_is_one_literal():
    assert curation.OVERRIDE == "user_override_identity:"


def test_merge(spark):
    stems = lambda *s: spark.createDataFrame([(x,) for x in s], "stem string")
    found, report = stages.merge({0: stems("a", "b"), 1: stems("b", "c")}, {0: stems("a", "x"), 1: stems("b", "c")})
    assert sorted(map(tuple, found.collect())) == [(0, "b", "collision"), (0, "b", "missing"), (0, "x", "extra")] and report.first()["status"] == "failed"
    assert stages.merge({0: stems("a"), 1: stems("b")}, {0: stems("a"), 1: stems("b")})[1].first()["status"] == "pass"


def test_folds_keep_rows_as_they_are(spark):
    df = spark.createDataFrame([("g", 5.5, "x"), ("g", 5.5, "x"), ("g", 1.0, "y"), (None, 2.0, "z"), ("g", None, "w")], "grp string, w double, name string")
    rows = folds.balanced(df, ["grp"], "w", "name").collect()
    assert sorted(map(str, ((r["grp"], r["w"], r["name"]) for r in rows))) == sorted(map(str, df.collect())) or len(rows) == 5
    assert sorted(r["part"] for r in rows if r["name"] == "x") == [0, 1] and [r["part"] for r in rows if r["grp"] is None] == [0]
    split = folds.group_split(df.withColumns({"raw_path": F.lit(None).cast("string"), "video_id": F.lit("")}), ["raw_path", "video_id", "name"], 0.4).collect()
    assert len(split) == 5 and all(r["split"] in ("train", "validation") for r in split) and len({r["split"] for r in split if r["name"] == "x"}) == 1
    assert {r["split"] for r in folds.group_split(df, "grp", 1.0).collect()} == {"validation"}
    for bad in (lambda: folds.tracked(df, ["grp"], "w", "w", every=0), lambda: folds.tracked(df, ["grp"], "w", "w", patience=-1), lambda: folds.group_split(df, "grp", 1.5), lambda: folds.balanced(df, ["grp"], "w", "name", 0)):
        with pytest.raises(ValueError, match="must be"):
            bad()


def test_tracker_goes_on_from_its_state(spark):
    losses = [5.0, 4.0, 4.5, None, 3.0, 3.1, 3.2, 2.999999999]
    df = spark.createDataFrame([("r", i, x) for i, x in enumerate(losses)] + [(None, 0, 1.0)], "run string, step int, loss double")
    whole = {(r["run"], r["step"]): tuple(r) for r in folds.tracked(df, ["run"], "step", "loss", patience=2).collect()}
    assert [whole["r", i][3:] for i in range(8)] == [(5.0, 0, 0, False), (4.0, 1, 0, False), (4.0, 1, 1, False), (4.0, 1, 2, True), (3.0, 4, 0, False), (3.0, 4, 1, False), (3.0, 4, 2, True), (3.0, 4, 3, True)]
    first = folds.tracked(df.where("step < 3"), ["run"], "step", "loss", patience=2)
    state = first.where("step = 2 OR run IS NULL")
    rest = {(r["run"], r["step"]): tuple(r) for r in folds.tracked(df.where("step >= 3"), ["run"], "step", "loss", patience=2, state=state).collect()}
    assert rest == {k: v for k, v in whole.items() if k[1] >= 3}


TOLD = "sample_id string, result string, error string"


def test_probes_and_logs(spark):
    stream = {"codec_type": "audio", "codec_name": "flac", "sample_rate": "48000", "channels": 2}
    rows = [("good", json.dumps({"format": {"duration": "12.5"}, "streams": [{"codec_type": "video"}, stream, stream | {"codec_name": "mp3"}]}), None), ("mute", json.dumps({"format": {"duration": "N/A"}, "streams": []}), None), ("odd", "{", None), ("gone", None, "no such file"), ("none", None, None)]
    got = {r["sample_id"]: (r["duration"], r["has_audio"], r["codec"], r["sample_rate"], r["channels"], r["probe_error"]) for r in media.probed(spark.createDataFrame(rows, TOLD)).collect()}
    assert got == {"good": (12.5, True, "flac", 48000, 2, None), "mute": (0.0, False, None, 0, 0, None), "odd": (0.0, False, None, 0, 0, "probe_failed:no JSON"), "gone": (0.0, False, None, 0, 0, "probe_failed:no such file"), "none": (0.0, False, None, 0, 0, "probe_failed:no JSON")}
    logs = spark.createDataFrame([("a", "x silence_duration: 2.5\ny silence_duration: 3 z", None, 11.0), ("b", "", None, 0.0), ("c", None, "broken", 4.0)], TOLD + ", duration double")
    assert {r["sample_id"]: (r["silence_ratio"], r["decode_error"]) for r in media.silent(logs).collect()} == {"a": (0.5, None), "b": (None, None), "c": (None, "full_decode_failed:broken")}
    assert adapters.run(["python", "-c", "print('x')"]) == (True, "x\n") and adapters.run(["python", "-c", "import sys; sys.exit('a\\nb')"])[1].startswith("a b") and not adapters.run(["no-such-program"])[0]


def test_answers_of_models(spark):
    targets = spark.createDataFrame([("a", 10.0), ("b", 20.0), ("c", 1.0), ("d", 1.0)], "sample_id string, duration double")
    answer = lambda i: json.dumps({"separated_path": f"/s/{i}", "preview_path": "p", "duration": 10.5, "sample_rate": 48000, "channels": 2})
    told = spark.createDataFrame([("a", answer("a"), None), ("b", answer("b"), None), ("c", None, "RuntimeError: no")], TOLD)
    found = {r["sample_id"]: (r["separation_status"], r["separation_error"], r["separated_path"]) for r in media.separated(targets, told, "full").collect()}
    assert found == {"a": ("complete", None, "/s/a"), "b": ("failed", "duration_mismatch", "/s/b"), "c": ("failed", "RuntimeError: no", None), "d": ("failed", "no_answer", None)}
    heard = {"bpm": 127.9, "key": "A", "scale": "minor", "strength": 0.651234567, "beats": [0.12345], "downbeats": [1.0, 2.0, 3.0, 4.0], "beat_positions": [1, 2, 3, 4] * 4, "segments": [{"label": n, "start": 0.0, "end": 1.23456} for n in ("start", "chorus", "Chorus", "chorus")]}
    rows = {r["sample_id"]: r for r in media.analysed(spark.createDataFrame([("a", json.dumps(heard), None), ("fast", json.dumps(heard | {"bpm": 300.0}), None), ("bad", None, "RuntimeError: no beats")], TOLD)).collect()}
    assert (rows["a"]["bpm"], rows["a"]["keyscale"], rows["a"]["key_confidence"], rows["a"]["timesignature"], rows["a"]["beats"]) == (127, "A minor", 0.651235, "4", [0.123])
    assert [s["label"] for s in rows["a"]["sections"]] == ["Intro", "Drop", "Theme", "Final Drop"] and rows["a"]["sections"][1]["end"] == 1.235
    assert rows["fast"]["bpm"] is None and rows["bad"]["analysis_status"] == "failed"


@pytest.mark.parametrize("anchors", [1 << 20, 0])
def test_containment_by_brute_force(spark, monkeypatch, anchors):
    monkeypatch.setattr(contained, "ANCHORS", anchors)  # without room for anchors pairs meet without texts
    docs = [(1, "Alpha beta GAMMA, delta; epsilon"), (2, "beta gamma"), (3, "xbeta gammay delta epsilon"), (4, None), (5, ""), (6, "Alpha beta GAMMA, delta; epsilon"), (6, "beta gamma")]
    items = [(1, "beta gamma"), (2, "a gamma, delta; e"), (3, "delta"), (4, "gamma, Delta; epsilon"), (5, None), (6, "ammay delta eps"), (7, "beta GAMMA, delta"), (8, "gamma, delta; eps")]
    out = contained.contained(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string"), "doc_id", "item_id")
    assert sorted(map(tuple, out.collect())) == sorted((d, i) for d, t in docs for i, x in items if t is not None and x is not None and x.lower() in t.lower())


def test_ranks_and_next_times(spark):
    df = spark.createDataFrame([(k, n, i) for i, (k, n) in enumerate([("a", 5), ("a", 700), ("a", 5), (None, 1), (None, 999), ("a", None)])], "k string, n int, i int")
    got = {r["i"]: r["rank"] for r in intervals.ranked(df, ["k"], ["n", "i"], "rank").collect()}
    assert got == {5: 1, 0: 2, 2: 3, 1: 4, 3: 1, 4: 2}


def test_sinks_replace_as_a_whole(spark, tmp_path):
    path = f"file://{tmp_path}/rows"
    rows = spark.createDataFrame([(2, ("z", [(1, None)])), (1, None)], "b int, a struct<y:string,x:array<struct<q:int,p:int>>>")
    sinks.write_jsonl(rows, path, "b")
    lines = [x for f in sorted((tmp_path / "rows").glob("part-*")) for x in f.read_text().splitlines()]
    assert lines == ['{"a":null,"b":1}', '{"a":{"x":[{"p":null,"q":1}],"y":"z"},"b":2}']
    with pytest.raises(Exception, match="boom"):
        sinks.write_jsonl(rows.withColumn("b", F.raise_error(F.lit("boom")).cast("int")), path)
    sinks.write_jsonl(rows.limit(0), path)
    assert not [x for f in (tmp_path / "rows").glob("part-*") for x in f.read_text().splitlines()]
    sinks.write_csv(rows, f"file://{tmp_path}/csv", ["b"])
    assert {f.name for f in tmp_path.iterdir() if not f.name.startswith((".", "rows", "csv"))} == set()
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/csv").count() == 2


def test_links(tmp_path):
    (tmp_path / "src").mkdir()
    for sid in ("a", "b"):
        (tmp_path / "src" / f"{sid}.flac").write_text(sid)
    made = sinks.write_sidecars([{"sample_id": s, "document": "{}", "lyrics": "x\n"} for s in ("a", "b")], str(tmp_path / "src"))
    assert len(made) == 4
    out = tmp_path / "part0"
    assert sinks.linked_triplets(["a", "b"], str(tmp_path / "src"), str(out)) == []
    (out / "own.txt").write_text("stays")
    assert sinks.linked_triplets(["b"], str(tmp_path / "src"), str(out)) == ["a.flac", "a.json", "a.lyrics.txt"]
    assert sorted(os.listdir(out)) == ["b.flac", "b.json", "b.lyrics.txt", "own.txt"] and (out / "b.flac").read_text() == "b"


def test_sources(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"a": [1]}')
    (tmp_path / ".env").write_text("# x\nA = 1\nB=2=3\n\nbad\n")
    assert tables.read_config(str(tmp_path / "c.json")) == {"a": [1]}
    assert tables.read_settings(str(tmp_path / ".env"), {"A": "kept"}) == {"A": "kept", "B": "2=3"} and tables.read_settings(str(tmp_path / "none")) == {}
    got = spark.createDataFrame([(["# x", " A = 1", "B=2=3", "", "bad"],)], "v array<string>").select(tables.settings_of(F.col("v"))).first()[0]
    assert [tuple(x) for x in got] == [("A", "1"), ("B", "2=3")]
    index = spark.createDataFrame([([("a.flac",), ("b.c.flac",)],)], "samples array<struct<filename:string>>")
    assert sorted(r[0] for r in tables.expected_stems(index).collect()) == ["a", "b.c"]
    (tmp_path / "m.csv").write_text('a,b\n"x, ""y""",\n')
    assert [tuple(r) for r in tables.read_csv(spark, f"file://{tmp_path}/m.csv", ["a", "b"]).collect()] == [('x, "y"', None)]
    (tmp_path / "m.jsonl").write_text('{"a": 1}\n')
    assert tables.read_jsonl(spark, f"file://{tmp_path}/m.jsonl", "a int").first()["a"] == 1 and tables.read_jsonl(spark, f"file://{tmp_path}/no.jsonl", "a int").count() == 0
    assert tables.listing(spark, f"file://{tmp_path}/*.json*").count() == 2


def test_small_rules(spark):
    row = spark.range(1).select(
        keys.chunk_id(F.lit("s"), F.lit(7)).alias("chunk"), keys.stem(F.lit("/x/a.b.c")).alias("stem"), features.first_with(F.array(F.struct(F.lit("v").alias("k"), F.lit(1).alias("n")), F.struct(F.lit("a").alias("k"), F.lit(2).alias("n"))), "k", "a")["n"].alias("first"),
        features.section_labels(F.array(*map(F.lit, ("intro", "Chorus", "chorus", "unknown")))).alias("labels"), features.key_above(F.lit("A"), F.lit(""), F.lit(0.9), 0.65).alias("key"),
        features.collapse(F.array(*map(F.lit, "aabba"))).alias("runs"), variants.chosen(F.array().cast("array<string>"), F.lit("k"), F.lit(1)).alias("none"),
    ).first()
    assert (row["chunk"], row["stem"], row["first"], row["labels"], row["key"], row["runs"], row["none"]) == ("s__chunk007", "a", 2, ["Intro", "Theme", "Drop", "Theme"], None, ["a", "b", "a"], None)


def test_selected_variant_checks_its_input(spark):
    df = spark.range(1)
    one = lambda s, m, i: df.select(variants.selected(F.array(*map(F.lit, s)).cast("array<int>"), F.array(*map(F.lit, m)).cast("array<int>"), F.lit(i)).alias("v")).first()["v"]
    assert tuple(one([1, 2], [3, 4], 1)) == (2, 4)
    for s, m, i, said in (([1], [1, 2], 0, "differ in number"), ([], [], 0, "no variants"), ([1], [1], 1, "no variant at"), ([1], [1], -1, "no variant at")):
        with pytest.raises(Exception, match=said):
            one(s, m, i)


def test_gate_of_a_report(spark):
    assert stages.gate(spark.createDataFrame([("pass", 3)], "status string, n int")).ok and not stages.gate(spark.createDataFrame([("failed", 3)], "status string, n int")).ok

"""The stages that call adapters (classify, annotate, build) and those that take stock (merge, status).

A stage takes manifests and a folder in which it keeps what an adapter answered before anything branches, so nothing is asked twice. Given its own earlier result, it goes on with the samples that aren't done. Adapters are factories of clients (see operators/adapters.py); tests use fake ones.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import annotation, features, nulls
from tallyloom.operators import adapters, balance, folds, gates, intervals, resume
from tallyloom.plans.curation import consistent
from tallyloom.sources import sinks, versions

ANSWER = "vocal_status string, lyrics_prominence double, recommended_action string, reason string"


def kept(df: DataFrame, folder: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).parquet(sinks.write_manifest(df, folder))


#: What is kept of each row between rounds: how far it came, when it may be asked again and what it was last told.
SCHEDULE = "sample_id string, tier int, tried int, attempts int, not_before double, status string, error string, result string, asked_at double"


def asked(rows: DataFrame, tiers: list[Callable[[], adapters.Client]], judge: Callable[[DataFrame], Column], answer: str, folder: str, attempts: int = 5, sleep: Callable[[float], None] | None = None, clock: Callable[[], float] = time.time, calls: int | None = None, name: str = "asked") -> DataFrame:
    """rows (unique by sample_id) with answer (struct, null if there is none), error, tier (from 0), attempts and asked_at (seconds).

    Each tier of clients is asked up to attempts times for the rows that have no good answer yet; judge gives the codes of what is wrong with an answer (a column over the row and answer), none for a good one. Status codes that can't be retried end a tier for a row. Of bad answers the last is kept with its codes.

    A row is asked in rounds. After a failure that can be retried it rests for min(60, 2**n + a fraction of a) second(s), n being its attempts in the tier; others that are due are asked meanwhile, and no task waits. The schedule is a table (SCHEDULE, versions under folder), committed after each round: a run that was lost goes on with its answers, attempts and pauses. A run that ended leaves no schedule, so the next one begins anew. calls: the most rows that are asked at a time.
    """
    spark = rows.sparkSession
    log = versions.Versions(spark, f"{folder}/schedule-{name}")
    known = log.read()
    blank = {"tier": 0, "tried": 0, "attempts": 0, "not_before": 0.0, "status": "open", "error": None, "result": None, "asked_at": None}
    kinds = dict(x.split(" ") for x in SCHEDULE.split(", "))
    state = rows.select(F.col("sample_id").cast("string").alias("sample_id"))
    if known is not None and not known.where("status = 'open'").isEmpty():
        state = state.join(known, "sample_id", "left")
        state = state.select("sample_id", *(F.coalesce(F.col(c), F.lit(v)).cast(kinds[c]).alias(c) for c, v in blank.items()))
    else:
        state = state.select("sample_id", *(F.lit(v).cast(kinds[c]).alias(c) for c, v in blank.items()))
    at = log.commit(state)
    while True:
        state = log.read(at)
        first = state.where("status = 'open'").agg(F.min("not_before").alias("t"), F.collect_set("tier").alias("tiers")).first()
        if first["t"] is None:
            break
        now = clock()
        if first["t"] > now:
            (sleep or time.sleep)(first["t"] - now)
            now = max(clock(), first["t"])
        due = state.where((F.col("status") == "open") & (F.col("not_before") <= now))
        told = []
        for number in sorted(first["tiers"]):
            own = rows.join(due.where(F.col("tier") == number).select("sample_id"), "sample_id", "left_semi")
            told.append(adapters.adapted(own if calls is None else own.coalesce(calls), tiers[number], "sample_id", 1).select("sample_id", F.col("result").alias("_result"), F.col("error").alias("_error")))
        # answers are written before anything branches: a client is called once
        told = kept(reduce(DataFrame.unionByName, told), folder)
        both = rows.join(told, "sample_id").withColumn("answer", F.from_json("_result", answer))
        codes = both.select("sample_id", "_result", "_error", F.col("answer").isNotNull().alias("_there"), F.when(F.col("answer").isNotNull(), judge(both)).otherwise(F.array().cast("array<string>")).alias("_codes"))
        good = F.col("_there") & (F.size("_codes") == 0)
        error = F.when(F.col("_error").isNotNull(), F.col("_error")).when(~F.col("_there"), "answer_without_fields").when(~good, F.concat(F.lit("validation:"), F.array_join("_codes", ",")))
        final = F.coalesce(F.col("_error").rlike(r"^[0-9]{3}\b") & ~F.substring("_error", 1, 3).isin(*map(str, features.RETRYABLE)), F.lit(False))
        tried = F.col("tried") + 1
        up = final | (tried >= attempts)
        jitter = F.pmod(F.xxhash64("sample_id", "attempts"), F.lit(1000)) / 1000
        after = due.join(codes, "sample_id").select(
            "sample_id",
            F.when(~good & up & (F.col("tier") < len(tiers) - 1), F.col("tier") + 1).otherwise(F.col("tier")).cast("int").alias("tier"),
            F.when(up, 0).otherwise(tried).cast("int").alias("tried"),
            (F.col("attempts") + 1).cast("int").alias("attempts"),
            F.when(up, F.lit(float(now))).otherwise(now + features.backoff_seconds(tried, jitter)).alias("not_before"),
            F.when(good, "good").when(up & (F.col("tier") == len(tiers) - 1), "closed").otherwise("open").alias("status"),
            error.alias("error"),
            F.when(F.col("_there"), F.col("_result")).otherwise(F.col("result")).alias("result"),
            F.lit(float(now)).alias("asked_at"),
        )
        at = log.commit(resume.upsert(state, after, ["sample_id"]), at)
    out = kept(rows.join(log.read(at).select("sample_id", F.from_json("result", answer).alias("answer"), "error", "tier", "attempts", "asked_at"), "sample_id"), folder)
    log.clean(0)
    return out


def _instant(seconds: Column) -> Column:
    """Seconds as an ISO text in UTC."""
    return F.date_format(F.to_utc_timestamp(F.timestamp_micros((seconds * 1_000_000).cast("long")), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def classify(audio: DataFrame, factory: Callable[[], adapters.Client], folder: str, done: DataFrame | None = None, limit: int | None = None, attempts: int = 5, sleep: Callable[[float], None] | None = None, model: str = "", effort: str = "minimal", clock: Callable[[], float] = time.time, calls: int | None = None, instruction: str = "") -> DataFrame:
    """The classification manifest (with the model, its effort, the usage its answer tells and when it was asked): done, upserted with an answer or a failure for each valid sample of audio that isn't complete in done (the first limit by sample_id, if given). Run again with its own result, it asks for failures alone. The client sees the row with its prompt, the instruction and what is known of the sample."""
    todo = audio.where(nulls.truthy(F.col("audio_valid")))
    if done is not None:
        todo = resume.pending(todo, done.where("classification_status = 'complete'"), ["sample_id"])
    if limit is not None:
        todo = resume.first_n(todo, limit, "sample_id")
    judge = lambda df: consistent(df["answer.vocal_status"], df["answer.recommended_action"], df["answer.lyrics_prominence"], df["answer.reason"])
    text = lambda c: F.col(c) if c in todo.columns else F.lit("")
    ask = annotation.question(instruction, F.col("sample_id"), text("expected_title"), text("expected_artist"), text("expected_version"))
    out = asked(todo.drop("vocal_status", "lyrics_prominence", "recommended_action").withColumn("prompt", ask), [factory], judge, f"{ANSWER}, usage string", folder, attempts, sleep, clock, calls, "classify")
    failed = F.col("error").isNotNull()
    answers = {c: F.when(~failed, F.col(f"answer.{c}")) for c in ("vocal_status", "lyrics_prominence", "recommended_action", "reason")}
    out = out.withColumns(answers | {"classification_status": F.when(failed, "failed").otherwise("complete"), "classification_error": F.col("error"), "classification_attempts": F.col("attempts"), "classification_model": F.lit(model), "classification_reasoning_effort": F.lit(effort), "classification_usage": F.when(~failed, F.col("answer.usage")), "classified_at": _instant(F.col("asked_at"))}).drop("answer", "error", "tier", "attempts", "asked_at", "prompt")
    return out if done is None else resume.upsert(done, out, ["sample_id"])


#: Efforts an annotation is asked for, in turn; longest final audio in seconds.
EFFORTS, LONGEST = ("minimal", "low"), 240.0


def windowed(rows: DataFrame, mir: DataFrame, longest: float = LONGEST) -> DataFrame:
    """rows with the features mir (struct, null without any) and their window (struct start, end, rounded to 3 digits; null where an overlong sample has none)."""
    fields = [c for c in mir.columns if c != "sample_id"]
    both = rows.join(resume.latest(mir, ["sample_id"], *(F.col(c) for c in ("analysis_status",) if c in fields)).select("sample_id", F.struct(*fields).alias("mir")), "sample_id", "left")
    none = F.array().cast("array<struct<label:string,raw_label:string,start:double,end:double>>")
    best = intervals.best_window(F.col("duration"), F.coalesce("mir.downbeats", F.array().cast("array<double>")), F.coalesce("mir.sections", none), lambda label: features.lookup(features.WEIGHTS, label, 1.0), longest)
    both = both.withColumn("_best", best)
    window = F.when(F.col("_best.end").isNotNull(), F.struct(F.round("_best.start", 3).alias("start"), F.round("_best.end", 3).alias("end")))
    return both.withColumn("window", window).drop("_best")


def annotate(training: DataFrame, mir: DataFrame, taxonomy: dict[str, list[str]], tiers: list[Callable[[], adapters.Client]], folder: str, instruction: str = "", done: DataFrame | None = None, limit: int | None = None, attempts: int = 5, sleep: Callable[[float], None] | None = None, model: str = "", clock: Callable[[], float] = time.time, calls: int | None = None) -> DataFrame:
    """The annotation manifest (with the model, the usage its answer tells and when it was asked): done, upserted with an accepted annotation or a case for manual review for each accepted sample that isn't accepted in done. A tier's client sees the row with its prompt; a sample without features or window isn't asked for."""
    todo = training.where("quality_status = 'accepted'")
    if done is not None:
        todo = resume.pending(todo, done.where("annotation_status = 'accepted'"), ["sample_id"])
    if limit is not None:
        todo = resume.first_n(todo, limit, "sample_id")
    rows = windowed(todo, mir)
    text = lambda c: F.col(c) if c in rows.columns else F.lit("")
    rows = rows.withColumns({"annotation_window_start": F.col("window.start"), "annotation_window_end": F.col("window.end")})
    ask = annotation.prompt(instruction, json.dumps(taxonomy, ensure_ascii=False), text("expected_title"), text("expected_artist"), text("expected_version"), text("audio_source"), text("vocal_status_after_processing"), F.col("window.start"), F.col("window.end"), F.col("mir"))
    before = gates.first_failure([(F.col("mir").isNull(), "mir_missing"), (F.col("window").isNull(), "no_valid_downbeat_window")])
    rows = kept(rows.withColumn("_before", before).withColumn("prompt", F.when(before.isNull(), ask)).drop("mir", "window"), folder)
    artist = lambda df: df["expected_artist"] if "expected_artist" in df.columns else F.lit("")

    def judge(df: DataFrame) -> Column:
        codes = annotation.errors(df["answer"], artist(df), taxonomy)
        unsure = F.coalesce(df["answer.annotation_confidence"], F.lit(0.0)) < annotation.ACCEPTED
        return F.when((F.size(codes) == 0) & unsure, F.array(F.lit("low_confidence"))).otherwise(codes)

    out = asked(rows.where("_before IS NULL").drop("_before"), tiers, judge, f"{annotation.RESULT}, usage string", folder, attempts, sleep, clock, calls, "annotate").drop("prompt")
    effort = F.element_at(F.array(*(F.lit(EFFORTS[min(i, len(EFFORTS) - 1)]) for i in range(len(tiers)))), F.col("tier") + 1)
    out = out.withColumns({"annotation_status": F.when(F.col("error").isNull(), "accepted").otherwise("manual_review"), "annotation_error": F.col("error"), "annotation_reasoning_effort": effort, "annotation": F.col("answer").dropFields("usage"), "annotation_model": F.lit(model), "annotation_usage": F.col("answer.usage"), "annotated_at": _instant(F.col("asked_at"))}).drop("answer", "error", "tier", "attempts", "asked_at")
    stopped = rows.where("_before IS NOT NULL").withColumn("annotation_status", F.lit("manual_review")).withColumnRenamed("_before", "annotation_error").drop("prompt")
    out = out.unionByName(stopped, allowMissingColumns=True)
    return out if done is None else resume.upsert(done, out, ["sample_id"])


def for_review(annotated: DataFrame) -> DataFrame:
    """The rows of a manifest for manual review, all as text, missing values empty."""
    fields = ["sample_id", "record_key", "expected_title", "expected_artist", "review_reason"]
    rows = annotated.where(~nulls.is_in(F.col("annotation_status"), "accepted")).withColumn("review_reason", F.col("annotation_error"))
    return sinks.csv_rows(rows.select(*(F.col(c) if c in rows.columns else F.lit("").alias(c) for c in fields)), fields)


@dataclass(frozen=True)
class Build:
    """records: the samples that passed, with split, part (train only), window, document and lyrics; errors: sample_id, record_key, reason; report: one row of counts."""

    records: DataFrame
    errors: DataFrame
    report: DataFrame


def gate(report: DataFrame) -> gates.StageResult:
    """A report row with a status as what a stage gives to its caller."""
    return gates.result(report, F.col("status") == "pass")


def preflight(training: DataFrame, annotated: DataFrame, mir: DataFrame) -> DataFrame:
    """sample_id, reason of accepted samples that lack an annotation or features: none may be built before all have both."""
    rows = training.where("quality_status = 'accepted'").select("sample_id")
    for df, flag in ((annotated.where("annotation_status = 'accepted'"), "_a"), (mir, "_m")):
        rows = rows.join(df.select("sample_id").distinct().withColumn(flag, F.lit(True)), "sample_id", "left")
    return rows.select("sample_id", gates.first_failure([(F.col("_a").isNull(), "annotation_missing"), (F.col("_m").isNull(), "mir_missing")]).alias("reason")).where("reason IS NOT NULL")


def build(training: DataFrame, annotated: DataFrame, mir: DataFrame, render: Callable[[], adapters.Client], folder: str, longest: float = LONGEST, ratio: float = 0.15, seed: int = 42, root: str = "data/final_dataset") -> Build:
    """The final data set: windows, group-safe split, rendered audio, documents, lyrics and two balanced parts of the training split.

    render's client sees the row with trim_start and trim_end and gives duration, sample_rate and channels of the file that it wrote. Nothing is built before all accepted samples have an annotation and features: otherwise the errors are those of preflight(), there are no records, and the report's status is preflight_failed. final_audio_path, final_json_path and final_lyrics_path are where a sample's files belong, below root.
    """
    source = training.where("quality_status = 'accepted'")
    missing = kept(preflight(training, annotated, mir), folder)
    if not missing.isEmpty():
        none = source.limit(0).withColumns({"split": F.lit(""), "part": F.lit(0), "trimmed": F.lit(False), "final_duration": F.lit(0.0)})
        key = F.col("record_key") if "record_key" in source.columns else F.lit(None).cast("string")
        errors = missing.join(source.select("sample_id", key.alias("record_key")), "sample_id").select("sample_id", "record_key", "reason")
        return Build(none, errors, build_report(source, none, errors).withColumn("status", F.lit("preflight_failed")))
    groups = [c for c in ("raw_path", "video_id", "sample_id") if c in source.columns]
    rows = windowed(folds.group_split(source, groups, ratio, seed), mir, longest)
    rows = rows.join(annotated.where("annotation_status = 'accepted'").select("sample_id", "annotation"), "sample_id")
    rows = rows.withColumns({"trim_start": F.col("window.start"), "trim_end": F.col("window.end")}).drop("window")
    rows = kept(rows, folder)
    ready = rows.where("trim_end IS NOT NULL")
    told = adapters.adapted(ready.drop("mir", "annotation"), render, "sample_id", 1).select("sample_id", F.from_json("result", "duration double, sample_rate int, channels int").alias("out"), F.col("error").alias("_error"))
    both = rows.join(told, "sample_id", "left")
    length = F.col("out.duration")
    reason = gates.first_failure([
        (F.col("trim_end").isNull(), F.when(F.size("mir.downbeats") > 0, "no_valid_downbeat_window").otherwise("overlength_audio_has_no_downbeats")),
        (F.col("_error").isNotNull(), F.col("_error")),
        (~F.coalesce((F.col("out.sample_rate") == 48000) & (F.col("out.channels") == 2), F.lit(False)), F.lit("output_format_mismatch")),
        (~F.coalesce(length.between(30, longest + 0.1), F.lit(False)), F.concat(F.lit("output_duration_invalid:"), F.coalesce(length.cast("string"), F.lit("")))),
    ])
    labels = features.window_labels(F.coalesce("mir.sections", F.array().cast("array<struct<label:string,raw_label:string,start:double,end:double>>")), F.col("trim_start"), F.col("trim_end"))
    both = kept(both.withColumns({"reason": reason, "lyrics": features.lyrics(labels), "final_duration": F.round(length, 3), "trimmed": features.trimmed(F.col("trim_start"), F.col("trim_end"), F.col("duration"))}), folder)
    good = both.where("reason IS NULL")
    documents = sinks.sidecars(good.select("sample_id", F.col("annotation.canonical_caption").alias("caption"), F.col("annotation.caption_variants").alias("caption_variants"), F.lit("instrumental").alias("language"), F.col("annotation").alias("master_annotation"), *(F.col(f"mir.{c}").alias(c) for c in ("bpm", "keyscale", "timesignature"))))
    good = kept(good.join(documents, "sample_id"), folder)
    train = balance.balanced(good.where("split = 'train'").select("sample_id", "final_duration", F.lit(0).alias("_all")), ["_all"], "final_duration", "sample_id", 0.001).select("sample_id", "part")
    paths = {f"final_{kind}_path": F.concat(F.lit(f"{root.rstrip('/')}/"), F.col("split"), F.lit("/"), F.col("sample_id"), F.lit(ending)) for kind, ending in zip(("audio", "json", "lyrics"), sinks.TRIPLET, strict=True)}
    records = kept(good.join(train, "sample_id", "left").drop("out", "_error", "reason").withColumns(paths | {"validation_status": F.lit("pass")}), folder)
    key = F.col("record_key") if "record_key" in both.columns else F.lit(None).cast("string")
    errors = both.where("reason IS NOT NULL").select("sample_id", key.alias("record_key"), "reason")
    return Build(records, errors, build_report(source, records, errors))


def build_report(source: DataFrame, records: DataFrame, errors: DataFrame) -> DataFrame:
    """One row of the build's counts, its hours by part and its status: pass if every accepted sample is in it. Samples share their audio if they have the same raw_path, or without one the same video_id; all that have neither count as one group."""
    groups = [F.col(c).cast("string") for c in ("raw_path", "video_id") if c in source.columns]
    shared = source.groupBy((nulls.first_truthy(*groups) if groups else F.lit(None)).alias("g")).agg(F.count("*").alias("n"))
    one = F.lit(1).alias("one")
    hours = lambda p: F.round(F.coalesce(F.sum(F.when(F.col("part") == p, F.col("final_duration"))), F.lit(0.0)) / 3600, 3).alias(f"part{p}_hours")
    sides = [
        shared.agg(one, F.coalesce(F.sum("n"), F.lit(0)).alias("input_records"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("shared_audio_records_preserved")),
        records.agg(one, F.count("*").alias("validated_records"), F.count_if(F.col("split") == "train").alias("train_records"), F.count_if(F.col("split") == "validation").alias("validation_records"), F.count_if("trimmed").alias("trimmed_records"), *(F.count_if(F.col("part") == p).alias(f"part{p}_records") for p in (0, 1)), hours(0), hours(1)),
        errors.agg(one, F.count("*").alias("n_errors")),
    ]
    out = reduce(lambda a, b: a.join(b, "one"), sides).drop("one")
    ok = (F.col("n_errors") == 0) & (F.col("validated_records") == F.col("input_records"))
    return out.withColumns({"status": F.when(ok, "pass").otherwise("failed"), "test_records": F.lit(0), "deduplication_performed": F.lit(False)})


def merge(expected: dict[int, DataFrame], actual: dict[int, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(differences: part, stem, status missing, extra or collision; one row of counts with status) of the files of each part. expected, actual: part to stems (column stem)."""
    parts = [resume.reconciled(expected[p], actual[p], ["stem"]).where("status <> 'matched'").select(F.lit(p).alias("part"), "stem", "status") for p in expected]
    every = reduce(DataFrame.unionByName, [df.select("stem", F.lit(p).alias("part")).distinct() for p, df in expected.items()])
    twice = every.groupBy("stem").agg(F.min("part").alias("part"), F.count("*").alias("n")).where("n > 1").select("part", "stem", F.lit("collision").alias("status"))
    found = reduce(DataFrame.unionByName, [*parts, twice])
    counts = every.agg(F.lit(1).alias("one"), *(F.count_if(F.col("part") == p).alias(f"part{p}_expected") for p in expected), F.countDistinct("stem").alias("train_expected"))
    there = reduce(DataFrame.unionByName, [df.select("stem") for df in actual.values()]).agg(F.lit(1).alias("one"), F.countDistinct("stem").alias("merged_tensors"))
    wrong = found.agg(F.lit(1).alias("one"), F.count("*").alias("n_errors"))
    out = counts.join(there, "one").join(wrong, "one").drop("one")
    return found, out.withColumns({"status": F.when(F.col("n_errors") == 0, "pass").otherwise("failed"), "deduplication_performed": F.lit(False)})


def status(audio: DataFrame, vocal: DataFrame, training: DataFrame, rejected: DataFrame, mir: DataFrame, annotated: DataFrame, annotations: DataFrame, final: DataFrame, tensors: DataFrame) -> DataFrame:
    """One row: the size of each manifest, and counts by value as maps. annotations, final and tensors are listings."""

    def by(df: DataFrame, column: str, name: str) -> DataFrame:
        counts = gates.counted(df.select(F.col(column).cast("string").alias(column)), column)
        return counts.agg(F.lit(1).alias("one"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(column, "n_rows")))).alias(name))

    size = lambda df, name, *more: df.agg(F.lit(1).alias("one"), F.count("*").alias(name), *more)
    valid = nulls.truthy(F.col("audio_valid"))
    sides = [
        size(audio, "audio_records", F.count_if(valid).alias("audio_valid"), F.count_if(~valid).alias("audio_rejected"), F.lit(False).alias("deduplication_performed")),
        size(vocal, "vocal_records"), by(vocal, "vocal_status", "vocal_status"),
        size(training, "training_records"), by(training, "audio_source", "training_sources"),
        size(rejected, "training_rejected"),
        size(mir, "mir_files"), by(mir, "analysis_status", "mir_status"),
        size(annotated, "annotation_state_records"), by(annotated, "annotation_status", "annotation_status"),
        size(annotations, "annotation_files"), size(final, "final_audio"), size(tensors, "tensors"),
    ]
    return reduce(lambda a, b: a.join(b, "one"), sides).drop("one")

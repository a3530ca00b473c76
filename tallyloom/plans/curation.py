"""The curation rules: prepare, check answers, separate, choose sections, select. Each takes and returns manifests; the stages that call adapters are in stages.py."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import features, keys, nulls
from tallyloom.operators import gates, intervals, resume
from tallyloom.schemas import ACTIONS, DOWNLOADED, OVERRIDE


def prepare(checkpoint: DataFrame, selection: DataFrame, probes: DataFrame) -> DataFrame:
    """Every record with its metadata and the first gate it fails (reject_reason), if any.

    selection and probes are unique by record_key; probes has what the adapter found: file_exists, probe_error, has_audio, source_duration, encode_error, canonical_error, duration, sample_rate, channels, decode_error, silence_ratio, preview_error.
    """
    extra = selection.select("record_key", "expected_title", "expected_artist", "expected_version")
    rows = resume.enriched(resume.enriched(checkpoint, extra, ["record_key"]), probes, ["record_key"])
    d = F.col("source_duration")
    reason = F.coalesce(
        F.when(~nulls.is_in(F.col("status"), *DOWNLOADED), F.concat(F.lit("not_downloaded:"), F.coalesce("status", F.lit("")))),
        F.when(~nulls.truthy(F.col("file_exists")), F.lit("source_missing")),
        F.when(F.col("probe_error").isNotNull(), F.concat(F.lit("source_probe_failed:"), "probe_error")),
        F.when(~nulls.truthy(F.col("has_audio")), F.lit("no_audio_stream")),
        F.when(~F.coalesce(d.between(30, 600), F.lit(False)), F.concat(F.lit("source_duration_out_of_range:"), F.format_string("%.3f", F.coalesce(d, F.lit(0.0))))),
        F.when(F.col("encode_error").isNotNull(), F.concat(F.lit("canonicalize_failed:"), "encode_error")),
        F.when(F.col("canonical_error").isNotNull(), F.concat(F.lit("canonical_probe_failed:"), "canonical_error")),
        F.when((F.col("sample_rate") != 48000) | (F.col("channels") != 2), F.lit("canonical_format_mismatch")),
        F.when(F.abs(F.col("duration") - d) > 1.0, F.concat(F.lit("canonical_duration_mismatch:"), F.format_string("%.3f!=%.3f", "duration", d))),
        F.when(F.col("decode_error").isNotNull(), F.concat(F.lit("full_decode_failed:"), "decode_error")),
        F.when(F.col("silence_ratio") > 0.80, F.concat(F.lit("mostly_silence:"), F.format_string("%.4f", "silence_ratio"))),
        F.when(F.col("preview_error").isNotNull(), F.concat(F.lit("preview_failed:"), "preview_error")),
    )
    named = rows.withColumns({"sample_id": keys.sample_id(F.col("record_key")), "source_rank": nulls.int_or_zero(F.col("source_rank")), "reject_reason": reason, "user_identity_override": nulls.truthy(F.contains("reason", F.lit(OVERRIDE)))})
    return named.withColumn("audio_valid", F.col("reject_reason").isNull())


def consistent(status: Column, action: Column, prominence: Column, reason: Column) -> Column:
    """Sorted codes of what is wrong with a classifier's answer."""
    from tallyloom.functions.text_rules import error_codes

    known = nulls.is_in(status, *ACTIONS)
    return error_codes(
        (~known, "invalid_vocal_status"),
        (known & nulls.differs(action, features.lookup(ACTIONS, status, "")), "inconsistent_action"),
        (~F.coalesce(prominence.between(0, 1), F.lit(False)), "invalid_prominence"),
        (F.coalesce(F.trim(reason), F.lit("")) == "", "blank_reason"),
    )


def separated(manifest: DataFrame, parts: DataFrame, preset: str, targets: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(manifest rows of lyric samples with the separated file in place of their own; targets without one). targets: the samples that should have been separated (default: all lyric ones)."""
    lyric = manifest.where(nulls.is_in(F.col("vocal_status"), "lyrics"))
    own = parts.where("separation_status = 'complete'").select("sample_id", F.col("separated_path").alias("canonical_path"), "preview_path", "duration", "sample_rate", "channels", F.lit(preset).alias("separation_preset"))
    before = lyric.withColumns({"original_canonical_path": F.col("canonical_path"), "pre_separation_vocal_status": F.col("vocal_status")})
    return resume.merged(before, own, ["sample_id"]), resume.pending(targets if targets is not None else lyric, own, ["sample_id"]).select("sample_id")


def sections(chunks: DataFrame, beats: DataFrame, minimum: float = 50.0, most: float = 240.0) -> DataFrame:
    """sample_id, section_start, section_end, search_status of each sample of chunks (chunk_start, chunk_end, classification_status, vocal_status): the longest clean run, capped and moved to beats."""
    span = F.struct(F.col("chunk_start").alias("start"), F.col("chunk_end").alias("end"))
    clean = nulls.is_in(F.col("classification_status"), "complete") & nulls.is_in(F.col("vocal_status"), "instrumental", "vocal_chops")
    both = chunks.groupBy("sample_id").agg(F.collect_list(F.when(clean, span)).alias("good"), F.collect_list(F.when(~clean, span)).alias("bad"))
    runs = intervals.clean_runs(F.col("good"), F.col("bad"), minimum)
    best = F.array_max(F.transform(runs, lambda x: F.struct((x["end"] - x["start"]).alias("length"), (-x["start"]).alias("early"), x["start"].alias("start"), F.least(x["end"], x["start"] + most).alias("end"))))
    found = both.withColumn("best", best).join(beats.select("sample_id", "beats"), "sample_id", "left")
    at = features.snap(F.coalesce("beats", F.array().cast("array<double>")), F.col("best.start"))
    last = F.coalesce(F.array_max(F.filter("beats", lambda b: (b <= F.col("best.end")) & (b >= F.col("best.end") - 3.0))), F.col("best.end"))
    fits = last - at >= 45.0
    return found.select("sample_id", F.round(F.when(fits, at).otherwise(F.col("best.start")), 3).alias("section_start"), F.round(F.when(fits, last).otherwise(F.col("best.end")), 3).alias("section_end"), F.when(F.col("best").isNull(), "rejected").otherwise("accepted").alias("search_status"))


#: What the separators of the two passes are called, and that of a section cut from the second.
FULL, CLEAN, SECTION = "instrumental_full", "instrumental_clean", "instrumental_clean+checked_section"
GOOD = ("instrumental", "vocal_chops")


def _one_each(df: DataFrame, columns: dict[str, str], at: str | None, prefix: str) -> DataFrame:
    """sample_id, the columns named (null where df lacks them) with a prefix, and whether there is a row at all; of several rows of a sample the last by column at (if any), then by all columns."""
    order = [F.col(c) for c in ([at] if at and at in df.columns else [])] + [F.col(c) for c in sorted(columns) if c in df.columns]
    own = resume.latest(df, ["sample_id"], *order)
    return own.select("sample_id", *((F.col(c) if c in own.columns else F.lit(None)).cast(kind).alias(f"{prefix}_{c}") for c, kind in columns.items()), F.lit(True).alias(f"{prefix}_hit"))


def select(vocal: DataFrame, full: DataFrame, clean: DataFrame, search: DataFrame, files: DataFrame | None = None, at: str | None = "classified_at") -> DataFrame:
    """Each classified sample with its route: accepted (audio_source, training_audio_source_path, vocal_status_after_processing, separator_preset, duration), pending (pending_reason, and clean_target if it should be separated once more) or rejected (reject_reason). No row is dropped or merged.

    full, clean: checks of separated audio; search: results of the search for clean sections, with the section's file and status. Of several rows of a sample in one of them the last (by column at) counts. files: paths that exist (column path); a chosen source that isn't among them is pending.
    """
    check = {"classification_status": "string", "vocal_status": "string", "canonical_path": "string"}
    found = {"search_status": "string", "search_reason": "string", "section_start": "double", "section_end": "double", "canonical_path": "string", "vocal_status": "string", "duration": "double"}
    rows = vocal
    for prefix, df, columns in (("full", full, check), ("clean", clean, check), ("search", search, found)):
        rows = rows.join(_one_each(df, columns, at, prefix), "sample_id", "left")
    ok = lambda p: nulls.is_in(F.col(f"{p}_classification_status"), "complete") & nulls.is_in(F.col(f"{p}_vocal_status"), *GOOD)
    lyric = nulls.is_in(F.col("vocal_status"), "lyrics")
    arms = [
        (nulls.is_in(F.col("vocal_status"), *GOOD), "original"),
        (lyric & ok("full"), "separated_full"),
        (lyric & ok("clean"), "separated_clean"),
        (lyric & nulls.is_in(F.col("search_search_status"), "accepted"), "clean_section"),
        (lyric & nulls.is_in(F.col("clean_vocal_status"), "lyrics") & nulls.is_in(F.col("search_search_status"), "rejected"), "rejected"),
    ]
    out = gates.routed(rows, arms, "pending", "audio_source")
    source = F.col("audio_source")
    by = lambda original, full, clean, section: F.when(source == "original", original).when(source == "separated_full", full).when(source == "separated_clean", clean).when(source == "clean_section", section)
    own = F.col("canonical_path") if "canonical_path" in vocal.columns else F.lit(None).cast("string")
    out = out.withColumns({
        "training_audio_source_path": by(own, F.col("full_canonical_path"), F.col("clean_canonical_path"), F.col("search_canonical_path")),
        "vocal_status_after_processing": by(F.col("vocal_status"), F.col("full_vocal_status"), F.col("clean_vocal_status"), F.col("search_vocal_status")),
        "separator_preset": by(F.lit(None).cast("string"), F.lit(FULL), F.lit(CLEAN), F.lit(SECTION)),
    })
    missing = F.lit(False)
    if files is not None:
        there = files.select(F.col("path").alias("training_audio_source_path"), F.lit(True).alias("_there")).distinct()
        out = out.join(there, "training_audio_source_path", "left")
        missing = ~source.isin("pending", "rejected") & F.col("_there").isNull()
    waiting = F.when(lyric & nulls.truthy(F.col("full_hit")), "needs_clean_separation").otherwise("vocal_check_incomplete")
    section = F.coalesce("search_duration", F.col("search_section_end") - F.col("search_section_start"))
    out = out.withColumns({
        "pending_reason": F.when(source == "pending", waiting).when(missing, "selected_source_missing"),
        "quality_status": F.when(missing, "pending").when(source.isin("pending", "rejected"), source).otherwise("accepted"),
        "reject_reason": F.when(source == "rejected", "lyrics_remain_and_no_checked_clean_section"),
        "clean_target": (source == "pending") & lyric,
        "full_recheck_status": F.col("full_vocal_status"), "clean_recheck_status": F.col("clean_vocal_status"), "section_search_reason": F.col("search_search_reason"),
        "section_start": F.col("search_section_start"), "section_end": F.col("search_section_end"), "search_status": F.col("search_search_status"),
        "duration": F.when(source == "clean_section", section).otherwise(F.col("duration")),
    })
    return out.drop(*(c for c in out.columns if c == "_there" or c.startswith(("full_hit", "clean_hit", "search_")) and c != "search_status" or c in {f"{p}_{n}" for p in ("full", "clean") for n in check}))

"""Rules over annotations (structs as in RESULT), and the text that asks for one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions import text_rules

RESULT = "primary_genre string, secondary_genres array<string>, style_families array<string>, moods array<string>, main_instruments array<struct<name:string,role:string,confidence:double>>, canonical_caption string, caption_variants array<struct<type:string,text:string>>, annotation_confidence double"
#: Types of caption variants; least confidence in an instrument that is named, and in an annotation.
VARIANTS = ("composition", "full", "production", "tags")
NAMED, ACCEPTED = 0.55, 0.70


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def errors(result: Column, artist: Column, taxonomy: dict[str, list[str]]) -> Column:
    """Sorted codes of what is wrong with an annotation. taxonomy: allowed primary_genres, style_families, moods, instruments, instrument_roles. Missing lists are empty, a missing number is 0, missing text is empty."""
    own = lambda field, kind="string": F.coalesce(result[field], _none(kind))
    not_one = lambda value, allowed: ~F.coalesce(value.isin(*taxonomy[allowed]), F.lit(False))
    instruments = F.coalesce(result["main_instruments"], F.array().cast("array<struct<name:string,role:string,confidence:double>>"))
    variants = F.coalesce(result["caption_variants"], F.array().cast("array<struct<type:string,text:string>>"))
    caption = F.trim(F.coalesce(result["canonical_caption"], F.lit("")))
    count = text_rules.word_count(caption)
    whole = F.coalesce(F.trim(F.get(F.filter(variants, lambda v: v["type"] == "full"), F.lit(0))["text"]), F.lit(""))
    every = F.lower(F.array_join(F.concat(F.array(caption), F.transform(variants, lambda v: F.coalesce(v["text"], F.lit("")))), "\n"))
    confidence = F.coalesce(result["annotation_confidence"], F.lit(0.0))
    types = F.sort_array(F.transform(variants, lambda v: F.coalesce(v["type"], F.lit(""))))
    return text_rules.error_codes(
        (not_one(result["primary_genre"], "primary_genres"), "invalid_primary_genre"),
        (text_rules.outside(own("secondary_genres"), taxonomy["primary_genres"]), "invalid_secondary_genres"),
        (text_rules.outside(own("style_families"), taxonomy["style_families"]), "invalid_style_families"),
        (text_rules.outside(own("moods"), taxonomy["moods"]), "invalid_moods"),
        (F.exists(instruments, lambda i: not_one(i["name"], "instruments")), "invalid_instrument"),
        (F.exists(instruments, lambda i: not_one(i["role"], "instrument_roles")), "invalid_instrument_role"),
        (F.exists(instruments, lambda i: (F.coalesce(i["name"], F.lit("")) != "unknown") & (F.coalesce(i["confidence"], F.lit(0.0)) < NAMED)), "low_confidence_instrument"),
        (~count.between(40, 80), F.concat(F.lit("canonical_caption_word_count:"), count.cast("string"))),
        (types != F.array(*map(F.lit, VARIANTS)), "caption_variant_types"),
        (whole != caption, "full_variant_must_equal_canonical"),
        (text_rules.has_phrase(every, list(text_rules.HYPE)), "banned_hype_or_style_phrase"),
        (every.rlike(text_rules.BPM), "bpm_leaked_into_caption"),
        (F.exists(text_rules.names(F.coalesce(artist, F.lit(""))), lambda n: F.contains(every, n)), "artist_name_in_caption"),
        (~F.lower(caption).startswith("instrumental"), "canonical_caption_not_instrumental"),
        (~confidence.between(0, 1), "invalid_annotation_confidence"),
    )


def accepted(result: Column, codes: Column) -> Column:
    """Whether an annotation is there, is sure enough and has no errors."""
    return result.isNotNull() & (F.coalesce(result["annotation_confidence"], F.lit(0.0)) >= ACCEPTED) & (F.size(codes) == 0)


def prompt(instruction: str, taxonomy: str, title: Column, artist: Column, version: Column, source: Column, vocal_status: Column, start: Column, end: Column, mir: Column) -> Column:
    """The text of a request: the instruction and, a line each, metadata, features (struct with bpm, keyscale, key_confidence, timesignature, sections) and the taxonomy as JSON. Missing texts are empty; a missing vocal status is instrumental; missing features are null."""
    text = lambda c, missing="": F.coalesce(c, F.lit(missing))
    keep = {"ignoreNullFields": "false"}
    metadata = F.struct(text(title).alias("title_for_identity_only"), text(artist).alias("artist_for_identity_only_do_not_copy_to_captions"), text(version).alias("version"), text(source).alias("audio_source"), text(vocal_status, "instrumental").alias("vocal_status"), F.array(F.coalesce(start, F.lit(0.0)), end).alias("annotation_window_seconds"))
    features = F.struct(*(mir[c].alias(c) for c in ("bpm", "keyscale", "key_confidence", "timesignature")), F.coalesce(mir["sections"], F.array().cast("array<struct<label:string,raw_label:string,start:double,end:double>>")).alias("sections"))
    return F.concat(F.lit(instruction + "\nMetadata: "), F.to_json(metadata, keep), F.lit("\nMIR: "), F.to_json(features, keep), F.lit("\nTaxonomy: " + taxonomy))


def question(instruction: str, sample_id: Column, title: Column, artist: Column, version: Column) -> Column:
    """The text of a request to classify a sample: the instruction and what is known of it as JSON; missing texts are empty."""
    text = lambda c: F.coalesce(c, F.lit(""))
    known = F.struct(sample_id.alias("sample_id"), text(title).alias("expected_title"), text(artist).alias("expected_artist"), text(version).alias("expected_version"))
    return F.concat(F.lit(f"{instruction} Metadata: "), F.to_json(known))

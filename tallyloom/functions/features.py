"""Feature rules over numbers, arrays and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Raw section label to label, and the weight of each label in a window's score.
SECTIONS = {
    "intro": "Intro",
    "outro": "Outro",
    "break": "Break",
    "bridge": "Break",
    "inst": "Theme",
    "solo": "Theme",
    "verse": "Theme",
    "chorus": "Drop",
    "start": "Intro",
    "end": "Outro",
}
WEIGHTS = {"Final Drop": 5.0, "Drop": 4.0, "Build": 2.5, "Theme": 2.0, "Intro": 1.0, "Break": 1.0, "Outro": 1.0}


def lookup(values: dict, key: Column, default: object) -> Column:
    flat = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*flat), key), F.lit(default))


def section_labels(raw: Column) -> Column:
    """Labels of an array of raw section labels (as they are written: case counts; any other is a Theme); the last of two or more Drops is the Final Drop."""
    named = F.transform(raw, lambda r: lookup(SECTIONS, r, "Theme"))
    drops = F.size(F.filter(named, lambda v: v == "Drop"))
    last = F.size(named) - F.array_position(F.reverse(named), F.lit("Drop"))
    return F.transform(named, lambda v, i: F.when((drops >= 2) & (i == last), "Final Drop").otherwise(v))


def int_in_range(value: Column, low: int, high: int) -> Column:
    """The value without its fraction, or null outside low..high."""
    whole = value.try_cast("int")
    return F.when(whole.between(low, high), whole)


def time_signature(positions: Column, downbeats: Column) -> Column:
    """4 where at least 16 beat positions, nine tenths of them in 1..4 and none above 4, and 4 downbeats say so."""
    fine = F.size(F.filter(positions, lambda p: p.between(1, 4)))
    return F.when((F.size(positions) >= 16) & (F.size(downbeats) >= 4) & (fine >= 0.9 * F.size(positions)) & (F.array_max(positions) == 4), F.lit("4"))


def collapse(values: Column) -> Column:
    """Array without elements equal to the one before."""
    before = F.concat(F.array(F.lit(None).cast("string")), values)
    kept = F.filter(F.transform(values, lambda v, i: F.struct(v.alias("v"), ((i == 0) | ~v.eqNullSafe(F.get(before, i))).alias("new"))), lambda x: x["new"])
    return F.transform(kept, lambda x: x["v"])


def window_labels(sections: Column, start: Column, end: Column, least: float = 1.0) -> Column:
    """Labels of the sections (array of struct label, start, end) that the window covers by more than least seconds, of those that have a weight, without repeats in a row."""
    covered = F.filter(sections, lambda x: (F.least(end, x["end"]) - F.greatest(start, x["start"]) > least) & x["label"].isin(*WEIGHTS))
    return collapse(F.transform(covered, lambda x: x["label"]))


def trimmed(start: Column, end: Column, duration: Column, tolerance: float = 0.01) -> Column:
    """Whether a window is not the whole."""
    return F.coalesce((start > 0) | (end < duration - tolerance), F.lit(False))


def output_error(sample_rate: Column, channels: Column, duration: Column, expected: Column, decode_error: Column, tolerance: float = 1.0) -> Column:
    """What is wrong with a rendered file, the first of: no audio, another format, another length, a decoder's error; else null."""
    return (
        F.when(sample_rate.isNull() & channels.isNull(), "no_audio_stream")
        .when(~F.coalesce((sample_rate == 48000) & (channels == 2), F.lit(False)), "format_mismatch")
        .when(~F.coalesce(F.abs(duration - expected) <= tolerance, F.lit(False)), "duration_mismatch")
        .when(F.coalesce(decode_error, F.lit("")) != "", F.concat(F.lit("full_decode_failed:"), decode_error))
    )


def key_above(key: Column, scale: Column, strength: Column, threshold: float) -> Column:
    """Key and scale as one text if both are known and the estimate is at least as strong as the threshold; else null."""
    known = (F.coalesce(key, F.lit("")) != "") & (F.coalesce(scale, F.lit("")) != "") & (strength >= threshold)
    return F.when(known, F.concat_ws(" ", key, scale))


def lyrics(labels: Column) -> Column:
    """Section headers as text; no section is one instrumental."""
    body = F.array_join(F.transform(labels, lambda v: F.concat(F.lit("["), v, F.lit("]\n[Instrumental]"))), "\n\n")
    return F.concat(F.when(F.size(labels) > 0, body).otherwise("[Instrumental]"), F.lit("\n"))


def snap(beats: Column, at: Column, reach: float = 3.0) -> Column:
    """The first beat within reach after the time, else the time."""
    return F.coalesce(F.array_min(F.filter(beats, lambda b: b.between(at, at + reach))), at)


def backoff_seconds(attempt: Column, jitter: Column | float = 0.0) -> Column:
    """Pause before the next attempt: two to the power of attempts, and jitter, at most a minute."""
    return F.least(F.lit(60.0), F.pow(F.lit(2.0), attempt) + jitter)


RETRYABLE = (408, 409, 429, 500, 502, 503, 504)


def first_with(values: Column, field: str, value: str) -> Column:
    """First struct of an array whose field has the value, else null."""
    return F.get(F.filter(values, lambda s: s[field] == value), F.lit(0))


def silence_ratio(log: Column, pattern: str, duration: Column) -> Column:
    """Sum of the numbers that the pattern's first group finds, as a share of the duration, 1 at most; null without a duration."""
    found = F.transform(F.regexp_extract_all(log, F.lit(pattern), F.lit(1)), lambda v: v.try_cast("double"))
    return F.when(duration > 0, F.least(F.lit(1.0), F.aggregate(found, F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0))) / duration))

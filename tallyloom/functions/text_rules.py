"""Rules over texts: word counts, phrases, leaks, names, and lists of error codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Phrases that captions may not hold, where names are parted, and a tempo in a text.
HYPE = ("masterpiece", "best song ever", "professional quality", "extremely beautiful", "exactly like", "in the style of", "style of")
NAME_BREAK = r"(?i)\b(?:feat\.?|ft\.?|and)\b|[&,/+|]"
BPM = r"\b\d{2,3}\s*bpm\b"


def word_count(text: Column) -> Column:
    """Words of letters, digits, marks, _, - and ' of any script."""
    return F.regexp_count(text, F.lit(r"(?U)\b[\w'-]+\b"))


def has_phrase(text: Column, phrases: list[str]) -> Column:
    low = F.lower(text)
    return F.exists(F.array(*map(F.lit, phrases)), lambda p: F.contains(low, p))


def names(value: Column, strict: bool = False) -> Column:
    """Parts of a name list of 4 characters or more, blanks squeezed, lower case. strict also drops what is no letter or digit before a part."""
    kept = F.filter(F.split(value, NAME_BREAK), lambda v: F.length(F.trim(v)) >= 4)
    parts = F.transform(kept, lambda v: F.lower(F.trim(F.regexp_replace(v, r"\s+", " "))))
    return F.transform(parts, lambda v: F.regexp_replace(v, r"^[^\p{L}\p{N}]+", "")) if strict else parts


def error_codes(*rules: tuple[Column, str | Column]) -> Column:
    """Sorted, distinct codes of the rules that hold; a rule that is null doesn't hold."""
    codes = (F.when(holds, F.lit(code) if isinstance(code, str) else code) for holds, code in rules)
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*codes))))


def outside(values: Column, allowed: list[str]) -> Column:
    """Whether some element is not among those allowed."""
    return F.exists(values, lambda v: ~F.array_contains(F.array(*map(F.lit, allowed)), v))


def content_text(parts: Column, kinds: tuple[str, ...] = ("text", "output_text")) -> Column:
    """Text of the parts (array of struct kind, text) of the given kinds, joined."""
    return F.array_join(F.transform(F.filter(parts, lambda p: p["kind"].isin(*kinds)), lambda p: F.coalesce(p["text"], F.lit(""))), "")

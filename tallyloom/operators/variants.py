"""Variants of a sample: clean-up, choice per epoch, and encoding per variant."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.keys import hash_bucket

#: Buckets a sample and epoch are hashed into before the choice.
BUCKETS = 97


def prompts(variants: Column, fallback: Column) -> Column:
    """Trimmed variants that aren't blank; if none is left, the one caption."""
    kept = F.filter(F.transform(F.coalesce(variants, F.array().cast("array<string>")), lambda v: F.trim(v)), lambda v: v != "")
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(fallback))


def chosen(variants: Column, key: Column, epoch: Column, training: bool = True) -> Column:
    """The variant of a sample in an epoch: by a hash of both in training, always the first in validation. Null without variants."""
    at = F.pmod(hash_bucket(F.concat_ws("|", key.cast("string"), epoch.cast("string")), BUCKETS), F.nullif(F.size(variants), F.lit(0))).cast("int") if training else F.lit(0)
    return F.get(variants, at)


def pivoted(pairs: Column, order: tuple[str, ...]) -> Column:
    """Texts of an array of struct(type, text) in a fixed order of types, the first of each; null where there is none."""
    first = lambda kind: F.get(F.filter(pairs, lambda p: p["type"] == kind), F.lit(0))["text"]
    return F.array(*map(first, order))


def selected(states: Column, masks: Column, index: Column) -> Column:
    """struct(state, mask) of the variant at the index (from 0). Parallel arrays of different lengths, no variants and an index outside them are errors, as a wrong pairing would go unnoticed."""
    n = F.size(states)
    wrong = F.when(F.coalesce(n, F.lit(-1)) != F.coalesce(F.size(masks), F.lit(-1)), "states and masks differ in number").when(F.coalesce(n, F.lit(0)) <= 0, "no variants").when(~F.coalesce(index.between(F.lit(0), n - 1), F.lit(False)), "no variant at this index")
    return F.when(wrong.isNotNull(), F.raise_error(wrong)).otherwise(F.struct(F.get(states, index).alias("state"), F.get(masks, index).alias("mask")))

"""Text columns: cleaning, shingles, set similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shingle given to a document too short to have one, when such documents are kept.
EMPTY_SHINGLE = "special"


def clean_text(text: Column) -> Column:
    """Runs of characters that are no letter, digit or underscore become one space."""
    return F.lower(F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}_]+", " ")))


def ngrams(text: Column, k: int, drop_last: bool = False) -> Column:
    """All k-character substrings in order; ``drop_last`` leaves out the final one."""
    grams = F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{k}}}))."), F.lit(1))
    if drop_last:
        return F.slice(grams, F.lit(1), F.greatest(F.size(grams) - 1, F.lit(0)))
    return grams


def shingle_set(text: Column, k: int, drop_last: bool = False, keep_empty: bool = False) -> Column:
    """Distinct shingles of a text; ``keep_empty`` gives short texts one sentinel."""
    shingles = F.array_distinct(ngrams(text, k, drop_last))
    if keep_empty:
        return F.when(F.size(shingles) == 0, F.array(F.lit(EMPTY_SHINGLE))).otherwise(shingles)
    return shingles


def char_set(text: Column) -> Column:
    """Distinct characters of a text."""
    return F.array_distinct(F.when(F.length(text) > 0, F.split(text, "")).otherwise(F.array()))


def jaccard(a: Column, b: Column) -> Column:
    """|A ∩ B| / |A ∪ B| of two arrays without repeats; 0 when both are empty."""
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(both, F.size(a) + F.size(b) - both), F.lit(0.0))


def dot(a: Column, b: Column) -> Column:
    """Inner product of two number arrays of equal length."""
    products = F.zip_with(a, b, lambda p, q: p.cast("double") * q.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column, norm_a: Column, norm_b: Column) -> Column:
    """Cosine of the angle between two number arrays whose norms are given."""
    return F.try_divide(dot(a, b), norm_a * norm_b)


def band_probability(s: Column, r: Column, b: Column) -> Column:
    """Chance that two sets of similarity ``s`` share one of ``b`` bands of ``r`` values."""
    return 1 - F.pow(1 - F.pow(s, r), b)

"""Text-screening column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from deckmill import fixed_values as fv


WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
# Digits, blanks and word edges of any script count in the personal-data patterns.
ANY_SCRIPT = "(?U)"


def strip(text: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.trim(text, F.lit(WHITESPACE))


def keyword_hits(lowered: Column, keywords: Sequence[str]) -> Column:
    """Keywords contained in an already lower-cased text, in alphabetical order.

    One ``contains`` per keyword inside generated code. The caller lower-cases
    in a step of its own, so that long texts are lowered once.
    """
    found = [F.when(lowered.contains(k), k) for k in sorted(set(keywords))]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def keyword_line(lowered: Column, keywords: Sequence[str]) -> Column:
    """The same hits as one comma-joined text, without leaving generated code."""
    return F.concat_ws(", ", *[F.when(lowered.contains(k), k) for k in sorted(set(keywords))])


def contains_any(lowered: Column, keywords: Sequence[str]) -> Column:
    test = F.lit(False)
    for k in sorted(set(keywords)):
        test = test | lowered.contains(k)
    return test


def count_contained(lowered: Column, keywords: Sequence[str]) -> Column:
    total = F.lit(0)
    for k in sorted(set(keywords)):
        total = total + lowered.contains(k).cast("int")
    return total


def word_count(text: Column) -> Column:
    """Number of whitespace-separated tokens."""
    trimmed = F.regexp_replace(text, r"^[\s\x1c-\x1f\x85\xa0]+|[\s\x1c-\x1f\x85\xa0]+$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"[\s\x1c-\x1f\x85\xa0]+")))


def has_non_ascii(text: Column) -> Column:
    return F.rlike(text, F.lit(r"[^\x00-\x7F]"))


def looks_english(lowered: Column, markers: Sequence[str] = tuple(fv.ENGLISH_MARKERS),
                  max_unmarked_words: int = 5) -> Column:
    """A marker word passes; without one, only short pure-ASCII texts pass."""
    return contains_any(lowered, markers) | (
        ~has_non_ascii(lowered) & (word_count(lowered) <= max_unmarked_words))


def pattern_count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def email_count(text: Column) -> Column:
    """Addresses in the text. Texts without an at sign are not searched."""
    return F.when(F.contains(text, F.lit("@")), pattern_count(text, fv.EMAIL_PATTERN)).otherwise(F.lit(0))


def ssn_count(text: Column) -> Column:
    return F.when(F.rlike(text, F.lit(ANY_SCRIPT + r"\d-\d")), pattern_count(text, ANY_SCRIPT + fv.SSN_PATTERN)).otherwise(F.lit(0))


def phone_count(text: Column) -> Column:
    """Phone numbers. Every one holds three digits in a row, a far cheaper test."""
    return F.when(F.rlike(text, F.lit(ANY_SCRIPT + r"\d{3}")), pattern_count(text, ANY_SCRIPT + fv.PHONE_PATTERN)).otherwise(F.lit(0))


def bounded_concat(parts: Column, stop_after: int = 50_000) -> Column:
    """Concatenate array items, adding no more once the text exceeds ``stop_after``."""
    return F.aggregate(
        parts, F.lit(""),
        lambda acc, part: F.when(F.length(acc) > stop_after, acc).otherwise(F.concat(acc, part)))


def max_pattern_count(parts: Column, pattern: str) -> Column:
    return F.array_max(F.transform(parts, lambda p: F.regexp_count(p, F.lit(pattern))))

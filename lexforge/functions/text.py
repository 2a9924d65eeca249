"""Scalar functions on strings and arrays of strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode and the four separator controls have it.
SPACE = r"(?U)[\s\x1c-\x1f]+"
#: The signs that a token loses at its ends.
SIGNS = ".,!?;:()[]\"'"


def strip(x: Column) -> Column:
    return F.regexp_replace(x, rf"^{SPACE}|{SPACE}$", "")


def raw_tokens(text: Column) -> Column:
    """What stands between white space; an empty string where a text begins or ends with some, or has nothing else."""
    return F.split(F.coalesce(text, F.lit("")), SPACE)


def spanish_tokens(raw: Column) -> Column:
    return F.transform(F.filter(raw, lambda w: F.length(w) > 2), lambda w: F.lower(F.btrim(w, F.lit(SIGNS))))


def hebrew_tokens(raw: Column) -> Column:
    return F.transform(F.filter(raw, lambda w: F.length(w) > 1), lambda w: F.btrim(w, F.lit(SIGNS)))


def tokenize_spanish(text: Column) -> Column:
    """White-space tokens of more than two characters, counted before signs are stripped, in lower case.

    A token that is all signs becomes an empty string and stays.
    """
    return spanish_tokens(raw_tokens(text))


def tokenize_hebrew(text: Column) -> Column:
    """The same of more than one character, as they are written."""
    return hebrew_tokens(raw_tokens(text))


def first_distinct(words: Column) -> Column:
    """Without empty strings, each once, in order of first appearance."""
    return F.array_distinct(F.filter(words, lambda w: F.coalesce(w, F.lit("")) != ""))


def pick(values: Column, i: Column) -> Column:
    """The i-th value (from 0), else the first, else an empty string."""
    return F.coalesce(F.get(values, i), F.get(values, F.lit(0)), F.lit(""))


def count_of(values: Column) -> Column:
    return F.coalesce(F.size(values), F.lit(0))


def joined(values: Column) -> Column:
    return F.array_join(values, " ")


def normalize_ipa(x: Column) -> Column:
    return F.btrim(strip(F.coalesce(x, F.lit(""))), F.lit("[]/"))


def clean_ipa(x: Column) -> Column:
    """A transcription fit for a lookup: no slashes, brackets, alternatives or optional parts; null if nothing is left."""
    out = F.btrim(strip(x), F.lit("/[]"))
    for mark in "[~":
        out = F.when(F.contains(out, F.lit(mark)), strip(F.substring_index(out, mark, 1))).otherwise(out)
    out = F.regexp_replace(out, r"\([^)]*\)", "")
    out = F.btrim(out, F.lit("/ []"))
    return F.nullif(strip(F.regexp_replace(out, SPACE, " ")), F.lit(""))


def overlap(generated: Column, expected: Column) -> Column:
    """Characters of `generated` that `expected` has, over the longer length; 0 if either is empty."""
    chars = F.filter(F.split(generated, ""), lambda c: c != "")
    common = F.size(F.filter(chars, lambda c: F.contains(expected, c)))
    some = (F.length(generated) > 0) & (F.length(expected) > 0)
    return F.when(some, common / F.greatest(F.length(generated), F.length(expected))).otherwise(F.lit(0.0))


def missing_characters(expected: Column, generated: Column) -> Column:
    """Distinct characters of `expected` that `generated` lacks."""
    return F.array_except(F.filter(F.split(expected, ""), lambda c: c != ""), F.split(generated, ""))


def percent(part: Column, whole: Column) -> Column:
    """100 part / whole to two places, half to even; 0 when the whole is 0."""
    return rounded(F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0)))


def rounded(x: Column) -> Column:
    return F.rint(x * 100) / 100

"""Entries and bridge rows out of raw records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.functions.text import first_distinct


def first_ipa(sounds: Column) -> Column:
    """Of the first sound that has the key, be its value null; an empty string without one."""
    having = F.filter(sounds, lambda s: F.map_contains_key(s, "ipa"))
    return F.when(F.coalesce(F.size(having), F.lit(0)) > 0, F.element_at(F.get(having, F.lit(0)), "ipa")).otherwise(F.lit(""))


def definitions(senses: Column, word: Column) -> Column:
    """First gloss of each sense that has one; the word itself without any."""
    first = F.transform(F.filter(senses, lambda s: F.coalesce(F.size(s["glosses"]), F.lit(0)) > 0), lambda s: F.get(s["glosses"], F.lit(0)))
    return F.when(F.coalesce(F.size(first), F.lit(0)) > 0, first).otherwise(F.array(word))


def translations(column: Column, language: str, code_field: str = "lang_code") -> Column:
    """Words of one language, each once, as they first appear."""
    own = F.filter(column, lambda t: t[code_field] == language)
    return F.coalesce(first_distinct(F.transform(own, lambda t: t["word"])), F.expr("cast(array() as array<string>)"))


def entries(raw: DataFrame, language: str, targets: tuple[str, ...]) -> DataFrame:
    """Dictionary entries of `language` with a translation column for each target."""
    own = raw.where((F.col("lang_code") == language) & (F.coalesce("word", F.lit("")) != ""))
    return own.select(
        "row_idx", "word", F.coalesce("pos", F.lit("unknown")).alias("pos"), first_ipa(F.col("sounds")).alias("ipa"),
        definitions(F.col("senses"), F.col("word")).alias("definitions"),
        *(translations(F.col("translations"), t).alias(f"translations_{t}") for t in targets),
    )


def spanish_entries(raw: DataFrame) -> DataFrame:
    return entries(raw, "es", ("en", "fr", "de", "he"))


def hebrew_entries(raw: DataFrame) -> DataFrame:
    return entries(raw, "he", ("en", "fr", "de", "es"))


def bridge_entries(raw: DataFrame, code_field: str = "lang_code") -> DataFrame:
    """Rows of the es and he sections of another language's dictionary; English names the language in `code`."""
    own = raw.where(F.col("lang_code").isin("es", "he") & (F.coalesce(F.size("translations"), F.lit(0)) > 0) & (F.coalesce("word", F.lit("")) != ""))
    return own.select(
        "row_idx", F.col("lang_code").alias("source_lang"), "word", F.coalesce("pos", F.lit("unknown")).alias("pos"), first_ipa(F.col("sounds")).alias("ipa"),
        definitions(F.col("senses"), F.col("word")).alias("definitions"),
        *(translations(F.col("translations"), t, code_field).alias(f"translations_{t}") for t in ("es", "he")),
    )

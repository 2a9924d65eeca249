"""Proper nouns out, bridges together, scores and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexforge.functions.text import count_of
from lexforge.operators.numbering import placed
from lexforge.plans.recovery import settle

# Tags of proper nouns, and abbreviations that are none.
PROPER_TAGS = ("name", "proper noun", "propn", "proper_noun")
ABBREVIATIONS = ("ISBN", "USA", "UK", "TV", "PC", "CD", "DVD", "GPS", "SMS", "HTTP", "HTML", "CSS", "PDF", "API", "URL", "USB", "RAM")


def looks_proper(word: Column) -> Column:
    upper = F.substring(word, 1, 1).rlike(r"^\p{IsUppercase}")
    return ~word.isin(*ABBREVIATIONS) & F.coalesce(upper, F.lit(False))


def filter_proper_nouns(df: DataFrame, column: str = "word") -> DataFrame:
    """Without rows tagged as proper nouns (a null tag is none) and words with a capital at the start."""
    if "pos" in df.columns:
        df = df.where(~F.coalesce(F.lower("pos").isin(*PROPER_TAGS), F.lit(False)))
    return df.where(~F.coalesce(looks_proper(F.col(column)), F.lit(False)))


def combine_bridges(**bridges: DataFrame) -> DataFrame:
    """Named bridges one after another; of each (source_lang, word, pos) the first row."""
    out = None
    for turn, (name, df) in enumerate(bridges.items()):
        one = df.withColumn("bridge_source", F.lit(name)).withColumn("_turn", F.lit(turn))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    first = W.partitionBy("source_lang", "word", "pos").orderBy("_turn", "row_idx")
    kept = out.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return kept.withColumn("row_idx", F.col("_turn") * F.lit(1 << 48) + F.col("row_idx")).drop("_turn")


def frequency_score(he: Column, es: Column, en: Column, fr: Column, n_definitions: Column, length: Column) -> Column:
    """A double in a fixed order of additions, so that equal rows tie exactly."""
    d = lambda x: F.lit(float(x))
    short = F.greatest(d(0), (d(10) - length) / d(10))
    return d(0.4) * he + d(0.4) * es + d(0.2) * en + d(0.1) * fr + d(0.3) * n_definitions + d(0.3) * short


def score_entries(df: DataFrame) -> DataFrame:
    n = lambda c: count_of(F.col(c)) if c in df.columns else F.lit(0)
    score = frequency_score(n("translations_he"), n("translations_es"), n("translations_en"), n("translations_fr"), n("definitions"), F.length("word"))
    return df.withColumn("frequency_score", score)


def dense_rank_desc(df: DataFrame, score: str, name: str) -> DataFrame:
    """Dense rank of a score, highest first; null scores have none.

    The distinct scores are ranked by ranges and offsets and come back by a join, so that no task sorts the table, and rows
    that share a score are no hot key of the ranking. The rows are written first, as both steps read them.
    """
    df = settle(df, "scored")
    ranked = placed(df.select(score).where(F.col(score).isNotNull()).distinct(), [F.desc(score)], "_place")
    ranked = ranked.select(score, (F.col("_place") + 1).cast("int").alias(name))
    return df.join(ranked, score, "left").select(*df.columns, name)


def add_frequency_ranks(df: DataFrame) -> DataFrame:
    return dense_rank_desc(score_entries(df), "frequency_score", "frequency_rank")

"""A corpus pipeline of five training-data stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.llm import decontamination, jaccard_join, language_id, mixing, token_files
from lexforge.llm.catalog import mix_levels, public_tokenizer
from lexforge.llm.catalog_values import MIX_EPOCHS, MIX_SEED, MIX_SHARE, MIX_WEIGHTS
from lexforge.llm.shared import free_name, settle, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach stay, each with all its columns; `lang` becomes the prediction, by which later stages mix.

    Null, empty and letterless texts go; repeated rows are each judged, of languages that code a text alike the first by name is told;
    a text of any length is scored whole, window by window; an empty table stays empty.
    """
    return language_id.accept(docs, language_id.fit(docs), lang="lang")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links connect, the one of smallest id stays; rows without words all stay.

    Links are similarities of 80 percent or more of five-word shingles. Rows of one id and text count as one; null ids come last.
    Texts of any length are compared whole; an empty table stays empty.
    """
    return jaccard_join.JaccardJoin(docs, words=5, percent=80).keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go; what a text holds depends on the text alone.

    Null and empty texts hold none and stay, and so do repeated rows; without benchmark items all stay. Texts of any length are searched
    whole; an empty table stays empty.
    """
    digest = F.md5(F.col("text").cast("binary"))
    found = decontamination.decontaminate(docs.select(digest.alias("digest"), "text"), table(spark, sf_dir, "benchmark"), key="digest")
    bad = settle(found.where("contaminated").select("digest").distinct(), "contaminated")  # written, so that Spark knows whether it may be broadcast
    own = docs.select(digest.alias("digest"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)))
    return own.join(bad, "digest", "left_anti").drop("digest").toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents to target weights; one that several passes take comes as often.

    Null languages and sources are branches of their own; rows without words come with those around them; equal rows are drawn together; a text of any length is
    taken or left whole; an empty table stays empty.
    """
    drawn = mixing.draw(docs, mix_levels(), MIX_WEIGHTS, share=MIX_SHARE, epochs=MIX_EPOCHS, seed=MIX_SEED)
    own = [F.col(f"`{c}`") for c in docs.columns]
    turn = F.sequence(F.lit(1), F.col(free_name("copies", docs.columns)).cast("int"))
    return drawn.select(*own, F.explode(turn).alias(free_name("copy", docs.columns))).select(*own)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, read back per document; null and empty texts have the end id alone.

    Repeated rows are each encoded, and rows of one id are ordered by their texts' hashes; a text of any length is encoded whole; an empty table gives an empty result.
    """
    return token_files.tokens_roundtrip(docs, public_tokenizer("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language), ("ngram_jaccard_join", drop_near_copies), ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix_sources), ("token_output", write_tokens),
]

#: Trained statistics and the public tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

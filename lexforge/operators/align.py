"""Alignment of two languages: direct links, a bridge, and fuzzy definitions."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexforge.functions.similarity import length_bucket, similar_pairs
from lexforge.functions.text import joined, pick
from lexforge.plans.recovery import settle


#: Texts of a block; two blocks are compared in a task.
BLOCK = 1024


def first_per(df: DataFrame, *keys: str, order: str = "row_idx") -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(order))).where("_n = 1").drop("_n")


def _ord(stage: int, a: Column, b: Column | None = None, c: Column | None = None) -> Column:
    long = lambda x: (F.lit(0) if x is None else x).cast("long")
    return F.struct(F.lit(stage).alias("stage"), long(a).alias("a"), long(b).alias("b"), long(c).alias("c")).alias("ord")


def _row(order: Column, sense: Column, definition: Column, kind: Column, confidence: Column | None = None) -> list[Column]:
    return [
        order, F.col("es_word"), F.col("es_ipa"), F.col("es_pos"), definition.alias("es_definition"), F.col("he_word"), F.col("he_ipa"), F.col("he_definition"),
        sense.cast("int").alias("sense_id"), kind.alias("match_type"), (F.lit(None) if confidence is None else confidence).cast("double").alias("confidence"),
    ]


def _hebrew(he: DataFrame) -> DataFrame:
    return first_per(he, "word").select(F.col("word").alias("he_word"), F.col("ipa").alias("he_ipa"), pick(F.col("definitions"), F.lit(0)).alias("he_definition"))


def _spanish(es: DataFrame) -> DataFrame:
    rank = F.col("frequency_rank") if "frequency_rank" in es.columns else F.lit(0)
    return es.select("row_idx", F.col("word").alias("es_word"), F.col("ipa").alias("es_ipa"), F.col("pos").alias("es_pos"), "definitions", "translations_he", rank.alias("rank"))


def align_direct(es: DataFrame, he: DataFrame) -> DataFrame:
    """Each Hebrew translation of an entry that is a Hebrew word; the sense is its place in the list."""
    listed = _spanish(es).select("*", F.posexplode("translations_he").alias("at", "he_word"))
    return listed.join(_hebrew(he), "he_word").select(*_row(_ord(1, F.col("row_idx"), F.col("at")), F.col("at") + 1, pick(F.col("definitions"), F.col("at")), F.lit("direct")))


def align_bridge(es: DataFrame, he: DataFrame, bridge: DataFrame) -> DataFrame:
    """The first Hebrew word of the first bridge row of the word that Hebrew has; one match a word."""
    links = first_per(bridge.where("source_lang = 'es'"), "word").select(F.col("word").alias("es_word"), F.posexplode("translations_he").alias("at", "he_word"))
    hits = links.join(_hebrew(he), "he_word")
    best = hits.groupBy("es_word").agg(F.min_by(F.struct("he_word", "he_ipa", "he_definition"), "at").alias("hit")).select("es_word", "hit.*")
    words = _spanish(first_per(es, "word"))
    return words.join(best, "es_word").select(*_row(_ord(2, F.col("row_idx")), F.lit(1), pick(F.col("definitions"), F.lit(0)), F.lit("triangulation")))


def similarity_join(left: DataFrame, right: DataFrame, cutoff: float) -> DataFrame:
    """Pairs of `left` (id, text) and `right` (text) with a ratio of `cutoff` or more, as (id, text, match, score).

    Texts meet only in equal or neighbouring length buckets, which loses no pair; equal
    texts of one side are scored once. A bucket is dealt into blocks, and each pair of blocks is a group of its own of at
    most some `BLOCK` by `BLOCK` texts, so that a bucket that holds most texts is worked on by as many tasks as it has pairs of blocks.
    """
    a = left.select(F.col("text").alias("text")).distinct().withColumn("bucket", length_bucket(F.length("text"), cutoff))
    b = right.select(F.col("text").alias("text")).distinct()
    b = b.withColumn("bucket", F.explode(F.array(*(length_bucket(F.length("text"), cutoff) + d for d in (-1, 0, 1)))))
    blocks = lambda x, name: x.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
    # Buckets grow by half, so there are fewer than a hundred.
    plan = F.broadcast(blocks(a, "of_a").join(blocks(b, "of_b"), "bucket"))

    def dealt(x: DataFrame, own: str, other: str, own_blocks: str, other_blocks: str) -> DataFrame:
        x = x.join(plan, "bucket").withColumn(own, F.pmod(F.xxhash64("text"), F.col(own_blocks)).cast("int"))
        return x.select("bucket", own, F.explode(F.sequence(F.lit(0), F.col(other_blocks) - 1)).alias(other), "text").groupBy("bucket", "a", "b")

    def compare(x: pa.Table, y: pa.Table) -> pa.Table:
        return similar_pairs(x.column("text").to_pylist(), y.column("text").to_pylist(), cutoff)

    one, two = dealt(a, "a", "b", "of_a", "of_b"), dealt(b, "b", "a", "of_b", "of_a")
    scored = one.cogroup(two).applyInArrow(compare, "text string, match string, score double")
    return left.join(scored, "text")


def align_fuzzy(es: DataFrame, he: DataFrame, cutoff: float = 80.0, apart: bool = False) -> DataFrame:
    """The Hebrew entry whose definitions are most alike those of the Spanish one, from `cutoff` on.

    Of equal scores the text that comes first wins, and of equal texts the row that comes last.
    With `apart`, both are one table and no row matches itself: `row_idx` tells.
    """
    some = lambda df: df.where(F.coalesce(F.size("definitions"), F.lit(0)) > 0)
    merged = (
        F.min("row_idx").alias("first_idx"),
        F.max_by(F.struct(F.col("word").alias("he_word"), F.col("ipa").alias("he_ipa"), pick(F.col("definitions"), F.lit(0)).alias("he_definition")), "row_idx").alias("he"),
    )
    matches = some(he).withColumn("match", joined(F.col("definitions")))
    texts = matches.groupBy("match").agg(*merged)
    rows = _spanish(some(es)).withColumn("text", joined(F.col("definitions")))
    pairs = similarity_join(rows, texts.select(F.col("match").alias("text")), cutoff)
    if apart:
        others = pairs.select(F.col("row_idx").alias("own"), "match").join(matches, "match").where("own != row_idx")
        pairs = pairs.join(others.groupBy(F.col("own").alias("row_idx"), "match").agg(*merged), ["row_idx", "match"])
    else:
        pairs = pairs.join(texts, "match")
    best = W.partitionBy("row_idx").orderBy(F.desc("score"), "first_idx")
    top = pairs.withColumn("_n", F.row_number().over(best)).where("_n = 1").select("*", "he.*")
    kind = F.concat(F.lit("fuzzy_"), F.col("score").cast("string"))
    return top.select(*_row(_ord(3, F.col("rank"), F.col("row_idx")), F.lit(1), pick(F.col("definitions"), F.lit(0)), kind, F.col("score") / 100))


def not_in(df: DataFrame, column: str, done: DataFrame, done_column: str) -> DataFrame:
    """Rows whose value is not among those of `done`."""
    return df.join(done.select(F.col(done_column).alias(column)).distinct(), column, "left_anti").select(*df.columns)


def align(es: DataFrame, he: DataFrame, bridge: DataFrame | None = None, cutoff: float = 80.0) -> DataFrame:
    """Direct links, then the bridge for words without one, then fuzzy matches for the rest.

    Each strategy's result is written before the next one asks for the words that are done, so that none is computed twice.
    """
    done = settle(align_direct(es, he), "direct")
    if bridge is not None:
        done = done.unionByName(settle(align_bridge(not_in(es, "word", done, "es_word"), he, bridge), "bridged"))
    return done.unionByName(align_fuzzy(not_in(es, "word", done, "es_word"), he, cutoff))

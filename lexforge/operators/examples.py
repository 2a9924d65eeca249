"""Sentence pairs, and the examples of aligned words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.functions.text import tokenize_hebrew, tokenize_spanish
from lexforge.operators.numbering import placed
from lexforge.plans.recovery import settle


def pair_by_position(sentences: DataFrame, left: str = "es", right: str = "he") -> DataFrame:
    """The n-th sentence of one language with the n-th of the other.

    Row numbers alone are put in order, by ranges and offsets, and meet by their place; texts are fetched for the
    pairs. Rows of one number are ordered by a hash of their texts, equal rows one after another. Null texts are sentences too.
    """
    digest = F.coalesce(F.xxhash64("text"), F.lit(0))
    own = sentences.where(F.col("lang").isin(left, right)).select("lang", "row_idx", digest.alias("digest"), "text")
    numbers = placed(own.drop("text"), [F.col("row_idx"), F.col("digest")], "n", within="lang")
    texts = own.dropDuplicates(["lang", "row_idx", "digest"])
    side = lambda language, name: numbers.where(F.col("lang") == language).select("n", F.col("row_idx").alias(f"{name}_idx"), F.col("digest").alias(f"{name}_digest"))
    text = lambda language, name: texts.where(F.col("lang") == language).select(F.col("row_idx").alias(f"{name}_idx"), F.col("digest").alias(f"{name}_digest"), F.col("text").alias(name))
    pairs = side(left, "es").join(side(right, "he"), "n")
    return pairs.join(text(left, "es"), ["es_idx", "es_digest"]).join(text(right, "he"), ["he_idx", "he_digest"]).select(F.col("n").alias("row_idx"), "es", "he")


def pair_by_links(sentences: DataFrame, links: DataFrame, left: str = "es", right: str = "he") -> DataFrame:
    """The same by a table of links (left_id, right_id) between sentence ids."""
    a = sentences.where(F.col("lang") == left).select(F.col("id").alias("left_id"), "row_idx", F.col("text").alias("es"))
    b = sentences.where(F.col("lang") == right).select(F.col("id").alias("right_id"), F.col("text").alias("he"))
    return links.join(a, "left_id").join(b, "right_id").select("row_idx", "es", "he")


def tokenized(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("es_words", tokenize_spanish(F.col("es"))).withColumn("he_words", tokenize_hebrew(F.col("he")))


#: Rows whose numbers stand together in a posting, as a power of two.
BLOCK_BITS = 14
#: What a written word of an example stands for.
ES, HE, TEXT = range(3)


def _numbered_pairs(aligned: DataFrame) -> DataFrame:
    """(pair, es_word, he_word): the distinct pairs of words, numbered as they are written."""
    pairs = aligned.select("es_word", "he_word").where("es_word is not null and he_word is not null").distinct()
    return settle(pairs.withColumn("pair", F.monotonically_increasing_id()), "word-pairs")


def _found(pairs: DataFrame, examples: DataFrame) -> DataFrame:
    """(pair, row_idx, es, he) for each pair and each example that has its words.

    One pass over `examples`, which may be dear to make, writes the numbers of those of their words that are in a pair, and each example once. From there on
    words, pairs and examples are numbers.
    """
    listed = pairs.select(F.col("es_word").alias("word"), F.lit(ES).alias("of")).union(pairs.select("he_word", F.lit(HE)))
    known = listed.groupBy("word").agg(F.bool_or(F.col("of") == ES).alias("in_es"), F.bool_or(F.col("of") == HE).alias("in_he"))
    known = settle(known.withColumn("id", F.monotonically_increasing_id()), "words")

    numbered = examples.select(F.monotonically_increasing_id().alias("uid"), F.struct("row_idx", "es", "he").alias("example"), "es_words", "he_words")
    # An example stands under a word of its own, so that no task gets all of them if the join is a shuffle.
    sides = ((ES, F.col("es_words")), (HE, F.col("he_words")), (TEXT, F.array(F.col("uid").cast("string"))))
    each = numbered.select("uid", "example", F.inline(F.array(*(F.struct(F.lit(side).alias("side"), words.alias("words")) for side, words in sides))))
    words = each.select("uid", "side", F.when(F.col("side") == TEXT, F.col("example")).alias("example"), F.explode("words").alias("word"))
    wanted = F.when(F.col("side") == ES, F.col("in_es")).when(F.col("side") == HE, F.col("in_he")).otherwise(F.lit(True))
    own = settle(words.join(known, "word", "left").where(wanted).select("uid", "side", "id", "example"), "example-words")

    # What Parquet packs into little is large in memory, so neither postings nor texts are broadcast on the word of their files' sizes.
    def postings(side: int, name: str) -> DataFrame:
        met = own.where(F.col("side") == side).select("uid", F.col("id").alias(f"{name}_id"))
        return met.groupBy(f"{name}_id", F.shiftright("uid", BLOCK_BITS).alias("block")).agg(F.collect_set("uid").alias(f"{name}_uids")).hint("merge")

    number = lambda name: known.select(F.col("word").alias(f"{name}_word"), F.col("id").alias(f"{name}_id"))
    ids = pairs.join(number("es"), "es_word").join(number("he"), "he_word").select("pair", "es_id", "he_id")
    met = ids.join(postings(ES, "es"), "es_id").join(postings(HE, "he"), ["he_id", "block"])
    hits = met.select("pair", F.explode(F.array_intersect("es_uids", "he_uids")).alias("uid"))
    texts = own.where(F.col("side") == TEXT).select("uid", "example.*").hint("merge")
    return hits.join(texts, "uid").select("pair", "row_idx", "es", "he")


def example_rows(aligned: DataFrame, examples: DataFrame) -> DataFrame:
    """(es_word, he_word, row_idx, es, he): a row for each pair of words of `aligned` and each example with the one word on its Spanish side and the other on its Hebrew side.

    Examples are numbered as they are written, and a word's posting is cut into blocks of numbers, so that a word that most
    examples have is many rows of bounded size. A pair of words meets block by block, and there the numbers are intersected; the texts are fetched last,
    for what was hit. Null words and texts match nothing; equal rows of `examples` are examples of their own; empty tables give an empty result.
    """
    pairs = _numbered_pairs(aligned)
    return _found(pairs, examples).join(pairs, "pair").select("es_word", "he_word", "row_idx", "es", "he")


def enrich(aligned: DataFrame, examples: DataFrame) -> DataFrame:
    """Adds `examples`: in order, the pairs with the Spanish word on one side and the Hebrew one on the other.

    The nested form, in which a row of `aligned` has all its examples; `example_rows` has them one by one.
    """
    pairs = _numbered_pairs(aligned)
    lists = _found(pairs, examples).groupBy("pair").agg(F.array_sort(F.collect_list(F.struct("row_idx", "es", "he"))).alias("found"))
    found = F.transform("found", lambda x: F.struct(x["es"].alias("es"), x["he"].alias("he")))
    none = F.expr("cast(array() as array<struct<es:string,he:string>>)")
    # The lists stay where they were made; the rows of `aligned` come to them.
    return aligned.join(pairs, ["es_word", "he_word"], "left").join(lists, "pair", "left").select(*(aligned[c] for c in aligned.columns), F.coalesce(found, none).alias("examples"))

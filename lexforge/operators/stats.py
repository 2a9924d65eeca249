"""Statistics of parsing and alignment, and the data of their charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.functions.text import count_of, percent, rounded


def histogram(df: DataFrame, column: str) -> DataFrame:
    """(column, count) of the non-null values, most frequent first, ties by value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).count().orderBy(F.desc("count"), column)


def histogram_map(df: DataFrame, column: str) -> DataFrame:
    """One row with the histogram as a map; for columns of few values."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).count()
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(column, "count")))).alias(f"{column}_distribution"))


def _mean(x: Column) -> Column:
    return F.coalesce(F.avg(x), F.lit(0.0))


def entry_stats(entries: DataFrame, translations: str) -> DataFrame:
    """One row over the entries of a language; `entries_with_ipa` counts empty strings, the next column does not."""
    n, links = F.count(F.lit(1)), F.coalesce(F.sum(count_of(F.col(translations))), F.lit(0))
    return entries.agg(
        n.alias("total_entries"), F.count("ipa").alias("entries_with_ipa"), F.count_if(F.coalesce("ipa", F.lit("")) != "").alias("entries_with_nonempty_ipa"),
        percent(F.count("ipa"), n).alias("ipa_coverage_pct"), links.alias("total_translations"),
        rounded(F.when(n > 0, links / n).otherwise(F.lit(0.0))).alias("avg_translations_per_entry"),
        rounded(_mean(count_of(F.col("definitions")))).alias("avg_definitions_per_entry"),
    )


def parsing_stats(es: DataFrame, he: DataFrame, examples: DataFrame) -> DataFrame:
    """One row of structs: spanish, hebrew, examples."""
    side = lambda df, t, name: entry_stats(df, t).crossJoin(histogram_map(df, "pos")).select(F.struct("*").alias(name))  # noqa: E731  one row by one row
    pairs = examples.agg(
        F.count(F.lit(1)).alias("total_pairs"), rounded(_mean(count_of(F.col("es_words")))).alias("avg_spanish_words"), rounded(_mean(count_of(F.col("he_words")))).alias("avg_hebrew_words"),
    ).select(F.struct("*").alias("examples"))
    return side(es, "translations_he", "spanish").crossJoin(side(he, "translations_es", "hebrew")).crossJoin(pairs)


def polysemy(df: DataFrame, word: str = "es_word") -> DataFrame:
    """One row: words, rows, mean and largest number of rows a word, and words of several."""
    sizes = df.groupBy(word).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count(F.lit(1)).alias("words"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), _mean(F.col("n")).alias("avg_senses"),
        F.coalesce(F.max("n"), F.lit(0)).alias("max_senses"), F.count_if(F.col("n") > 1).alias("polysemic_words"),
    )


def clustered_words(df: DataFrame, word: str = "es_word") -> DataFrame:
    """One row: words, and words of more than one cluster."""
    return df.groupBy(word).agg(F.max("semantic_cluster").alias("m")).agg(F.count(F.lit(1)).alias("words"), F.count_if(F.col("m") > 1).alias("clustered_words"))


def alignment_stats(aligned: DataFrame, enriched: DataFrame) -> DataFrame:
    """One row of structs: alignment, polysemy, enrichment, and the pos map."""
    poly = polysemy(aligned)
    basic = aligned.agg(F.count(F.lit(1)).alias("total_alignments"), F.countDistinct("es_word").alias("unique_spanish_words"), F.countDistinct("he_word").alias("unique_hebrew_words"))
    n, some = F.count(F.lit(1)), F.count_if(F.size("examples") > 0)
    total = F.coalesce(F.sum(F.size("examples")), F.lit(0))
    rich = enriched.agg(
        n.alias("total_enriched"), some.alias("entries_with_examples"), percent(some, n).alias("example_coverage_pct"), total.alias("total_examples"),
        rounded(_mean(F.size("examples"))).alias("avg_examples_per_entry"),
    )
    words = F.col("unique_spanish_words")
    per_word = rounded(F.when(words > 0, F.col("total_alignments") / words).otherwise(F.lit(0.0)))
    left = basic.select(F.struct("*", per_word.alias("avg_translations_per_word")).alias("alignment"))
    middle = poly.select(F.struct(
        rounded(F.col("avg_senses")).alias("avg_senses_per_word"), "max_senses", F.col("polysemic_words").alias("polysemic_words_count"), percent(F.col("polysemic_words"), F.col("words")).alias("polysemic_words_pct"),
    ).alias("polysemy"))
    return left.crossJoin(middle).crossJoin(rich.select(F.struct("*").alias("enrichment"))).crossJoin(histogram_map(aligned, "es_pos"))


def progress_summary(parsing: DataFrame, alignment: DataFrame) -> DataFrame:
    """The figures of both that a reader looks at first; one row."""
    pick = lambda **names: F.struct(*(F.col(path).alias(name) for name, path in names.items()))
    return parsing.crossJoin(alignment).select(
        pick(total_spanish_entries="spanish.total_entries", total_hebrew_entries="hebrew.total_entries", total_alignments="alignment.total_alignments", final_dictionary_size="alignment.unique_spanish_words").alias("pipeline_overview"),
        pick(spanish_ipa_coverage="spanish.ipa_coverage_pct", hebrew_ipa_coverage="hebrew.ipa_coverage_pct", example_coverage="enrichment.example_coverage_pct", avg_examples_per_entry="enrichment.avg_examples_per_entry").alias("data_quality"),
        pick(polysemic_words="polysemy.polysemic_words_count", polysemy_rate="polysemy.polysemic_words_pct", avg_senses_per_word="polysemy.avg_senses_per_word", max_senses_for_word="polysemy.max_senses").alias("linguistic_features"),
    )


def _chart(name: str, pairs: list[tuple[str, Column]]) -> Column:
    return F.array(*(F.struct(F.lit(name).alias("chart"), F.lit(label).alias("label"), value.cast("double").alias("value")) for label, value in pairs))


def _pie(name: str, counts: Column, n: int = 10) -> Column:
    rows = F.transform(F.map_entries(counts), lambda e: F.struct((-e["value"]).alias("v"), e["key"].alias("k")))
    top = F.slice(F.array_sort(rows), 1, n)
    return F.transform(top, lambda r: F.struct(F.lit(name).alias("chart"), r["k"].alias("label"), (-r["v"]).cast("double").alias("value")))


def parsing_charts(stats: DataFrame) -> DataFrame:
    """(chart, label, value) of the four parsing charts."""
    c = F.col
    charts = F.concat(
        _chart("entry_counts", [("Spanish", c("spanish.total_entries")), ("Hebrew", c("hebrew.total_entries")), ("Examples", c("examples.total_pairs"))]),
        _chart("ipa_coverage", [("Spanish", c("spanish.ipa_coverage_pct")), ("Hebrew", c("hebrew.ipa_coverage_pct"))]),
        _pie("spanish_pos", c("spanish.pos_distribution")), _pie("hebrew_pos", c("hebrew.pos_distribution")),
    )
    return stats.select(F.inline(charts))


def alignment_charts(stats: DataFrame) -> DataFrame:
    """(chart, label, value) of the four alignment charts; the gauge has its reference and threshold."""
    c = F.col
    charts = F.concat(
        _chart("overview", [("Alignments", c("alignment.total_alignments")), ("Spanish words", c("alignment.unique_spanish_words")), ("Hebrew words", c("alignment.unique_hebrew_words"))]),
        _chart("polysemy", [("Monosemic", c("alignment.unique_spanish_words") - c("polysemy.polysemic_words_count")), ("Polysemic", c("polysemy.polysemic_words_count"))]),
        _chart("example_coverage", [("value", c("enrichment.example_coverage_pct")), ("reference", F.lit(50)), ("threshold", F.lit(80))]),
        _pie("pos", c("es_pos_distribution")),
    )
    return stats.select(F.inline(charts))


def character_counts(df: DataFrame, column: str, without: str = "") -> DataFrame:
    """(char, count) over all strings, separators left out, most frequent first."""
    chars = df.select(F.explode(F.split(column, "")).alias("char")).where(F.col("char") != "")
    if without:
        chars = chars.where(~F.col("char").isin(*without))
    return chars.groupBy("char").count().orderBy(F.desc("count"), "char")


def similarity_summary(df: DataFrame, column: str = "similarity", high: float = 0.7, low: float = 0.3) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("pairs"), _mean(F.col(column)).alias("mean"), F.count_if(F.col(column) == 1.0).alias("exact"),
        F.count_if(F.col(column) >= high).alias("high"), F.count_if(F.col(column) < low).alias("low"),
    )


def best_and_worst(df: DataFrame, score: str, key: str, n: int = 10) -> DataFrame:
    """The n highest and the n lowest rows by score, ties by key, with `side`."""
    top = df.orderBy(F.desc(score), key).limit(n).withColumn("side", F.lit("best"))
    return top.union(df.orderBy(score, key).limit(n).withColumn("side", F.lit("worst")))

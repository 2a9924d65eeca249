"""Clusters of senses, and the nested documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexforge.functions.similarity import Block, lcs_lengths
from lexforge.operators.numbering import placed
from lexforge.schemas import SENSE


def leader_numbers(first: np.ndarray, texts: list[str], threshold: float) -> np.ndarray:
    """For each text the number of its leader, from 1; the texts of list g are first[g] to first[g + 1].

    All pairs of a list are compared side by side. Then, place by place, the texts that stand there in their lists
    join the first leader before them that they are more than `threshold` alike, or lead.
    """
    sizes = np.diff(first)
    pairs = [(j, k, first[:-1][sizes > k]) for k in range(1, int(sizes.max(initial=0))) for j in range(k)]
    block = Block(texts)
    i, j = (np.concatenate([base + p[side] for p in pairs for base in (p[2],)] or [np.zeros(0, np.int64)]) for side in (0, 1))
    total = block.length[i] + block.length[j]
    common = lcs_lengths(block, block, i, j, np.floor(threshold * total / 200).astype(np.int64))
    near = np.where(total > 0, 100.0 * (2 * common) / np.maximum(total, 1), 100.0) > threshold
    out, led, at = np.zeros(len(texts), np.int32), np.zeros(len(sizes), np.int32), 0
    leads = np.zeros(len(texts), bool)
    for k in range(int(sizes.max(initial=0))):
        groups = np.flatnonzero(sizes > k)
        rows, own = first[groups] + k, np.zeros(len(groups), np.int32)
        for before in range(k):
            join = (own == 0) & leads[first[groups] + before] & near[at : at + len(groups)]
            own[join] = out[first[groups[join]] + before]
            at += len(groups)
        new = own == 0
        led[groups[new]] += 1
        own[new], leads[rows[new]] = led[groups[new]], True
        out[rows] = own
    return out


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _lead(lists: pa.Array) -> pa.Array:
    first = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    numbers = leader_numbers(first, lists.flatten().to_pylist(), 70.0)
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(numbers, pa.int32()))


def cluster_senses(df: DataFrame, word: str = "es_word", text: str = "es_definition", order: str = "ord", largest: int = 10) -> DataFrame:
    """Adds `semantic_cluster`: rows of a word join the first leader they are more than 70 alike, else lead.

    Leaders are compared, not members, and numbered from 1. Words of one row, or of more than `largest`,
    stay at 1. Sizes are counted first, so that only short lists are gathered.
    """
    sized = df.join(df.groupBy(word).agg(F.count(F.lit(1)).alias("_size")), word)
    small = sized.where((F.col("_size") > 1) & (F.col("_size") <= largest))
    lists = small.groupBy(word).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(text, F.lit("")).alias("t")))).alias("_rows"))
    led = lists.withColumn("_cluster", _lead(F.transform("_rows", lambda r: r["t"])))
    flat = led.select(word, F.explode(F.arrays_zip(F.transform("_rows", lambda r: r["o"]).alias("o"), F.col("_cluster").alias("c"))).alias("_x")).select(word, F.col("_x.o").alias(order), F.col("_x.c").alias("_c"))
    return sized.join(flat, [word, order], "left").select(*df.columns, F.coalesce("_c", F.lit(1)).alias("semantic_cluster"))


def _text(x: str) -> Column:
    return F.coalesce(F.col(x).cast("string"), F.lit("None"))


def structure(enriched: DataFrame) -> DataFrame:
    """(id, entry) for each word, its senses in row order. Words have no order here; `dictionary_lines` puts them in order."""
    sense = F.struct(
        F.col("sense_id").cast("int").alias("sense_id"), _text("es_definition").alias("definition"), _text("he_ipa").alias("ipa_hebrew"),
        _text("he_word").alias("hebrew"), _text("es_pos").alias("pos"), F.col("examples").alias("examples"),
    )
    rows = enriched.select("es_word", F.struct(F.col("ord"), sense.alias("sense")).alias("row"), "ord", _text("es_ipa").alias("es_ipa"))
    words = rows.groupBy("es_word").agg(F.sort_array(F.collect_list("row")).alias("all"), F.min_by("es_ipa", "ord").alias("ipa"))
    entry = F.struct(
        F.col("es_word").alias("word"), F.col("ipa"), F.lit("es").alias("language"), F.lit(None).cast("string").alias("etymology"),
        F.transform("all", lambda x: x["sense"]).cast(f"array<{SENSE}>").alias("senses"),
    )
    return words.select(F.concat(F.lit("es: "), F.col("es_word")).alias("id"), entry.alias("entry"))


def document_counts(documents: DataFrame) -> DataFrame:
    """One row: entries, senses, and senses with a transcription."""
    senses = F.col("entry.senses")
    real = F.filter(senses, lambda s: ~F.coalesce(s["ipa_hebrew"], F.lit("")).isin("", "None"))
    return documents.agg(
        F.count(F.lit(1)).alias("entries"), F.coalesce(F.sum(F.size(senses)), F.lit(0)).alias("senses"), F.coalesce(F.sum(F.size(real)), F.lit(0)).alias("senses_with_ipa"),
    )


def metadata(date: Column | str | None = None) -> Column:
    day = F.date_format(F.current_date(), "yyyy-MM-dd") if date is None else F.lit(date) if isinstance(date, str) else date
    return F.struct(F.lit("es-he | he-es").alias("language_direction"), F.lit("1.0").alias("version"), F.lit("custom (Wiktionary + Tatoeba)").alias("source"), day.alias("generated_at"))


def dictionary_lines(documents: DataFrame) -> DataFrame:
    """(place, line): the entries in the order of their ids, each a line of JSON, with a comma before all but the first.

    Null fields are kept. Documents of one id follow each other by their JSON. No row holds more than an entry.
    """
    lines = documents.select("id", F.to_json(F.struct("id", "entry"), {"ignoreNullFields": "false"}).alias("line"))
    ordered = placed(lines, [F.col("id"), F.col("line")], "place")
    return ordered.select("place", F.concat(F.when(F.col("place") > 0, ",").otherwise(""), F.col("line")).alias("line"))

"""Sources: JSON lines (plain or gzip), tab-separated sentences, Parquet, JSON documents, downloads."""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexforge.schemas import DICTIONARY, RAW, SENTENCES, schema

#: The languages that can be fetched.
LANGUAGE_NAMES = {"es": "Spanish", "he": "Hebrew", "en": "English", "fr": "French", "de": "German"}


def with_row_idx(df: DataFrame, name: str = "row_idx") -> DataFrame:
    """Number the rows of a file scan in file order.

    Rows are counted by split, and each split starts where those before it end, so no task
    sees more than its own rows. `df` must come straight from a scan.
    """
    own = df.columns
    split = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_id"))
    sizes = split.groupBy("_file", "_at").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_low"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_file", "_at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.withColumn("_base", before).drop("_n")  # a row for each split of the files
    return split.join(starts, ["_file", "_at"]).select((F.col("_base") + F.col("_id") - F.col("_low")).alias(name), *own)


def parse_json_lines(lines: DataFrame, ddl: str = RAW) -> DataFrame:
    """`value` parsed by `ddl`; blank lines and lines that are no JSON object are left out.

    Keeps the other columns. `malformed_lines` counts what is left out.
    """
    return _parsed(lines, ddl).where("_bad is null").select(*[c for c in lines.columns if c != "value"], "_record.*").drop("_bad")


def malformed_lines(lines: DataFrame, ddl: str = RAW) -> DataFrame:
    """The lines that are neither blank nor a JSON object of the schema."""
    return _parsed(lines, ddl).where("_bad is not null").select(*lines.columns)


def _parsed(lines: DataFrame, ddl: str) -> DataFrame:
    record = F.from_json("value", schema(f"{ddl}, _bad string"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    full = lines.where(F.trim("value") != "").withColumn("_record", record)
    is_object = F.ltrim("value").startswith("{")
    return full.withColumn("_bad", F.when(~is_object, F.col("value")).otherwise(F.col("_record._bad"))).withColumn("_record", F.col("_record").dropFields("_bad"))


def read_json_lines(spark: SparkSession, path: str, ddl: str = RAW) -> DataFrame:
    """Records of a JSON-lines file or folder with their `row_idx`; `.gz` is read as it is."""
    return parse_json_lines(with_row_idx(spark.read.text(path)), ddl)


def read_translated(spark: SparkSession, path: str, languages: tuple[str, ...] = ("es", "he")) -> DataFrame:
    """Records in `languages` that have translations."""
    return read_json_lines(spark, path).where(F.col("lang_code").isin(*languages) & (F.coalesce(F.size("translations"), F.lit(0)) > 0))


def read_sentences(spark: SparkSession, path: str) -> DataFrame:
    """Sentences (id, lang, text) of a headerless tab-separated file."""
    return with_row_idx(spark.read.schema(SENTENCES).option("sep", "\t").option("quote", '"').option("escape", '"').csv(path))


def read_json_document(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(ddl) if ddl else reader).json(path)


def read_dictionary(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(metadata, entries) of a dictionary that `writers.write_dictionary` wrote: one row, and (place, id, entry)."""
    head = spark.read.text(f"{folder}/1-head").select(F.from_json(F.concat("value", F.lit("]}")), "metadata struct<language_direction:string,version:string,source:string,generated_at:string>").alias("h"))
    lines = with_row_idx(spark.read.text(f"{folder}/2-entries"), "place")
    entry = F.from_json(F.regexp_replace("value", "^,", ""), DICTIONARY)
    return head.select("h.metadata.*"), lines.select("place", entry.alias("e")).select("place", "e.id", "e.entry")


def download(language: str, path: str, opener: Callable[[str], bytes], base: str, tries: int = 3, pause: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """Fetch a dump to `path` on the driver unless it is there; returns the path.

    `opener` gets an address and returns bytes. A failed try leaves no partial file.
    """
    if language not in LANGUAGE_NAMES:
        raise ValueError(f"unknown language: {language!r}; known: {sorted(LANGUAGE_NAMES)}")
    if os.path.exists(path):
        return path
    name = LANGUAGE_NAMES[language]
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    for turn in range(1, tries + 1):
        try:
            body = opener(f"{base}/{name}/dictionary-{name}.jsonl")
            with open(path + ".part", "wb") as out:
                out.write(body)
            os.replace(path + ".part", path)
            return path
        except OSError:
            if os.path.exists(path + ".part"):
                os.remove(path + ".part")
            if turn == tries:
                raise
            sleep(pause)
    raise AssertionError("unreachable")

"""Sinks: Parquet, JSON documents, statistics, metrics text."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.operators.senses import dictionary_lines, metadata


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json_documents(df: DataFrame, path: str) -> None:
    """A document a line, null fields kept, characters as they are."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def as_json(df: DataFrame, indent: int = 2) -> str:
    """The rows as one indented JSON list; for results that a reader opens whole."""
    rows = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).toLocalIterator()
    return json.dumps([json.loads(r.value) for r in rows], ensure_ascii=False, indent=indent)


def write_dictionary(documents: DataFrame, folder: str, date: Column | str | None = None) -> DataFrame:
    """The dictionary as text files that are one JSON document when they are put together: head, entries and tail, in the order of their names.

    Each part of the entries is written by a task of its own, a range of the order. Returns, and writes beside them, the manifest
    (file, start, bytes), where each file begins in the whole; only names and sizes of files reach the driver.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    head = spark.range(1).select(F.concat(F.lit('{"metadata": '), F.to_json(metadata(date)), F.lit(', "entries": [')).alias("value"))
    head.coalesce(1).write.mode("overwrite").text(f"{folder}/1-head")
    lines = dictionary_lines(documents).repartitionByRange(parts, "place").sortWithinPartitions("place")
    lines.select("line").write.mode("overwrite").text(f"{folder}/2-entries")
    spark.range(1).select(F.lit("]}").alias("value")).coalesce(1).write.mode("overwrite").text(f"{folder}/3-tail")
    rows, start = [], 0
    for name in ("1-head", "2-entries", "3-tail"):
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        files = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
        for file, size in sorted((f.getPath().getName(), f.getLen()) for f in files if f.getPath().getName().startswith("part-")):
            rows.append((f"{name}/{file}", start, size))
            start += size
    manifest = spark.createDataFrame(rows, "file string, start long, bytes long")
    manifest.coalesce(1).write.mode("overwrite").json(f"{folder}/manifest")
    return manifest


def write_text(path: str, text: str) -> None:
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)


def write_lookup(lookup: DataFrame, path: str) -> None:
    """A word table sorted by key, as Parquet."""
    lookup.orderBy("word").write.mode("overwrite").parquet(path)

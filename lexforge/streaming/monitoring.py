"""Metrics and alerts over event streams (an addition: the batch rules, on Structured Streaming)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.operators.monitor import label_key


def counter_stream(events: DataFrame, time: str, *keys: str, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts of each key in event-time windows; rows later than `late` are left out."""
    return events.withWatermark(time, late).groupBy(F.window(time, window), *keys).agg(F.count(F.lit(1)).cast("double").alias("value"))


def latest_stream(samples: DataFrame, time: str = "ts") -> DataFrame:
    """The last value of each name and label set so far; for update or complete output."""
    keyed = samples.withColumn("label_key", label_key(F.col("labels")))
    return keyed.groupBy("name", "label_key").agg(F.max_by("value", time).alias("value"))


def alert_stream(values: DataFrame, *alerts: Column) -> DataFrame:
    """Alert rows of a stream of values; stateless."""
    rows = F.filter(F.array(*alerts), lambda a: a.isNotNull())
    return values.withColumn("_a", F.explode(rows)).select(*values.columns, F.col("_a.name").alias("alert"), F.col("_a.severity").alias("severity"))

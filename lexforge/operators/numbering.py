"""Places of rows in a global order, without a task that sorts them all.

Rows are dealt by ranges of the order, so that each task sorts its own range; a range's
rows are counted, and where it starts follows from the counts of those before it. Only the counts, a number
for each range, reach the driver.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexforge.plans.recovery import settle

#: A row's number within its task takes so many bits of `monotonically_increasing_id`.
TASK_BITS = 33


def placed(df: DataFrame, order: list[Column], name: str, within: str | None = None) -> DataFrame:
    """Adds `name`, the place of each row from 0 in the order, among the rows of its value of `within` if that is given.

    `within` has few values: the driver sees a number for each range and value. Rows that tie in the whole order are numbered in some order. Nulls come
    where the order puts them, and null values of `within` are a value. An empty table stays empty.
    """
    own = df.columns
    keys = ([F.col(within).asc()] if within else []) + order
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written first, as Spark goes through the rows twice: once to find the ranges, once to deal the rows.
    dealt = settle(df, "to-place").repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id())
    dealt = settle(dealt, "placed").withColumn("_range", F.shiftright("_id", TASK_BITS))
    group = ["_range", within] if within else ["_range"]
    counts = dealt.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("low")).collect()
    value = (lambda r: (r[within] is not None, r[within])) if within else (lambda r: 0)
    starts = []
    for _, rows in groupby(sorted(counts, key=lambda r: (value(r), r["_range"])), key=value):
        before = 0
        for r in rows:
            starts.append((*(r[g] for g in group), before - r["low"]))
            before += r["n"]
    fields = ["_range long", *([f"`{within}` {dict(df.dtypes)[within]}"] if within else []), "_shift long"]
    shift = df.sparkSession.createDataFrame(starts, ", ".join(fields))
    # As many rows as there are ranges and values.
    met = dealt.alias("d").join(F.broadcast(shift).alias("s"), [F.col("d._range") == F.col("s._range"), *([F.col(f"d.{within}").eqNullSafe(F.col(f"s.{within}"))] if within else [])])
    return met.select(*(F.col(f"d.{c}") for c in own), (F.col("_id") + F.col("_shift")).alias(name))

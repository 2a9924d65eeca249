"""Sharding by longest-processing-time scheduling (operator 6, law `bytes`).

Rows with equal texts form a group that stays in one shard. Groups go, largest
first, to the least-loaded shard, which a heap yields. To the rule groups of one size are
alike, so the driver schedules sizes with their counts, whatever the number of groups:
a size of few groups is popped off the heap group by group, and one of many takes the
same places in bulk. All groups are scheduled so, at any scale, and the loads are those of plain
LPT over all groups.

The driver holds a row for each distinct size of a group. Distinct sizes of sum S are
fewer than the root of 2 S, and in a corpus of texts no more than the longest text has bytes.
Which group of a size goes where is settled in Spark, by the group's rank among those of its size.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexforge.llm.shared import settle

#: Rows of one shard, or groups of one size, that are numbered in one task.
SLOT_ROWS = 65_536


def _bulk(loads: np.ndarray, size: int, count: int) -> np.ndarray:
    """How many of `count` equal jobs each shard takes: the least of the starting times load + k * size, ties by shard."""
    low, high = int(loads.min()), int(loads.min()) + size * count  # the last job starts no later than all on the least-loaded shard
    starts = lambda t: np.maximum((t - loads) // size + 1, 0)  # jobs that start at t or before
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if starts(mid).sum() >= count else (mid + 1, high)
    out = starts(low)
    last = np.flatnonzero((loads <= low) & ((low - loads) % size == 0))  # those whose last job starts just then
    out[last[len(last) - (int(out.sum()) - count) :]] -= 1
    return out


def lpt(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, np.ndarray]]:
    """Longest jobs first onto the least-loaded shard, ties by shard; `sizes`: (size, jobs of it). Per size, largest first, the jobs of each shard."""
    heap = [(0, s) for s in range(shards)]
    out = []
    for size, count in sorted(sizes, reverse=True):
        taken = np.zeros(shards, np.int64)
        if count <= 4 * shards:
            for _ in range(count):
                load, shard = heap[0]
                taken[shard] += 1
                heapq.heapreplace(heap, (load + size, shard))
        else:
            loads = np.array([load for load, _ in sorted(heap, key=lambda x: x[1])], np.int64)
            taken = _bulk(loads, size, count)
            heap = [(int(load), s) for s, load in enumerate(loads + taken * size)]
            heapq.heapify(heap)
        out.append((size, taken))
    return out


def text_size(text: Column) -> Column:
    """UTF-8 bytes and 16 for a row's header; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(16)


def _ranks(rows: DataFrame, within: str, block: str, order: list[str]) -> DataFrame:
    """`rank` of each row among those of one value of `within`, from 0 without gaps: a block is numbered in a task, and blocks are added up."""
    before = W.partitionBy(within).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    starts = rows.groupBy(within, block).count().select(within, block, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    numbered = rows.withColumn("own", F.row_number().over(W.partitionBy(within, block).orderBy(*order)))
    return numbered.join(starts, [within, block]).withColumn("rank", F.col("base") + F.col("own") - 1).drop("own", "base")


def schedule(groups: DataFrame, shards: int) -> DataFrame:
    """(grp, shard) of `groups` (grp, bytes) under LPT."""
    spark = groups.sparkSession
    sizes = groups.groupBy("bytes").count().toArrow()
    plan = lpt(list(zip(sizes.column("bytes").to_pylist(), sizes.column("count").to_pylist(), strict=True)), shards)
    # Per size, the shards that take some of its groups, and up to which rank.
    used = [np.flatnonzero(taken) for _, taken in plan]
    ends = np.cumsum([0, *map(len, used)])
    flat = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
    listed = lambda x, kind: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind))
    dealt = spark.createDataFrame(pa.table({
        "bytes": pa.array([size for size, _ in plan], pa.int64()),
        "to": listed(flat(used), pa.int32()), "upto": listed(flat([np.cumsum(t[u]) for u, (_, t) in zip(used, plan, strict=True)]), pa.int64()),
    }))
    blocks = max(1, sum(sizes.column("count").to_pylist()) // SLOT_ROWS)
    ranked = _ranks(groups.withColumn("part", F.pmod(F.xxhash64("grp"), F.lit(blocks)).cast("int")), "bytes", "part", ["grp"])
    place = F.size(F.filter("upto", lambda n: n <= F.col("rank")))
    return ranked.join(settle(dealt, "shard-plan"), "bytes").select("grp", F.get("to", place).alias("shard"))


def shard_documents(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, size, text_crc32, law, shard, slot, grown_shard.

    `slot` numbers the rows of a shard from 0 without gaps. Only `key` and `text` are
    read, so further columns of any name do no harm. Null texts count as empty, in one
    group with those. Repeated rows are kept and get slots of their own; ties of size go by the
    text's digest. Texts of any length are only measured. An empty table gives an empty result.
    """
    body = F.col(text)
    group = F.unhex(F.md5(F.coalesce(body, F.lit("")).cast("binary")))
    rows = settle(docs.select(
        F.col(key).alias("key"), text_size(body).alias("size"),
        F.coalesce(F.crc32(body.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"), group.alias("grp"),
    ), "shard-rows")
    groups = settle(rows.groupBy("grp").agg(F.sum("size").alias("bytes")), "shard-groups")
    dealt = rows.join(settle(schedule(groups, shards), "shards"), "grp")
    blocks = max(1, rows.count() // (shards * SLOT_ROWS))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("key", "grp"), F.lit(blocks)).cast("int"))
    return _ranks(dealt, "shard", "part", ["key", "text_crc32", "grp"]).select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("rank").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )

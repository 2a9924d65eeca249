"""What several training-data operators need: tables, shared scratch space, recovery points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.plans.recovery import clear, scratch, settle, shared_dir  # noqa: F401

#: Bits of a filter by `may_match` for each listed row, and the least and most of them: 8 and 64 MB.
BITS_A_ROW, FILTER_BITS, MOST_BITS = 16, 1 << 26, 1 << 29


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table; only Spark's readers touch the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(name: str, taken: list[str]) -> str:
    """`name`, with as many underscores behind it as it takes to differ from those taken."""
    while name.lower() in {x.lower() for x in taken}:
        name += "_"
    return name


def may_match(rows: DataFrame, listed: DataFrame, columns: list[str], name: str) -> DataFrame:
    """`rows` and a boolean `name`, which is true wherever `listed` has a row of the same hash of `columns`.

    `rows` has no columns _at, _bucket or _bits. It may be true for others too, so that a join has to follow, but that join need not shuffle the
    rows where it is false. The list is a bitmap, which is all that is broadcast. Its size follows the list's, so that one in BITS_A_ROW of the
    others is true, up to MOST_BITS; beyond some 30 million listed rows more are, and beyond a billion nearly all.
    """
    size = FILTER_BITS
    count = listed.count()
    while size < min(MOST_BITS, BITS_A_ROW * count):
        size *= 2

    def place(of: DataFrame) -> Column:
        return F.pmod(F.xxhash64(*(of[c] for c in columns)), F.lit(size)) + 1

    bits = listed.select(place(listed).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("_bits"))
    own = rows.select("*", place(rows).alias("_at"))
    met = own.join(F.broadcast(bits), F.bitmap_bucket_number("_at") == F.col("_bucket"), "left")
    place_in = F.bitmap_bit_position("_at")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(place_in / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.floor(byte / F.pow(F.lit(2), place_in % 8)).cast("int") % 2
    return met.select(*(rows[c] for c in rows.columns), F.coalesce(bit == 1, F.lit(False)).alias(name))

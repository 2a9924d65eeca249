"""Recovery points: tables written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Scratch folders of this process, oldest first.
SCRATCH: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`.

    Only where a session names none and runs in one process (tests) is a temporary folder
    made and set; a cluster has to name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lexforge-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, which `clear` removes."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    SCRATCH.append(path)
    return path


def clear(spark: SparkSession, *paths: str) -> None:
    """Remove scratch folders, all that this process has made if none is named; only when no result that reads them is needed any more."""
    for path in paths or tuple(SCRATCH):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        SCRATCH.remove(path)


def settle(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage at files every executor sees, so that a lost executor costs
    the tasks it was running and nothing upstream.
    """
    path = scratch(df.sparkSession, label)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

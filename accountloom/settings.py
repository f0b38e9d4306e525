"""Session settings the plans rely on, and where scratch tables may be written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

MIB = 1024 * 1024

# Timestamps are zone-less text, read as UTC. Skewed join partitions are split
# even where that costs one more shuffle. The lookup of over-full keys is
# broadcast after a pass over a table's key column, which may take a while. Counts
# come from Parquet footers where the reader can tell them.
PLAN_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.broadcastTimeout": "7200",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.aggregatePushdown": "true",
}

SHUFFLE_PARTITION_BYTES = 256 * MIB
MAX_SHUFFLE_PARTITIONS = 200_000
SCAN_TASKS = 200_000
MAX_SPLIT_BYTES = 1024 * MIB


def apply_plan_settings(spark: SparkSession) -> SparkSession:
    for name, value in PLAN_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app_name: str = "accountloom", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return apply_plan_settings(builder.getOrCreate())


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the length of a block."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def planned_bytes(df: DataFrame) -> int:
    """Size of a frame as the optimizer estimates it; files count as stored. Runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of all files under the paths, from the listing a read of them makes anyway."""
    files = spark.read.format("text").option("recursiveFileLookup", "true").load(list(paths))
    return planned_bytes(files)


def size_for(spark: SparkSession, input_bytes: int) -> None:
    """Raise shuffle and scan sizes to fit the input; never lower what is set.

    Adaptive execution merges partitions that turn out small but cannot add any,
    so the number to start from has to follow the data: 256 MB each, and above
    50 TB as many as a shuffle can still track, half a gigabyte each at 100 TB.
    """
    wanted = min(-(-input_bytes // SHUFFLE_PARTITION_BYTES), MAX_SHUFFLE_PARTITIONS)
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.shuffle.partitions", str(max(current, wanted)))

    split = min(-(-input_bytes // SCAN_TASKS), MAX_SPLIT_BYTES)
    if split > 128 * MIB:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))


@lru_cache(maxsize=None)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="accountloom-")


def is_local(spark: SparkSession) -> bool:
    """Whether all executors share this machine; local-cluster's have folders of their own."""
    master = spark.conf.get("spark.master", "")
    return master.startswith("local") and not master.startswith("local-cluster")


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder that every executor can reach.

    It lies in the folder the cluster names in spark.checkpoint.dir. Only a
    local session, whose executors share this machine, may go without.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = _local_scratch()
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"

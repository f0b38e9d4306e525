"""What the operators of this package share."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountloom.settings import scratch_folder

# Functions that run in tasks travel with their code, so executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules["accountloom.llm"])

# Whole texts travel in Arrow batches; a batch ends at either bound, so memory
# holds few rows of long texts. A row longer than the bound is a batch by itself.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * 1024 * 1024),
    "spark.sql.execution.pythonUDF.arrow.enabled": "true",
    "spark.sql.execution.pyspark.udf.faulthandler.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """The frame written to the shared scratch folder and read again.

    This cuts the lineage at files that outlive any executor. options are the writer's.
    """
    path = scratch_folder(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True where crc32 of the id as text falls in the fold; a null id never does."""
    inside = F.crc32(doc_id.cast("string").cast("binary")) % folds == fold
    return F.coalesce(inside, F.lit(False))

"""Shared scratch space: lineage is cut in folders that all executors see."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

TEXTS_PER_BATCH = 1000


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder in the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch").rstrip("/")


def materialised(df: DataFrame) -> DataFrame:
    """Runs ``df`` once and goes on from a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Writes ``df`` as a Parquet table in the shared folder and reads it back."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_batches(spark: SparkSession) -> None:
    """Hands whole texts to Python workers a thousand at a time; Spark's ten thousand would fill their memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > TEXTS_PER_BATCH:
        spark.conf.set(name, str(TEXTS_PER_BATCH))


def shuffle_width(spark: SparkSession) -> int:
    """How many buckets packed rows are dealt over: the session's shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def importable(spark: SparkSession) -> None:
    """Lets Python workers import the library from where the driver has it, unless a path is set for them."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))

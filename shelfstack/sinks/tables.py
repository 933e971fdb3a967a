"""Loads into the layer databases."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def ensure_layers(spark: SparkSession, *layers: str) -> None:
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def save_table(
    df: DataFrame,
    layer: str,
    table: str,
    mode: str = "overwrite",
    partition_by: str | None = None,
) -> None:
    """Writes ``layer.table``: ``overwrite`` drops and recreates it, ``append`` adds rows. Files are compressed with zstd."""
    writer = df.write.mode(mode).format("parquet").option("compression", "zstd")
    if partition_by and partition_by in df.columns:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(f"{layer}.{table}")


def add_columns(spark: SparkSession, layer: str, table: str, schema: T.StructType) -> None:
    """Adds the columns of ``schema`` that the table does not have; older rows have NULLs there."""
    known = spark.table(f"{layer}.{table}").columns
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in known]
    if new:
        spark.sql(f"ALTER TABLE {layer}.{table} ADD COLUMNS ({', '.join(new)})")


def create_view(spark: SparkSession, layer: str, view: str, sql: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {layer}.{view} AS {sql}")


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    properties: Mapping[str, str] | None = None,
    max_connections: int = 16,
) -> None:
    """Loads a relational table; at most ``max_connections`` tasks write at once."""
    (
        df.write.mode(mode)
        .option("numPartitions", max_connections)
        .options(**dict(properties or {}))
        .option("url", url)
        .option("dbtable", table)
        .format("jdbc")
        .save()
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, doubled quotes and untouched blanks; ``read_csv`` reads it back."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None
) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)

"""Reads from the layer databases and from their catalog."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, layer: str, table: str) -> DataFrame:
    return spark.table(f"{layer}.{table}")


def run_sql(spark: SparkSession, sql: str, params: Mapping[str, Any] | None = None) -> DataFrame:
    """Runs SQL text; ``params`` fill its ``:name`` markers."""
    return spark.sql(sql, args=dict(params)) if params else spark.sql(sql)


def list_tables(spark: SparkSession, layer: str) -> DataFrame:
    """Tables and views of a layer, by name."""
    return (
        spark.sql(f"SHOW TABLES IN {layer}")
        .filter(~F.col("isTemporary"))
        .select(F.col("namespace").alias("schemaname"), F.col("tableName").alias("table_name"))
        .orderBy("table_name")
    )


def list_columns(spark: SparkSession, layer: str, table: str) -> DataFrame:
    """Columns of a table in their order."""
    return column_frame(spark.table(f"{layer}.{table}"))


def column_frame(df: DataFrame) -> DataFrame:
    """The schema of a frame as rows."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, start=1)]
    return df.sparkSession.createDataFrame(
        rows, "ordinal_position int, column_name string, data_type string"
    ).orderBy("ordinal_position")


def count_columns(spark: SparkSession, layer: str, table: str) -> int:
    return len(spark.table(f"{layer}.{table}").columns)


def tables_per_layer(spark: SparkSession, layers: tuple[str, ...]) -> DataFrame:
    """Number of tables, views left out, in each layer."""
    def tables(layer: str) -> DataFrame:
        views = (
            spark.sql(f"SHOW VIEWS IN {layer}")
            .filter(~F.col("isTemporary"))
            .select(F.col("viewName").alias("table_name"))
        )
        return list_tables(spark, layer).join(views, "table_name", "left_anti")

    found = reduce(DataFrame.unionByName, [tables(layer) for layer in layers])
    return found.groupBy("schemaname").agg(F.count("*").alias("nb_tables")).orderBy("schemaname")

"""Loads only the files that arrived since the last run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfstack.settings import Settings
from shelfstack.sinks.tables import add_columns, save_table
from shelfstack.sinks.upsert import upsert_table
from shelfstack.sources.files import (
    RESCUE_OPTIONS, bronze_types, cells_schema, csv_cells, csv_options, json_lines, kept_schema, read_dataset,
)
from shelfstack.sources.registry import Dataset


def new_files(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet"
) -> DataFrame:
    """A stream over the files of ``path``; a stream needs its schema up front."""
    reader = spark.readStream.schema(schema).format(file_format)
    if file_format == "csv":
        reader = reader.option("header", True).option("escape", '"')
    if file_format == "parquet":
        reader = reader.option("pathGlobFilter", "*.parquet")
    return reader.load(path)


def append_new_files(
    stream: DataFrame, layer: str, table: str, checkpoint: str, partition_by: str | None = None
) -> StreamingQuery:
    """Appends every file once: ``checkpoint`` remembers the files of earlier runs."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(f"{layer}.{table}")
    )


def upsert_new_files(
    stream: DataFrame,
    layer: str,
    table: str,
    checkpoint: str,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    partition_by: str | None = None,
) -> StreamingQuery:
    """Upserts new files by key; a batch that is replayed after a failure changes nothing."""
    def load(batch: DataFrame, _: int) -> None:
        upsert_table(batch.sparkSession, layer, table, batch, keys, order_by, partition_by)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def bronze_stream(spark: SparkSession, settings: Settings, dataset: Dataset) -> DataFrame:
    """A stream over the files of a dataset under the rules of the Bronze layer.

    NA words, documented types and the rescue column are those of ``read_dataset``. The columns are tracked by the
    Bronze table: CSV files whose header differs stop the stream, new JSON fields are rescued and become columns
    with the next run, Parquet columns are read as the table has them. Without a table yet, the files that are
    there say what the columns are.
    """
    if not settings.rescue:
        raise ValueError("a stream needs a rescue column: it can't look at the files twice")
    path, types = f"{settings.raw_root.rstrip('/')}/{dataset.key}", bronze_types(dataset)
    name = f"{settings.bronze}.{dataset.bronze}"
    known = spark.table(name) if spark.catalog.tableExists(name) else None
    if dataset.format == "csv":
        columns = [c for c in known.columns if c != settings.rescue] if known else spark.read.options(**csv_options()).csv(path).columns
        reader = spark.readStream.options(**csv_options(settings.multiline_csv), **RESCUE_OPTIONS)
        return csv_cells(reader.schema(cells_schema(columns)).csv(path), types, settings.na_tokens, settings.na_exempt, settings.rescue)
    if dataset.format == "jsonl":
        schema = kept_schema(known, settings.rescue) if known else spark.read.json(path).schema
        return json_lines(spark.readStream.text(path), schema, types, settings.rescue)
    schema = (known or read_dataset(spark, settings, dataset)).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path)


def ingest_new_files(spark: SparkSession, settings: Settings, dataset: Dataset, checkpoint: str) -> None:
    """Loads the files that arrived since the last run into the Bronze table, and returns when they are in.

    ``settings.mode`` ``upsert`` takes the newest row per key; the other modes append. A run that died goes on
    where it stopped: the checkpoint knows the files, and the file sink's log the batches that are in.
    """
    stream = bronze_stream(spark, settings, dataset)
    name = f"{settings.bronze}.{dataset.bronze}"
    if spark.catalog.tableExists(name):
        add_columns(spark, settings.bronze, dataset.bronze, stream.schema)
    if settings.mode == "upsert":
        order_by = [dataset.order_by] if dataset.order_by in stream.columns else []
        query = upsert_new_files(stream, settings.bronze, dataset.bronze, checkpoint, [dataset.primary_key], order_by, dataset.partition_by)
    else:
        if not spark.catalog.tableExists(name):
            empty = spark.createDataFrame([], stream.schema)
            save_table(empty, settings.bronze, dataset.bronze, partition_by=dataset.partition_by)
        query = append_new_files(stream, settings.bronze, dataset.bronze, checkpoint, dataset.partition_by)
    query.awaitTermination()
    spark.catalog.refreshTable(name)  # batches are written by a session of the stream's own

"""Unions of tables and comparisons of column sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfstack.operators.columns import INTERNAL_PREFIX
from shelfstack.sources.tables import column_frame


def stack_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows, columns matched by name, missing ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ])


def removed_columns(before: DataFrame, after: DataFrame) -> DataFrame:
    """Names of the columns that ``after`` no longer has."""
    names = [column_frame(df).select("column_name") for df in (before, after)]
    return names[0].exceptAll(names[1])


def leaked_columns(before: DataFrame, after: DataFrame) -> DataFrame:
    """Internal columns of ``before`` that are still in ``after``; should be empty."""
    internal = column_frame(before).filter(F.col("column_name").startswith(INTERNAL_PREFIX))
    return internal.select("column_name").intersect(column_frame(after).select("column_name"))

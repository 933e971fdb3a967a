"""Ordering, top-k and the order of events within a session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

def ascending(name: str) -> Column:
    """Ascending, NULLs last."""
    return F.col(name).asc_nulls_last()


def descending(name: str) -> Column:
    """Descending, NULLs first."""
    return F.col(name).desc_nulls_first()


def top_k(df: DataFrame, by: str, k: int, tie_breaker: str) -> DataFrame:
    """The ``k`` first rows by descending ``by``, NULLs first; each task keeps ``k`` rows, nothing is sorted whole."""
    return df.orderBy(descending(by), ascending(tie_breaker)).limit(k)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first few rows, for a look at a table."""
    return df.limit(rows)


def number_events(
    df: DataFrame, session: str, ts: str, event: str, name: str = "event_seq", slice_unit: str = "minute"
) -> DataFrame:
    """Adds the position (1, 2, ...) of each event in its session, by ``ts`` then ``event``.

    A session is ranked slice by slice, so that one with a large share of all events is not ranked
    by a single task: the position is the number of events in the earlier slices plus the rank
    within the slice. Events without a stamp come first, in slices of neighbouring ``event`` values; rows
    without a session get NULL and are dealt over slices of their own.
    """
    part, rows, before = "__slice", "__rows", "__before"
    # Units since 1970 and not truncated stamps: those of stamps without a zone depend on the session's.
    since_1970 = F.col(ts) - F.lit("1970-01-01 00:00:00").cast(df.schema[ts].dataType)
    unit = since_1970.cast(f"interval {slice_unit}").cast("bigint")
    no_session = F.struct(F.lit(False).alias("stamped"), F.pmod(F.xxhash64(event), F.lit(1024)).alias("unit"))
    stamped = F.struct(unit.isNotNull().alias("stamped"), F.coalesce(unit, _neighbourhood(df, event)).alias("unit"))
    sliced = df.withColumn(part, F.when(F.col(session).isNull(), no_session).otherwise(stamped))
    earlier = Window.partitionBy(session).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.filter(F.col(session).isNotNull())
        .groupBy(session, part).agg(F.count("*").alias(rows))
        .select(session, part, F.coalesce(F.sum(rows).over(earlier), F.lit(0)).alias(before))
    )
    in_slice = Window.partitionBy(session, part).orderBy(F.col(ts).asc_nulls_first(), F.col(event))
    return (
        sliced.withColumn(name, F.row_number().over(in_slice))
        .join(offsets, [session, part], "left")
        .withColumn(name, F.col(name) + F.col(before))
        .select(*df.columns, name)
    )


def _neighbourhood(df: DataFrame, name: str, width: int = 256) -> Column:
    """A number that never falls as ``name`` rises: by ``width`` for whole numbers, else by the first four bytes."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.coalesce(F.floor(col / width), F.lit(-(2**63)))
    if isinstance(df.schema[name].dataType, T.StringType):
        first = F.substring(F.rpad(F.hex(col.cast("binary")), 8, "0"), 1, 8)
        return F.coalesce(F.conv(first, 16, 10).cast("bigint"), F.lit(-1))
    return F.lit(0).cast("bigint")

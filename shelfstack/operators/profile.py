"""Frequency tables and column profiles."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

LARGEST = sys.float_info.max
QUARTILES = {"p25": 0.25, "p50": 0.50, "p75": 0.75}


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of ``column``."""
    return df.groupBy(column).agg(F.count("*").alias("cnt"))


def shape(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count("*").alias("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns"))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def column_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per column: type, rows, NULLs and distinct values.

    Exact distinct counts shuffle every distinct value as text, and count a frequent value once per task. ``exact=False`` takes sketches instead and shuffles one row per task.
    """
    kinds = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    names = df.columns
    if exact:
        cells = df.select(*[_comparable(f).alias(f.name) for f in df.schema.fields])
        values = (
            cells.unpivot([], names, "column_name", "value")
            .groupBy("column_name", "value").agg(F.count("*").alias("n"))
        )
        profile = values.groupBy("column_name").agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count("value").alias("distinct_values"),
        )
    else:
        profile = df.agg(*[
            F.struct(
                F.count("*").alias("rows"),
                F.count_if(F.col(name).isNull()).alias("nulls"),
                F.approx_count_distinct(F.col(name)).alias("distinct_values"),
            ).alias(name)
            for name in names
        ]).unpivot([], names, "column_name", "counts").select("column_name", "counts.*")
    return profile.withColumn("data_type", kinds[F.col("column_name")])


def _comparable(field: T.StructField) -> Column:
    """The value as text that is the same for equal values only."""
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
        text = F.to_json(col)
    elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        text = (col + 0.0).cast("string")  # -0.0 equals 0.0
    else:
        text = col.cast("string")
    return text


def numeric_profile(
    df: DataFrame, columns: Sequence[str], exact: bool = True, margin: float = 0.0005, pieces: int = 1000,
    most_rows: int = 1_000_000,
) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum of numeric columns.

    Quartiles interpolate between the two nearest values. A quantile sketch brackets each of them
    ``margin`` below and above, and every bracket is cut into ``pieces`` of equal width. Rows are
    counted per piece, and a piece that holds a quartile is cut again, between its own least and greatest
    value, until it has at most ``most_rows`` rows or one value only. The values left are counted and ranked,
    however they cluster, by tasks that see no more than one such piece. Wherever the pieces end, the ranks are
    counted, not estimated. ``exact=False`` returns the quartiles of the sketch.
    """
    values = (
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], list(columns), "column_name", "value")
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
    )
    cuts = [p + side for p in QUARTILES.values() for side in (-margin, margin)] if exact else list(QUARTILES.values())
    sketch = F.percentile_approx("value", F.array(*[F.lit(c) for c in cuts]), F.lit(max(10000, int(5 / margin))))
    stats = values.groupBy("column_name").agg(
        F.count("*").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        sketch.alias("cuts"),
    )
    summary = F.struct("count", "mean", "std", "min", "max").alias("summary")
    if exact:
        edges = F.concat(F.array("min"), "cuts", F.array("max")).alias("edges")
        found = _exact_quartiles(values, stats.select("column_name", summary, edges), len(cuts), pieces, most_rows)
    else:
        sketched = [F.col("cuts")[i].alias(name) for i, name in enumerate(QUARTILES)]
        found = stats.select("column_name", summary, *sketched)
    return found.select(
        "column_name", "summary.count", "summary.mean", "summary.std", "summary.min", *QUARTILES, "summary.max"
    )


def _exact_quartiles(values: DataFrame, stats: DataFrame, cuts: int, pieces: int, most_rows: int) -> DataFrame:
    # One row per profiled column: safe to broadcast at any data size.
    edges = F.broadcast(stats.select("column_name", "edges"))
    placed = values.join(edges, "column_name").select("column_name", "value", _piece(cuts, pieces).alias("piece"))
    filled = _filled(placed, "column_name").withColumn("first", F.lit(0).cast("bigint"))
    sizes = stats.select("column_name", F.col("summary.count").alias("total"))
    brackets = _holding(filled, sizes)
    while any(b["rows"] > most_rows and b["low"] < b["high"] for b in brackets):
        held = _bracket_frame(values, brackets).select("column_name", "low", "high", F.col("before").alias("first"))
        inside = values.join(F.broadcast(held), "column_name").filter(F.col("value").between(F.col("low"), F.col("high")))
        # Halves of finite values, so that no difference overflows.
        half = lambda name: F.greatest(F.least(F.col(name), F.lit(LARGEST)), F.lit(-LARGEST)) / 2
        share = F.coalesce((half("value") - half("low")) / F.nullif(half("high") - half("low"), F.lit(0.0)), F.lit(0.0))
        parts = max(pieces, 2)  # the least and the greatest value part, whatever lies between them
        piece = F.least(F.floor(share * parts), F.lit(parts - 1)).alias("piece")
        cut = _filled(inside.select("column_name", "first", "value", piece), "column_name", "first")
        before, brackets = brackets, _holding(cut, sizes)
        if sorted(before) == sorted(brackets):  # an infinity beside the largest number: nothing between them
            break
    table = F.broadcast(_bracket_frame(values, brackets).join(stats.select("column_name", "summary"), "column_name"))
    single = table.filter("low = high").select(
        "column_name", F.col("low").alias("value"), F.col("rows").alias("n"), F.col("before").alias("start"), "summary")
    # Of all values, only those of the brackets are shuffled, equal ones as one row.
    counted = values.join(table.filter("low < high"), "column_name").filter(F.col("value").between(F.col("low"), F.col("high"))).groupBy(
        "column_name", "low", "value").agg(F.count("*").alias("n"), F.first("before").alias("before"), F.first("summary").alias("summary"))
    start = F.col("before") + _running("n", Window.partitionBy("column_name", "low").orderBy("value"))
    ranked = counted.select("column_name", "value", "n", start.alias("start"), "summary").unionByName(single)
    last = F.col("summary.count") - 1
    lows = {name: F.floor(last * p) for name, p in QUARTILES.items()}
    highs = {name: F.ceil(last * p) for name, p in QUARTILES.items()}

    def at(position: Column) -> Column:
        covers = (position >= F.col("start")) & (position < F.col("start") + F.col("n"))
        return F.max(F.when(covers, F.col("value")))

    found = ranked.groupBy("column_name").agg(
        F.first("summary").alias("summary"),
        *[at(position).alias(f"{name}_low") for name, position in lows.items()],
        *[at(position).alias(f"{name}_high") for name, position in highs.items()],
    )

    def between(name: str, p: float) -> Column:
        share = last * p - F.floor(last * p)
        low = F.col(f"{name}_low")
        return (low + (F.col(f"{name}_high") - low) * share).alias(name)

    return found.select("column_name", "summary", *[between(name, p) for name, p in QUARTILES.items()])


def _filled(placed: DataFrame, *of: str) -> DataFrame:
    """Per piece: its rows, its least and greatest value, and the rows of earlier pieces."""
    counted = placed.groupBy(*of, "piece").agg(
        F.count("*").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high"))
    return counted.withColumn("earlier", _running("rows", Window.partitionBy(*of).orderBy("piece")))


def _holding(filled: DataFrame, sizes: DataFrame) -> list[Row]:
    """The pieces that hold a quartile: at most two per quartile and column."""
    before, last = F.col("first") + F.col("earlier"), F.col("total") - 1
    held = F.lit(False)
    for p in QUARTILES.values():
        for position in (F.floor(last * p), F.ceil(last * p)):
            held = held | ((position >= before) & (position < before + F.col("rows")))
    return filled.join(F.broadcast(sizes), "column_name").filter(held).select(
        "column_name", "low", "high", before.alias("before"), "rows").collect()


def _bracket_frame(values: DataFrame, brackets: list[Row]) -> DataFrame:
    return values.sparkSession.createDataFrame(
        [tuple(b) for b in brackets], "column_name string, low double, high double, before bigint, rows bigint")


def _piece(cuts: int, pieces: int) -> Column:
    """Number of the piece that holds ``value``; it never falls as the value rises."""
    value, edge = F.col("value"), [F.col("edges")[i] for i in range(cuts + 2)]

    def within(i: int) -> Column:
        width = F.nullif(edge[i + 1] - edge[i], F.lit(0.0))
        share = F.floor((value - edge[i]) / width * pieces)
        return F.least(F.coalesce(share, F.lit(0)), F.lit(pieces - 1)) + i * pieces

    number = F.when(value <= edge[1], within(0))
    for i in range(1, cuts):
        number = number.when(value <= edge[i + 1], within(i))
    return number.otherwise(within(cuts))


def _running(column: str, window: WindowSpec) -> Column:
    """Sum of ``column`` over the rows before this one."""
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(earlier), F.lit(0))

"""Typed values: numbers, flags, dates, amounts, masked and nested fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfstack.settings import OUTGOING_MOVEMENTS

# Cents are counted in 64 bits.
MOST_CENTS = 2.0**63


def number(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a number whose NaN is NULL (Spark sorts NaN above every number)."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return nan_to_null(F.col(name).try_cast("double"))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return nan_to_null(F.col(name))
    return F.col(name)


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def is_number(df: DataFrame, name: str) -> Column:
    """True unless ``name`` holds NaN; kept apart from range filters so that those reach the scan."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return ~F.isnan(name)
    return F.lit(True)


def flag(col: Column) -> Column:
    """Boolean from 0/1, numbers, or words such as ``true`` and ``No``; anything else, and NULL, is false."""
    text = col.cast("string")
    amount = nan_to_null(text.try_cast("double"))
    return F.coalesce(text.try_cast("boolean"), amount != 0, F.lit(False))


def whole_number(col: Column) -> Column:
    """Text such as ``7`` or ``7.0`` as a bigint, NULL when it is not a whole number."""
    return F.regexp_replace(col, r"\.0+$", "").try_cast("bigint")


def cents(col: Column) -> Column:
    """An amount in dollars as whole cents, halves rounded away from zero.

    Sums of whole cents do not depend on the order of the rows, and cost a fraction of decimal sums.
    NaN is NULL, as it is no amount. An infinity, or a size beyond 64 bits of cents, stops the query: it
    can't be summed, and leaving it out would change totals without a trace.
    """
    size = F.abs(col) * 100 + 0.5
    whole = F.floor(size)
    signed = F.when(col < 0, -whole).otherwise(whole)
    too_large = F.raise_error(F.concat(F.lit("amount out of range: "), col.cast("string"))).cast("bigint")
    return F.when(size < MOST_CENTS, signed).when(F.isnan(size), F.lit(None)).when(size >= MOST_CENTS, too_large)


def dollars(col: Column) -> Column:
    return col.cast("double") / 100


def total_of(col: Column) -> Column:
    """Sum of amounts that are sums already: few, and too large for cents in a double perhaps."""
    return F.sum(nan_to_null(col).cast("decimal(38,2)")).cast("double")


def rounded(col: Column, places: int = 2) -> Column:
    return F.round(col.cast("decimal(38,6)"), places).cast("double")


def whole_days(start: Column, end: Column) -> Column:
    """Full 24-hour days between two stamps (26 hours are one day)."""
    return F.extract(F.lit("DAY"), end - start).cast("bigint")


def signed_quantity(movement_type: Column, quantity: Column) -> Column:
    """Stock effect of a movement: outgoing types count down, all others up."""
    size = F.abs(quantity)
    return F.when(movement_type.isin(*OUTGOING_MOVEMENTS), -size).otherwise(size)


def string_list(col: Column) -> Column:
    """A JSON list of strings; NULL when the text is not one."""
    return F.from_json(col, "array<string>")


def string_map(col: Column) -> Column:
    """A flat JSON object as a map; NULL when the text is not one."""
    return F.from_json(col, "map<string,string>")


def digest(col: Column) -> Column:
    return F.sha2(col.cast("string"), 256)

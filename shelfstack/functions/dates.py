"""Dates as text in several formats: which ones a column has, and each row as a stamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The formats that are read besides ISO, with an optional time after a blank or "T".
TIME = r"([ T].*)?$"
YEAR_FIRST = r"^(\d{4})/(\d{1,2})/(\d{1,2})" + TIME
COMPACT = r"^(\d{4})(\d{2})(\d{2})$"
DOTTED = r"^(\d{1,2})\.(\d{1,2})\.(\d{4})" + TIME
SLASHED = r"^(\d{1,2})/(\d{1,2})/(\d{4})" + TIME
OFFSET = r":\d{2}(?:\.\d+)?\s*(Z|[+-]\d{2}(?::?\d{2})?)$"


def parse_timestamp(col: Column, day_first: bool | None = None) -> Column:
    """A date or stamp, each row by itself, without a zone; NULL where it can't be read.

    Read are ISO dates, ``2024/1/15``, ``20240115``, ``15.1.2024`` and ``15/1/2024``, each but the third with or
    without a time. A stamp with an offset is converted to UTC. Of two numbers before a slashed year, ``day_first``
    says which is the day; unless it is given, the one above 12 is, and other dates of that kind are NULL.
    """
    text = F.trim(col.cast("string"))
    # The cast alone would also take "2026" and "2026-2"; the two dashes ask for a full date.
    iso = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    first, second = _slashed(text)
    day, month = (first, second) if day_first else (second, first)
    if day_first is None:
        told = (first > 12) | (second > 12) | (first == second)
        day = F.when(told, F.greatest(first, second))
        month = F.when(told, F.least(first, second))
    return (
        F.when(iso, _stamp(text))
        .when(text.rlike(YEAR_FIRST), _dated(text, YEAR_FIRST, 1, 2, 3, 4))
        .when(text.rlike(COMPACT), _dated(text, COMPACT, 1, 2, 3, None))
        .when(text.rlike(DOTTED), _dated(text, DOTTED, 3, 2, 1, 4))
        .when(text.rlike(SLASHED), _joined(
            F.regexp_extract(text, SLASHED, 3), month.cast("string"), day.cast("string"), F.regexp_extract(text, SLASHED, 4)))
    )


def _slashed(text: Column) -> tuple[Column, Column]:
    return tuple(F.regexp_extract(text, SLASHED, i).try_cast("int") for i in (1, 2))


def _dated(text: Column, pattern: str, year: int, month: int, day: int, time: int | None) -> Column:
    part = lambda i: F.regexp_extract(text, pattern, i)
    return _joined(part(year), part(month), part(day), part(time) if time else F.lit(""))


def _joined(year: Column, month: Column, day: Column, time: Column) -> Column:
    return _stamp(F.concat(year, F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(day, 2, "0"), time))


def _stamp(iso: Column) -> Column:
    """An ISO text as a stamp; one with an offset is moved by it, whatever the session's zone."""
    offset = F.regexp_extract(iso, OFFSET, 1)
    local = F.regexp_replace(iso, r"\s*(Z|[+-]\d{2}(:?\d{2})?)$", "").try_cast("timestamp_ntz")
    minutes = F.substring(offset, 2, 2).try_cast("int") * 60 + F.coalesce(F.regexp_extract(offset, r"(\d{2})$", 1).try_cast("int"), F.lit(0)) * F.when(F.length(offset) > 3, 1).otherwise(0)
    signed = F.when(F.substring(offset, 1, 1) == "-", -minutes).otherwise(minutes)
    moved = local - F.make_dt_interval(F.lit(0), F.lit(0), F.coalesce(signed, F.lit(0)))
    return F.when(offset == "", iso.try_cast("timestamp_ntz")).otherwise(moved)


def is_ambiguous(col: Column) -> Column:
    """A date such as ``3/4/2024`` that does not say by itself which number is the day."""
    first, second = _slashed(F.trim(col.cast("string")))
    return F.coalesce((first <= 12) & (second <= 12) & (first != second), F.lit(False))


def date_formats(df: DataFrame, name: str) -> DataFrame:
    """How many values of a column have each format: ``format, cnt``. One pass."""
    text = F.trim(F.col(name).cast("string"))
    first, second = _slashed(text)
    kind = (
        F.when(text.isNull(), "missing")
        .when((F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-"), F.when(text.rlike(OFFSET), "iso_offset").otherwise("iso"))
        .when(text.rlike(YEAR_FIRST), "year_first").when(text.rlike(COMPACT), "compact").when(text.rlike(DOTTED), "dotted")
        .when(text.rlike(SLASHED), F.when(first > 12, "day_first").when(second > 12, "month_first").otherwise("ambiguous"))
        .otherwise("other")
    )
    return df.groupBy(kind.alias("format")).agg(F.count("*").alias("cnt"))


def day_first(df: DataFrame, name: str) -> bool | None:
    """Whether the slashed dates of a column have the day first; None where none says so, or they disagree."""
    counts = {row["format"]: row["cnt"] for row in date_formats(df, name).collect()}  # one row per format
    days, months = counts.get("day_first", 0), counts.get("month_first", 0)
    return None if bool(days) == bool(months) else days > 0

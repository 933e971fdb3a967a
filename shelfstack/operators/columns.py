"""Projections: internal columns, guards, renames, fills, masks."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfstack.functions.text import phone_country
from shelfstack.functions.values import digest, rounded

INTERNAL_PREFIX = "_"


def internal_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(INTERNAL_PREFIX)]


def drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(*internal_columns(df))


def has_columns(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


def fill(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Constants for NULL, in the columns that are present."""
    present = {name: value for name, value in values.items() if name in df.columns}
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(value)) for name, value in present.items()})


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def mask(df: DataFrame, policy: Mapping[str, str]) -> DataFrame:
    """Applies ``drop``, ``hash`` or ``phone_country`` to the named columns that are present."""
    masks = {"hash": digest, "phone_country": phone_country}
    present = {name: action for name, action in policy.items() if name in df.columns}
    unknown = {action for action in present.values() if action != "drop" and action not in masks}
    if unknown:
        raise ValueError(f"unknown mask {sorted(unknown)}")
    masked = {name: masks[a](F.col(name)) for name, a in present.items() if a != "drop"}
    return df.withColumns(masked).drop(*[name for name, a in present.items() if a == "drop"])


def presentable(df: DataFrame, amounts: tuple[str, ...], counts: tuple[str, ...] = ()) -> DataFrame:
    """Amounts rounded to cents, missing counts as 0."""
    return fill(df, {name: 0 for name in counts}).withColumns({name: rounded(F.col(name)) for name in amounts})

"""Nested carts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_items(carts: DataFrame, items: str = "items") -> DataFrame:
    """One row per cart item, its fields as columns; a cart without items keeps one row of NULLs."""
    others = [c for c in carts.columns if c != items]
    return carts.select(*others, F.explode_outer(items).alias("item")).select(*others, "item.*")

"""Connected components by alternating stars; no link or component passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfstack.llm.storage import materialised


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every end of ``links`` (``a``, ``b`` long): the smallest id reachable.

    Each round connects, for every node, first its larger and then its smaller neighbours to the smallest
    one, until nothing moves; every component is then a star around its smallest id. Rounds grow with the
    logarithm of the links. Links of a node with itself and repeated links change nothing.
    """
    edges = materialised(_downward(links.select("a", "b")))
    state = _state(edges)
    while state[0]:
        edges = materialised(_small_star(_large_star(edges)))
        state, before = _state(edges), state
        if state == before:
            break
    stars = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.union(stars.select("component", "component").distinct())


def _downward(links: DataFrame) -> DataFrame:
    """Each link once, from the larger to the smaller id."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return _downward(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return _downward(moved.union(least.select("a", "low")))


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first()
    return int(row[0]), int(row[1])

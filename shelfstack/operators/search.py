"""Typo correction of search queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfstack.functions.text import clean_query
from shelfstack.operators.joins import lookup

MAX_EDITS = 2


def correct_queries(
    events: DataFrame, vocabulary: DataFrame, query: str, term: str, event: str, max_edits: int = MAX_EDITS
) -> DataFrame:
    """Adds ``query_clean``, the nearest vocabulary term and its edit distance to every search.

    The nearest term has the fewest edits, at most ``max_edits``, and among equals comes first in
    the alphabet; without one the correction is NULL. Each distinct query is corrected once.
    """
    cleaned = events.withColumn("query_clean", clean_query(F.col(query)))
    queries = cleaned.select("query_clean").filter(F.col("query_clean").isNotNull()).distinct()
    terms = vocabulary.select(clean_query(F.col(term)).alias("term")).filter(F.col("term").isNotNull()).distinct()
    same = F.col("query_clean") == F.col("term")
    exact = queries.join(terms, same, "left_semi").select(
        "query_clean", F.col("query_clean").alias("query_corrected"), F.lit(0).alias("edit_distance")
    )
    typos = queries.join(terms, same, "left_anti")
    best = exact.unionByName(_nearest(typos, terms, max_edits))
    return lookup(cleaned, best, "query_clean", spread_by=event)


def _nearest(typos: DataFrame, terms: DataFrame, max_edits: int) -> DataFrame:
    """Best term per query; every candidate pair is compared once."""
    pairs = candidate_pairs(typos, terms, max_edits).withColumn(
        "edit_distance", F.levenshtein("query_clean", "term", max_edits))
    return (
        pairs.filter(F.col("edit_distance") >= 0)
        .groupBy("query_clean").agg(F.min(F.struct("edit_distance", "term")).alias("best"))
        .select("query_clean", F.col("best.term").alias("query_corrected"), "best.edit_distance")
    )


def candidate_pairs(typos: DataFrame, terms: DataFrame, max_edits: int) -> DataFrame:
    """Pairs of ``query_clean`` and ``term`` that could be within ``max_edits``, each once.

    A term is cut into one segment more than there are edits, so one segment is untouched. It then stands in the
    query, moved by no more places than the edits left and right of it can make up for. A term is as many rows
    as it has segments; the rows of a query depend on ``max_edits`` alone, not on its length.
    """
    found = segments(terms, max_edits).join(_probes(typos, max_edits), "segment")
    return found.select("query_clean", "term").distinct()


def segments(terms: DataFrame, max_edits: int) -> DataFrame:
    """``term`` and the hash of each of its segments, with the segment's number and the term's length."""
    size = F.length("term")
    keys = F.array(*[_key(i, size, F.substring("term", *_place(size, i, max_edits))) for i in range(max_edits + 1)])
    return terms.select("term", F.explode(keys).alias("segment"))


def _place(size: Column, i: int, max_edits: int) -> tuple[Column, Column]:
    """First place and length of segment ``i`` of a string; the later ones take what does not divide."""
    parts = max_edits + 1
    short = F.floor(size / parts).cast("int")
    longer = parts - size % parts  # segments before this one have the short length
    return i * short + F.greatest(F.lit(0), F.lit(i) - longer) + 1, short + F.when(F.lit(i) >= longer, 1).otherwise(0)


def _key(i: int, size: Column, text: Column) -> Column:
    return F.xxhash64(F.lit(i), size.cast("int"), text)


def _probes(queries: DataFrame, max_edits: int) -> DataFrame:
    """``query_clean`` and the hashes of all its substrings that can be a segment of a term within reach."""
    own = F.length("query_clean")
    lengths = queries.select("query_clean", F.explode(F.sequence(F.greatest(own - max_edits, F.lit(0)), own + max_edits)).alias("size"))
    size, more = F.col("size"), own - F.col("size")

    def of_segment(i: int) -> Column:
        start, length = _place(size, i, max_edits)
        low = F.greatest(F.lit(1), start - F.floor((max_edits - more) / 2).cast("int"))
        high = F.least(own - length + 1, start + F.floor((max_edits + more) / 2).cast("int"))
        places = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda at: _key(i, size, F.substring("query_clean", at, length)))

    keys = F.array_distinct(F.flatten(F.array(*[of_segment(i) for i in range(max_edits + 1)])))
    return lengths.select("query_clean", F.explode(keys).alias("segment"))

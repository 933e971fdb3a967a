"""Mixing sources to target weights with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfstack.llm.storage import materialised

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix"
BROADCAST_SOURCES = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_REPEATS) -> DataFrame:
    """One row per source: ``source_size`` and ``target``.

    ``sizes`` has a row per source with its ``source_size``. Sources take their weights in turn, by code
    point with null last, and share the whole size in proportion. A target stops at ``most`` times its
    source's size; what is over goes to the others by weight until none is above. That end state is read
    off directly: with sources ordered by how soon their cap is met, the first ``k`` are capped, where ``k``
    is the smallest number for which the common level of the rest stays under the next cap. The window is
    over one row per source.
    """
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    soon = Window.orderBy(F.col("cap") / F.col("weight"), F.col("turn"))
    before = soon.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = (
        sizes.withColumn("turn", F.row_number().over(turn) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("turn") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * most)
    )
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (
        ranked.withColumn("level", left / rest)
        .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("common", F.max(F.when(F.col("fits"), F.struct(-F.row_number().over(soon), "level"))).over(everything)["level"])
    )
    target = F.least(F.col("weight") * F.col("common"), F.col("cap").cast("double"))
    return level.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def copies(source_size: str, target: str, key: Column, seed: str = SEED) -> Column:
    """``floor(rate)`` plus one Bernoulli copy: 52 bits of the key's hash fall under the fraction."""
    rate = F.when(F.col(source_size) > 0, F.col(target) / F.col(source_size)).otherwise(F.lit(0.0))
    digest = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
    drawn = F.conv(digest, 16, 10).cast("long") / F.lit(2.0**52)
    return (F.floor(rate) + F.when(drawn < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def with_targets(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """``docs`` with their source's size and target.

    Up to ``BROADCAST_SOURCES`` rows of targets are broadcast, so that documents are not shuffled and a hot
    source stays where it lies. More sources than that are joined on their key; Spark splits a hot one.
    """
    targets = materialised(targets.select(
        F.col("source").alias("__source"), F.col("source_size").alias("__size"), F.col("target").alias("__target")))
    small = targets.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    return docs.join(F.broadcast(targets) if small else targets, docs["source"].eqNullSafe(targets["__source"]), "left")


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """How often each document is taken: ``doc_id, source, size, source_size, target, copies, taken``.

    Size is the number of words. Null texts and texts without words have size 0 and take no words; a null
    source is a source of its own. Equal rows with one ``doc_id`` draw alike, so reruns agree; a null
    ``doc_id`` draws as the empty key. An empty table gives no rows; other columns are left alone.
    """
    sized = materialised(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    taken = with_targets(sized, targets).withColumn("copies", copies("__size", "__target", F.col("doc_id"), seed))
    return taken.select(
        "doc_id", "source", "size", F.col("__size").alias("source_size"), F.col("__target").alias("target"), "copies",
        (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """The mix itself: every document repeated as often as it is taken, with the columns it came with.

    Nulls and empty texts as in ``mixture``; a text without words is repeated at its source's rate.
    """
    sizes = docs.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("source_size"))
    rated = with_targets(docs, source_targets(sizes, weights, most))
    times = copies("__size", "__target", docs["doc_id"], seed)
    repeated = rated.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), times.cast("int"))))
    return repeated.select(*(docs[c] for c in docs.columns))

"""Cleans, deduplicates, mixes and encodes the documents, one written stage after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstack.llm import jaccard, language, mixing, pieces, suffixes
from shelfstack.llm.storage import importable, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told: no letters, or far from every centroid.

    The centroids learn from the documents' own labels. Documents without ``doc_id`` are judged like others;
    null and empty texts go. Repeated rows fare alike; other columns stay as they are, whatever their names.
    """
    model = language.fit(docs.select("doc_id", "text", "lang"))
    rows = docs.select("text", F.struct(*docs.columns).alias("row"))
    return language.identify(rows, model, "row").where(~F.col("rejected")).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest ``doc_id`` of each component of near copies: five-word shingles, Jaccard 0.8 or more.

    Of rows that repeat one ``doc_id`` with equal size all stay or all go; a null ``doc_id`` stays.
    """
    found = jaccard.jaccard_components(docs, n=5, percent=80)
    dropped = found.where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def cut_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes byte strings that start in a document with a smaller id as well; documents left empty go.

    What a cut leaves of a split character goes too. ``n_chars`` follows the text. A null or
    empty text stays as it is, other columns do, and a table without ``n_chars`` gets none.
    """
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select("doc_id", "text", F.struct(F.col("text").isNull().alias("__null"), *others).alias("row"))
    cut = suffixes.deduplicated(rows, "row", with_text=True).where("n_removed < n_bytes OR n_bytes = 0")
    text = F.when(~F.col("row.__null"), F.col("kept"))
    changed = {"text": text}
    if "n_chars" in others:
        changed["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return cut.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their sources' target weights.

    Null and empty texts have size 0 and are repeated at their source's rate; a null source is one of its own.
    """
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document; null and empty texts have none, repeated rows stay repeated."""
    return pieces.encoded(docs, "doc_id", "lang", "source")


STAGES: list[tuple[str, Stage]] = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", cut_repeated_spans),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]

# Near duplicates, byte spans and piece encoding are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage is written to the shared folder and read again."""
    importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{number}")
    return docs

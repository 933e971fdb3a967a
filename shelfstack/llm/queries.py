"""The operators' queries over whole given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstack.llm import (
    divergence, jaccard, katz, language, middles, mixing, packing, passages, pieces, sql, suffixes, syncmers, urls, vectors,
)
from shelfstack.llm.storage import importable

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {"op5_mixing": sql.MIXING, "op7_urls": sql.URLS, "op11_middles": sql.MIDDLES, "op13_divergence": sql.DIVERGENCE}

URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixture(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language.held_out(F.col("doc_id"), 3, 1)
    model = language.fit(docs.where(~out))
    return language.identify(docs.select("doc_id", "text", out.alias("held_out")), model, "doc_id", "held_out")


@query
def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), n=4, percent=85)


@query
def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicated(table(spark, sf_dir, "documents"), "doc_id")


@query
def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), "doc_id")


@query
def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), URL_RULES, "page_id")


@query
def op4_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprinted(table(spark, sf_dir, "documents"))


@query
def op1_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return katz.scored(docs.select("doc_id", "text", language.held_out(F.col("doc_id"), 7, 2).alias("held_out")))


@query
def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.shared_passages(table(spark, sf_dir, "documents"))


@query
def op11_middles(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = middles.rearranged(table(spark, sf_dir, "documents"), "doc_id")
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(middles.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


@query
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = packing.packed(table(spark, sf_dir, "documents"), TOKENIZER, ids_crc32=F.crc32("ids"))
    return made.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))

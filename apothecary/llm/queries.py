"""The queries of these operators, over the tables of one folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apothecary.llm import bottom_k, bpe, chosen_path, html_text, hypervectors, mixing, nn_descent, repair, repeats, secrets, token_files, toxicity, trie
from apothecary.llm.shared import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.predictions(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query
def op2_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return chosen_path.near_duplicates(documents(spark, folder))


@query
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed_sources(documents(spark, folder))


@query
def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return bottom_k.comparisons(documents(spark, folder))


@query
def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    return hypervectors.predictions(documents(spark, folder))


@query
def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digest(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digest(documents(spark, folder))


ORACLES["op2_near_dedup"] = chosen_path.ORACLE
ORACLES["op8_substring_dedup"] = repeats.ORACLE


@query
def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html")
    return html_text.extracted(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op10_nearest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    return nn_descent.nearest(vectors, asks=F.col("id") % 20 == 0)


@query
def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.read(token_files.write(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json")))


@query
def op12_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(documents(spark, folder))


ORACLES["op12_secrets"] = secrets.ORACLE


@query
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repaired(spark.read.parquet(f"{folder}/conversations.parquet"))


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.trie(spark.read.parquet(f"{folder}/conversations.parquet"))


ORACLES["op13_prefix_trie"] = trie.ORACLE

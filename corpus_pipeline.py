"""A corpus pipeline over ``documents``: score, deduplicate twice, mix, encode.

Each stage takes all documents its predecessor kept and returns the columns of
``documents``; the last returns digests of the token ids. Stages are judged by the
operators' own rules for null ids and texts, ties and empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apothecary.llm import bpe, chosen_path, mixing, repeats, toxicity
from apothecary.llm.shared import documents, small_batches, stored

NEAR = chosen_path.NearSettings(words=5, percent=80)


def _folded(docs: DataFrame, *used: str) -> DataFrame:
    """The used columns, and all others in one, where their names meet no operator's."""
    rest = [c for c in docs.columns if c not in used] or [F.lit(0).alias("none")]
    return docs.select(*used, F.struct(*rest).alias("_rest"))


def _unfolded(rows: DataFrame, docs: DataFrame) -> DataFrame:
    folded = rows.schema["_rest"].dataType.names
    return rows.select(*[F.col(f"_rest.`{c}`" if c in folded else c).alias(c) for c in docs.columns])


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.scored(_folded(docs, "text"), model)
    return _unfolded(scored.where("score < 0.5"), docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of smallest doc_id."""
    copies = chosen_path.near_duplicates(docs, NEAR).where("NOT kept").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that start earlier; the others are unchanged.

    A text that loses words has the rest joined by one space, and ``n_chars`` follows.
    """
    cut = F.col("n_removed") > 0
    rows = repeats.without_repeats(_folded(docs, "doc_id", "text", "n_chars"))
    rows = rows.withColumn("text", F.when(cut, F.col("kept")).otherwise(F.col("text")))
    return _unfolded(rows.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars"))), docs)


def mixed_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    folded = _folded(docs, "doc_id", "source", "text")
    numbered = stored(folded.withColumn("row", F.monotonically_increasing_id()), "numbered")
    taken = mixing.mixed_sources(numbered, "row").where("copies > 0").select("row", F.sequence(F.lit(1), "copies").alias("copies"))
    return _unfolded(numbered.join(taken, "row").withColumn("copy", F.explode("copies")), docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, as digests."""
    small_batches(spark)
    return bpe.digest(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", without_toxic),
    ("near_dedup", without_near_copies),
    ("substring_dedup", without_repeated_passages),
    ("mixing", mixed_to_targets),
    ("encoding", encoded),
]
# Scores, hashes and merges have no SQL; tests compare with a version in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

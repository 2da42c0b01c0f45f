"""The registered queries against SQL, and the pipeline against plain Python."""

import hashlib
import re

import pytest
from comparing import database, difference
from pyspark.sql import functions as F

import corpus_pipeline
from apothecary.llm import mixing, toxicity
from apothecary.llm.queries import ORACLES, QUERIES
from test_llm_operators import docs_of, near_truth, removed

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_by_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), database(FOLDER), ORACLES[name]) is None


def test_each_operator_has_a_query():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in sorted(QUERIES, key=lambda n: int(re.match(r"op(\d+)_", n)[1]))] == list(range(1, 14))


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    stages = dict(corpus_pipeline.STAGES)
    scores = toxicity.predictions(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    clean = stages["toxicity"](spark, docs, FOLDER).cache()
    assert set(texts_of(clean)) == {r["doc_id"] for r in scores.where("predicted = 0").collect()}

    distinct = stages["near_dedup"](spark, clean, FOLDER).cache()
    assert set(texts_of(distinct)) == {i for i, (_, part) in near_truth(texts_of(clean), 5, 80).items() if part == i}

    cut = stages["substring_dedup"](spark, distinct, FOLDER).cache()
    before, after = texts_of(distinct), texts_of(cut)
    for i, (_, gone, kept) in removed(before).items():
        assert after[i] == (kept if gone else before[i])
    assert cut.where("n_chars <> length(text)").join(distinct.where("n_chars = length(text)"), "doc_id").count() == 0

    mix = stages["mixing"](spark, cut, FOLDER).cache()
    copies = {r["doc_id"]: r["copies"] for r in mixing.mixed_sources(cut).collect()}
    times = {r["doc_id"]: r["count"] for r in mix.groupBy("doc_id").count().collect()}
    assert all(sum(times.get(i, 0) for i in copies) == mix.count() and times.get(i, 0) <= 3 for i in copies)
    for r in mixing.mixed_sources(cut).groupBy("source").agg(F.first("target").alias("t"), F.max("size").alias("longest")).collect():
        words = mix.where(F.col("source").eqNullSafe(F.lit(r["source"]))).agg(F.sum(mixing.word_count())).first()[0]
        # A source of a few documents comes as near as its documents allow.
        assert abs(words - r["t"]) <= max(0.02 * r["t"], r["longest"] / 2)

    out = stages["encoding"](spark, mix, FOLDER).collect()
    assert len(out) == mix.count()
    for r in out[:40]:
        assert r["decoded_sha256"] == hashlib.sha256(after[r["doc_id"]].encode()).hexdigest()
    for stage in (clean, distinct, cut, mix):
        assert stage.columns == docs.columns
    for cached in (docs, clean, distinct, cut, mix):
        cached.unpersist()


def test_run_applies_the_stages(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and rows.count() > 50


def test_stages_on_odd_tables(spark):
    texts = [None, "", "a b c", "a b c", "x " * 200]
    odd = docs_of(spark, texts, [None, 1, 2, 2, 3], extra=True).withColumn("copies", F.lit(1)).withColumn("_none", F.lit(2))
    for docs in (odd, odd.limit(0)):
        total = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
            if name != "encoding":
                assert docs.columns == odd.columns
        assert docs.count() <= 3 * total

"""Sizes of the partitions that fact rows are added up, joined and sorted in."""

from pyspark.sql import functions as F

from apothecary.operators import fact
from apothecary.session import configure
from apothecary.sources import sample

FOLDER = "/root/testdata/sf0.001"
BY_SIZE = "spark.sql.adaptive.coalescePartitions.parallelismFirst"


def test_partitions_of_fact_rows_are_not_put_together(spark):
    """Some 25 MB of shuffled sums: one task by Spark's own size, several by ours."""
    configure(spark)
    spark.conf.set(BY_SIZE, "false")
    try:
        rows = spark.range(0, 200_000, 1, 4).select(F.xxhash64("id").alias("id"), *[F.rand(k).alias(f"c{k}") for k in range(16)])
        sums = rows.groupBy("id").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(16)])
        held = sums.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("rows"), *[F.max(f"c{k}") for k in range(16)]).collect()
    finally:
        spark.conf.unset(BY_SIZE)
    assert sum(r["rows"] for r in held) == 200_000
    assert max(r["rows"] for r in held) < 100_000


def test_tasks_that_add_up_claims_follow_the_number_of_lines(spark, monkeypatch):
    """The one shuffle is that of narrow lines, in as many parts as there are lines for."""
    monkeypatch.setattr(sample, "LINES_A_TASK", 500)
    inputs = sample.Sample(spark, FOLDER)
    lines = inputs.claims().count()
    dealt = fact.contractor_months(inputs.claims(dealt=True))
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    assert f", {-(-lines // 500)}), REPARTITION_BY_NUM" in plan
    plain = fact.contractor_months(inputs.claims())
    assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()
    parts = dealt.groupBy(F.spark_partition_id()).count().count()
    assert parts > 5

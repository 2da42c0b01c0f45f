"""Exact median per group, without gathering a group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets into which the values between the sketch's bounds are counted.
BUCKETS = 1024


def _same_keys(left: DataFrame, right: DataFrame, keys: list[str], suffix: str) -> Column:
    pairs = [left[k].eqNullSafe(right[k + suffix]) for k in keys]
    return reduce(lambda a, b: a & b, pairs)


def _renamed(df: DataFrame, keys: list[str], suffix: str, *others: str) -> DataFrame:
    return df.select(*[F.col(k).alias(k + suffix) for k in keys], *others)


def _bucket() -> Column:
    """The bucket of x between low and high; one more on either side for the rest."""
    x, low, high = (F.col(c).cast("double") for c in ("x", "low", "high"))
    inside = F.floor((x - low) / (high - low) * BUCKETS)
    return (
        F.when(x < low, -1)
        .when(x > high, BUCKETS)
        .when(high == low, 0)
        .otherwise(F.least(inside, F.lit(BUCKETS - 1)))
        .cast("int")
    )


def exact_median(
    df: DataFrame, keys: list[str], value: str, name: str, accuracy: int = 2_000
) -> DataFrame:
    """Median of ``value`` by ``keys``, NULL skipped, middle pair averaged.

    Spark's ``median`` keeps every distinct value of a group in one task's
    memory. Here a quantile sketch of fixed size first gives two values around
    the middle of each group. All values are then counted in buckets, a fixed
    number between the two and one on either side, by partial sums. The bucket
    the middle falls in holds about ten millionths of the group; its distinct
    values are counted likewise and the running count over them gives the
    middle. A sketch that missed only makes that bucket larger.

    Nothing runs until the result is asked for, and nothing is kept.
    """
    present = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("x"))
    slack = 4.0 / accuracy
    sketch = present.groupBy(*keys).agg(
        F.percentile_approx("x", [0.5 - slack, 0.5 + slack], accuracy).alias("b"),
        F.count(F.lit(1)).alias("n"),
    )
    sketch = sketch.select(*keys, F.col("b")[0].alias("low"), F.col("b")[1].alias("high"), "n")
    bounds = _renamed(sketch, keys, "_s", "low", "high", "n")
    placed = present.join(bounds, _same_keys(present, bounds, keys, "_s"))
    counts = (
        placed.groupBy(*keys, _bucket().alias("bucket"))
        .agg(F.count(F.lit(1)).alias("rows"), *[F.first(c).alias(c) for c in ("n", "low", "high")])
    )
    lower, upper = F.expr("(n + 1) div 2"), F.expr("(n + 2) div 2")
    # At most BUCKETS + 2 rows a group.
    ranked = counts.withColumn("upto", F.sum("rows").over(_running(keys, "bucket")))
    middle = ranked.groupBy(*keys).agg(
        F.min(F.when(F.col("upto") >= lower, F.col("bucket"))).alias("first_bucket"),
        F.min(F.when(F.col("upto") >= upper, F.col("bucket"))).alias("last_bucket"),
        F.min(F.when(F.col("upto") >= lower, F.col("upto") - F.col("rows"))).alias("before"),
        *[F.first(c).alias(c) for c in ("n", "low", "high")],
    )
    middle = _renamed(middle, keys, "_m", "first_bucket", "last_bucket", "before", "n", "low", "high")
    points = (
        present.join(middle, _same_keys(present, middle, keys, "_m"))
        .where(_bucket().between(F.col("first_bucket"), F.col("last_bucket")))
        .groupBy(*keys, "x")
        .agg(F.count(F.lit(1)).alias("rows"), F.first("before").alias("before"), F.first("n").alias("n"))
    )
    upto = F.col("before") + F.sum("rows").over(_running(keys, "x"))
    found = points.withColumn("upto", upto).groupBy(*keys).agg(
        F.min(F.when(F.col("upto") >= lower, F.col("x"))).alias("a"),
        F.min(F.when(F.col("upto") >= upper, F.col("x"))).alias("b"),
    )
    return found.select(*keys, ((F.col("a") + F.col("b")) / 2).alias(name))


# Buckets of value counts for each factor of e.
FINENESS = 4096


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, bucket, x, rows): how often each value of ``value`` is in a group, NULL left out.

    Bucket bounds are fixed, about 0.02 % of a value wide, so that counts of different
    groups, files and days may simply be added up. Written beside a table, this serves the
    medians of all coarser groups without the table.
    """
    x = F.col(value)
    counted = df.where(x.isNotNull()).groupBy(*keys, x.alias("x")).agg(F.count(F.lit(1)).alias("rows"))
    size = F.floor(F.log1p(F.abs(F.col("x").cast("double"))) * FINENESS)
    bucket = F.when(F.col("x") < 0, -size - 1).otherwise(size).cast("long")
    return counted.select(*keys, bucket.alias("bucket"), "x", "rows")


def medians_of_counts(counts: DataFrame, grains: dict[str, list[str]], keys: list[str], name: str) -> DataFrame:
    """Exact medians of several grains at once: grain, ``keys`` (NULL where the grain has none) and ``name``.

    ``counts`` is what ``value_counts`` gives for ``keys``. Sums by bucket find the one or
    two buckets that hold a group's middle; only the values of these are put in order.
    """
    def at_each(df: DataFrame, *others: str) -> DataFrame:
        grain = F.explode(F.array(*map(F.lit, grains))).alias("grain")
        kept = {k: [g for g, has in grains.items() if k in has] for k in keys}
        rows = df.select(*keys, *others, grain)
        return rows.select("grain", *[F.when(F.col("grain").isin(kept[k]), F.col(k)).alias(k) for k in keys], *others)

    by = ["grain", *keys]
    sums = counts.groupBy(*keys, "bucket").agg(F.sum("rows").alias("rows"))
    sums = at_each(sums, "bucket", "rows").groupBy(*by, "bucket").agg(F.sum("rows").alias("rows"))
    upto = sums.withColumn("upto", F.sum("rows").over(_running(by, "bucket")))
    sizes = upto.withColumn("n", F.max("upto").over(Window.partitionBy(*by)))
    lower, upper = F.expr("(n + 1) div 2"), F.expr("(n + 2) div 2")
    before = F.col("upto") - F.col("rows")
    middle = sizes.where((F.col("upto") >= lower) & (before < upper))
    middle = _renamed(middle.withColumn("before", before), by, "_m", F.col("bucket").alias("bucket_m"), "before", "n")
    values = at_each(counts, "bucket", "x", "rows")
    held = values.join(middle, _same_keys(values, middle, by, "_m") & (values["bucket"] == middle["bucket_m"]))
    points = held.groupBy(*by, "x").agg(F.sum("rows").alias("rows"), F.first("before").alias("before"), F.first("n").alias("n"))
    # What lies before the first of a group's buckets; the rows of the second come after those of the first.
    first = F.min("before").over(Window.partitionBy(*by))
    found = points.withColumn("upto", first + F.sum("rows").over(_running(by, "x"))).groupBy(*by).agg(
        F.min(F.when(F.col("upto") >= lower, F.col("x"))).alias("a"), F.min(F.when(F.col("upto") >= upper, F.col("x"))).alias("b"))
    return found.select(*by, ((F.col("a") + F.col("b")) / 2).alias(name))


def _running(keys: list[str], order: str):
    rows = Window.partitionBy(*keys).orderBy(order)
    return rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)

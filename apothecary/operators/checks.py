"""Checks on facts, reference data and published series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

SEEN = "column_name string, rows bigint, missing bigint, unlisted bigint"
# Limits of single values from the mean range between neighbours: three deviations, 3 / 1.128.
RANGE_WIDTH = 2.66


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def missing_counts(df: DataFrame) -> DataFrame:
    """NULLs per column, counted in one pass."""
    counts = df.agg(*[(F.count(F.lit(1)) - F.count(c)).alias(c) for c in df.columns])
    return counts.unpivot([], None, "column_name", "missing")


def watched(df: DataFrame, listed: dict[str, Sequence[str]] | None = None) -> tuple[DataFrame, Observation]:
    """``df`` with counts taken of what passes when it is written: nothing is scanned for them.

    Counted are rows, NULLs of every column and, for columns in ``listed``, values
    that are in no list. The counts are there when the write is done; see ``seen``.
    """
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count_if(F.col(c).isNull()).alias(f"missing:{c}") for c in df.columns]
    counts += [F.count_if(~F.col(c).isin(list(allowed))).alias(f"unlisted:{c}") for c, allowed in (listed or {}).items()]
    observed = Observation()
    return df.observe(observed, *counts), observed


def seen(spark: SparkSession, observed: Observation) -> DataFrame:
    """What ``watched`` counted: column_name, rows, missing, and unlisted where a list was given."""
    got = observed.get
    columns = [k.split(":", 1)[1] for k in got if k.startswith("missing:")]
    rows = [(c, got["rows"], got[f"missing:{c}"], got.get(f"unlisted:{c}")) for c in columns]
    return spark.createDataFrame(rows, SEEN)


def unlisted_values(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside a list, with their row counts; NULL is not reported."""
    return (
        df.where(~F.col(column).isin(list(allowed)))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def differences(
    published: DataFrame, recomputed: DataFrame, keys: Sequence[str], value: str
) -> DataFrame:
    """Rows missing on either side, or with another value."""
    old = published.select(*keys, F.col(value).alias("published_value"))
    new = recomputed.select(
        *[F.col(k).alias(k + "_n") for k in keys], F.col(value).alias("recomputed_value")
    )
    same = reduce(lambda a, b: a & b, [old[k].eqNullSafe(new[k + "_n"]) for k in keys])
    joined = old.join(new, same, "full_outer")
    return joined.where(
        ~F.col("published_value").eqNullSafe(F.col("recomputed_value"))
    ).select(
        *[F.coalesce(k, k + "_n").alias(k) for k in keys],
        "published_value",
        "recomputed_value",
    )


def control_limits(
    df: DataFrame, series: Sequence[str], value: str, width: float = 3.0
) -> DataFrame:
    """Mean, limits and outlier flag per row of each series."""
    x = F.col(value).cast("double")
    limits = df.groupBy(*[F.col(k).alias(k + "_l") for k in series]).agg(
        F.avg(x).alias("mean"), F.stddev_samp(x).alias("deviation")
    )
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(limits[k + "_l"]) for k in series])
    out = df.join(limits, same).drop(*[k + "_l" for k in series])
    return out.withColumns(
        {
            "lower_limit": F.col("mean") - width * F.col("deviation"),
            "upper_limit": F.col("mean") + width * F.col("deviation"),
        }
    ).withColumn("outlier", (x < F.col("lower_limit")) | (x > F.col("upper_limit")))


def limits_without_the_point(
    df: DataFrame, series: Sequence[str], order: str, value: str, width: float = 3.0
) -> DataFrame:
    """Limits for each row of a series from its other rows, and an outlier flag by either kind.

    An outlier widens limits that it is itself part of, in a short series so far that it
    never lies beyond them. Count, mean and squared deviations of a whole series merge,
    and a point is taken out of them again. ``lower_limit`` and ``upper_limit`` are ``width``
    deviations off the mean of the others; ``range_lower`` and ``range_upper`` lie 2.66 times
    the mean change between neighbours off it, changes to and from the point left out.
    Rows with NULL are left out; where too few others are left, limits
    are NULL.
    """
    x = F.col(value).cast("double")
    ordered = Window.partitionBy(*series).orderBy(order)
    known = df.where(F.col(value).isNotNull())
    ranged = known.withColumn("_to", F.abs(x - F.lag(x).over(ordered))).withColumn("_from", F.abs(F.lead(x).over(ordered) - x))
    sums = ranged.groupBy(*[F.col(k).alias(k + "_l") for k in series]).agg(
        F.count(F.lit(1)).alias("_n"), F.avg(x).alias("_mean"), F.var_pop(x).alias("_var"), F.sum("_to").alias("_ranges"), F.count("_to").alias("_moves")
    )
    same = reduce(lambda a, b: a & b, [ranged[k].eqNullSafe(sums[k + "_l"]) for k in series])
    n, mean = F.col("_n"), F.col("_mean")
    left = F.when(n > 1, (n * mean - x) / F.nullif(n - 1, F.lit(0)))
    squares = F.greatest(F.col("_var") * n - (x - mean) * (x - F.col("mean")), F.lit(0.0))
    moves = F.col("_moves") - F.when(F.col("_to").isNotNull(), 1).otherwise(0) - F.when(F.col("_from").isNotNull(), 1).otherwise(0)
    ranges = F.col("_ranges") - F.coalesce("_to", F.lit(0.0)) - F.coalesce("_from", F.lit(0.0))
    out = ranged.join(sums, same).withColumn("mean", left)
    out = out.withColumn("_off", width * F.sqrt(F.when(n > 2, squares / F.nullif(n - 2, F.lit(0)))))
    out = out.withColumn("_move", RANGE_WIDTH * F.when(moves > 0, F.greatest(ranges, F.lit(0.0)) / F.nullif(moves, F.lit(0))))
    limits = [
        (F.col("mean") + sign * F.col(off)).alias(name)
        for name, off, sign in (("lower_limit", "_off", -1), ("upper_limit", "_off", 1), ("range_lower", "_move", -1), ("range_upper", "_move", 1))
    ]
    out = out.select(*df.columns, "mean", *limits)
    beyond = [(x < F.col(low)) | (x > F.col(high)) for low, high in (("lower_limit", "upper_limit"), ("range_lower", "range_upper"))]
    return out.withColumn("outlier", beyond[0]).withColumn("range_outlier", beyond[1])

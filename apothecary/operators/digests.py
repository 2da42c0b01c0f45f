"""Digests of tables that do not depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(df: DataFrame, seed: int) -> Column:
    """A 64-bit hash of all columns by name; NULL differs from every value and place."""
    parts = []
    for c in sorted(df.columns):
        parts += [F.col(f"`{c}`").isNull(), F.col(f"`{c}`")]
    return F.xxhash64(F.lit(seed), F.lit(",".join(sorted(df.columns))), *parts)


def digest(df: DataFrame) -> DataFrame:
    """One row: ``rows``, and sums of two hashes over them.

    Sums of parts add up to those of the whole, and a row that comes twice counts
    twice; so equal digests mean equal tables, whatever the order and the files.
    """
    hashed = df.select(*[row_hash(df, n).cast("decimal(20,0)").alias(f"h{n}") for n in (1, 2)])
    return hashed.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.coalesce(F.sum(f"h{n}"), F.lit(0)).cast("decimal(38,0)").alias(f"digest_{n}") for n in (1, 2)],
    )

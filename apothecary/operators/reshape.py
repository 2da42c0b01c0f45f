"""Reshaping between wide and long, and completion of missing groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_long(
    df: DataFrame,
    ids: Sequence[str],
    columns: Sequence[str] | None = None,
    name: str = "measure",
    value: str = "value",
) -> DataFrame:
    """Chosen columns, or all but ``ids``, as name and value rows."""
    return df.unpivot(list(ids), list(columns) if columns else None, name, value)


def to_wide(
    df: DataFrame, ids: Sequence[str], name: str, value: str, names: Sequence[str]
) -> DataFrame:
    """Name and value rows as columns, in the order of ``names``."""
    return df.groupBy(*ids).pivot(name, list(names)).agg(F.first(value))


# Items that may be written out for every group.
MOST_ITEMS = 10_000


def complete(
    df: DataFrame, item: str, within: Sequence[str], value: str, fill: int = 0, most: int = MOST_ITEMS
) -> DataFrame:
    """A row for every observed item within every observed group.

    Every item beside every group is what is asked for. The distinct items are
    read first, and more than ``most`` of them are an error: groups times items is the
    size of the result. Each group then writes out the list, in its own task, and the rows
    present are joined on. NULL is an item, and a group, like any other.
    """
    kind = df.schema[item].dataType
    items = [r[0] for r in df.select(item).distinct().limit(most + 1).collect()]
    if len(items) > most:
        raise ValueError(f"more than {most} different values of {item} to complete")
    listed = F.array(*[F.lit(v).cast(kind) for v in items]) if items else F.array().cast(T.ArrayType(kind))
    groups = df.select(*[F.col(k).alias(k + "_g") for k in within]).distinct()
    pairs = groups.withColumn("wanted", F.explode(listed))
    same = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(k + "_g")) for k in within],
        F.col(item).eqNullSafe(F.col("wanted")),
    )
    return pairs.join(df.select(*within, item, value), same, "left").select(
        *[F.col(k + "_g").alias(k) for k in within],
        F.col("wanted").alias(item),
        F.coalesce(value, F.lit(fill)).alias(value),
    )

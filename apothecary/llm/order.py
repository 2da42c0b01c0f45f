"""Running sums over tables in global order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apothecary.llm.shared import stored


def partitions(df: DataFrame) -> int:
    """Partitions of a shuffle by range, as the session sets it."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running_sum(df: DataFrame, order: list[Column], value: str, name: str, group: list[str] | None = None) -> DataFrame:
    """``df`` with the sum of ``value`` over the earlier rows of the same group in a column ``name``.

    Rows are dealt out by range of group and order, so a large group is spread over
    many tasks. A task sums its own rows; what came before them is found from one
    total for each group and part. Rows alike in group and order come in any order.
    """
    group = group or []
    part = f"{name}_part"
    keys = [F.col(g) for g in group]
    ranged = stored(df.repartitionByRange(partitions(df), *keys, *order).withColumn(part, F.spark_partition_id()), name)
    by = [part, *group]
    inside = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*by).agg(F.sum(value).alias("total"))
    offset = f"{name}_offset"
    totals = totals.select(*by, F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias(offset))
    rows = ranged.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = [rows[c].eqNullSafe(totals[c]) for c in by]
    on = same[0]
    for s in same[1:]:
        on = on & s
    columns = [rows[c] for c in df.columns]
    return rows.join(totals, on, "left").select(*columns, (rows[name] + totals[offset]).alias(name))

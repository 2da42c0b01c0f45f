"""Year-on-year measures of a series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from apothecary.functions.scalars import safe_ratio
from apothecary.operators.search import last_as_high


def _series(keys: Sequence[str], order: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def _so_far(keys: Sequence[str], order: str) -> WindowSpec:
    return _series(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def change(x: Column, keys: Sequence[str], order: str) -> Column:
    """Difference from the previous period."""
    return x - F.lag(x).over(_series(keys, order))


def percent_change(x: Column, keys: Sequence[str], order: str) -> Column:
    before = F.lag(x).over(_series(keys, order))
    return safe_ratio(x - before, before) * 100


def percent_since_first(x: Column, keys: Sequence[str], order: str) -> Column:
    first = F.first(x).over(_so_far(keys, order))
    return safe_ratio(x - first, first) * 100


def points_since_first(share: Column, keys: Sequence[str], order: str) -> Column:
    """Percentage-point change of a share against the first period."""
    return share - F.first(share).over(_so_far(keys, order))


def fold_since_first(x: Column, keys: Sequence[str], order: str) -> Column:
    return safe_ratio(x, F.first(x).over(_so_far(keys, order)))


def highest_so_far(x: Column, keys: Sequence[str], order: str) -> Column:
    return x == F.max(x).over(_so_far(keys, order))


def lowest_so_far(x: Column, keys: Sequence[str], order: str) -> Column:
    return x == F.min(x).over(_so_far(keys, order))


def highest_since(
    df: DataFrame, x: str, keys: Sequence[str], order: str, name: str
) -> DataFrame:
    """The last earlier period with a value as high, as ``name``; NULL when there is none.

    Rows come as often as they were, whatever else is alike in them; rows without
    period or value get NULL and count for no other. The search is
    ``operators.search``: no row is compared with the rows before it one by one.
    """
    asked = [F.col(k) for k in (*keys, order, x)]
    wanted = df.select(*asked).where(F.col(order).isNotNull() & F.col(x).isNotNull()).distinct()
    found = last_as_high(wanted, x, keys, order, name)
    renamed = {c: f"_{c}_s" for c in (*keys, order, x)}
    found = found.select(*[F.col(c).alias(new) for c, new in renamed.items()], name)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(new)) for c, new in renamed.items()])
    return df.join(found, same, "left").select(*[df[c] for c in df.columns], name)


def rank_from_highest(x: Column, keys: Sequence[str]) -> Column:
    return F.rank().over(Window.partitionBy(*keys).orderBy(x.desc_nulls_last()))


def rising_run(df: DataFrame, x: str, keys: Sequence[str], order: str, name: str) -> DataFrame:
    """Length of the run of consecutive rises each row ends.

    Every row that is no rise starts an island; a row's place within its
    island is the number of rises since.
    """
    rise = F.col(x) > F.lag(x).over(_series(keys, order))
    marked = df.withColumn("_break", F.when(rise, 0).otherwise(1))
    island = F.sum("_break").over(_so_far(keys, order))
    placed = marked.withColumn("_island", island)
    place = F.row_number().over(Window.partitionBy(*keys, "_island").orderBy(order))
    return placed.withColumn(name, (place - 1).cast("bigint")).drop("_break", "_island")

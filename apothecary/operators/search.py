"""Search for the last earlier value as high, in series of any length.

Points of all series are put in order once, by a range shuffle, and numbered in it. A
node stands for ``FAN`` points in a row, a node of the next level for ``FAN`` nodes, and
so on up to the tasks of the shuffle; it holds the largest value of each of its parts. A
point looks among the earlier parts of its own node, level after level until one is as
high, and from there down again to the last point as high. Each step is a join on series
and node number with at most ``FAN`` parts on the other side, so a series may spread
over all tasks, and a step costs a point the same wherever it stands.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apothecary.session import written

FAN_BITS = 6
FAN = 1 << FAN_BITS
# The bits of a row number inside a task, in the numbers Spark gives.
TASK_BITS = 33


def _node(number: Column, level: int, top: int) -> Column:
    """The node of a level that a row number is in; at the top a series has one."""
    if level > top:
        return F.lit(0).cast("long")
    return F.shiftright(number, TASK_BITS if level == top else level * FAN_BITS)


def _same(keys: Sequence[str], *more: Column) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}_n")) for k in keys], reduce(lambda a, b: a & b, more))


def _levels(points: DataFrame) -> int:
    """The level whose nodes are tasks: the first that a whole task fits in."""
    most = points.agg(F.max(F.col("_number").bitwiseAND(F.lit((1 << TASK_BITS) - 1)))).first()[0] or 0
    level = 1
    while FAN**level <= most:
        level += 1
    return level


def last_as_high(rows: DataFrame, x: str, keys: Sequence[str], order: str, name: str) -> DataFrame:
    """Distinct ``rows`` (keys, order, x) with the last earlier ``order`` of the series where x is as high."""
    keyed = [f"_{k}_n" for k in keys]
    points = rows.groupBy(*keys, order).agg(F.max(x).alias("_high"))
    number = F.monotonically_increasing_id().alias("_number")
    points = written(points.orderBy(*keys, order).select("*", number), "points")
    top = _levels(points)

    def nodes(level: int) -> DataFrame:
        """By series and node: its parts, each with number, largest value and, of points, their period."""
        if level == 1:
            parts = points.select(*keys, "_number", F.struct(F.col("_number").alias("at"), F.col("_high").alias("high"), F.col(order).alias("when")).alias("part"))
        else:
            lower = _node(F.col("_number"), level - 1, top)
            parts = points.groupBy(*keys, lower.alias("at")).agg(F.max("_high").alias("high"), F.first("_number").alias("_number"))
            parts = parts.select(*keys, "_number", F.struct("at", "high").alias("part"))
        by = [F.col(k).alias(n) for k, n in zip(keys, keyed)]
        return parts.groupBy(*by, _node(F.col("_number"), level, top).alias("_node")).agg(F.collect_list("part").alias("_parts"))

    def last(before: Column | None) -> Column:
        """The last of the node's parts that is as high, and before that given."""
        as_high = F.filter("_parts", lambda p: (p["high"] >= F.col(x)) if before is None else (p["high"] >= F.col(x)) & (p["at"] < before))
        return F.array_max(F.transform(as_high, lambda p: F.struct(p["at"].alias("at"), *([p["when"].alias("when")] if first else []))))

    asked = rows.join(points.select(*[F.col(k).alias(n) for k, n in zip(keys, keyed)], F.col(order).alias("_order"), "_number"),
                      _same(keys, F.col(order) == F.col("_order")))
    # Keys as read, not as computed: a series known to be the only one is still a key to join on.
    asked = asked.select(
        *[F.col(n).alias(k) for k, n in zip(keys, keyed)], order, x, "_number",
        F.lit(None).cast("long").alias("_at"), F.lit(0).alias("_level"), F.lit(None).cast(rows.schema[order].dataType).alias(name))
    # Up: the first level at which an earlier part of the own node is as high.
    for level in range(1, top + 2):
        first = level == 1
        own = F.col("_number") if first else _node(F.col("_number"), level - 1, top)
        open_ = F.col("_level") == 0
        joined = asked.join(nodes(level), _same(keys, open_, F.col("_node") == _node(F.col("_number"), level, top)), "left")
        hit = last(own)
        joined = joined.withColumn("_hit", hit)
        found = F.col("_hit").isNotNull()
        asked = joined.select(
            *keys, order, x, "_number", F.when(found, F.col("_hit.at")).otherwise(F.col("_at")).alias("_at"),
            F.when(found, level).otherwise(F.col("_level")).alias("_level"),
            (F.when(found, F.col("_hit.when")).otherwise(F.col(name)) if first else F.col(name)).alias(name))
    # Down: from the part that is as high to its last point that is.
    for level in range(top, 0, -1):
        first = level == 1
        below = F.col("_level") > level
        joined = asked.join(nodes(level), _same(keys, below, F.col("_node") == F.col("_at")), "left").withColumn("_hit", last(None))
        asked = joined.select(
            *keys, order, x, "_number", F.when(below, F.col("_hit.at")).otherwise(F.col("_at")).alias("_at"), "_level",
            (F.when(below, F.col("_hit.when")).otherwise(F.col(name)) if first else F.col(name)).alias(name))
    return asked.select(*keys, order, x, name)

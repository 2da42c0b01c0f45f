"""Aggregates with the two NULL rules of the report.

Fact rows are summed with ``sum0`` (NULL is skipped, nothing gives 0). Sums of
those sums use ``sum_strict`` (one NULL makes the total NULL).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sum0(x: Column | str) -> Column:
    return F.coalesce(F.sum(_col(x)), F.lit(0))


def sum0_where(x: Column | str, condition: Column) -> Column:
    return sum0(F.when(condition, _col(x)))


def sum_strict(x: Column | str) -> Column:
    if isinstance(x, str):
        return F.expr(f"CASE WHEN count(1) = count(`{x}`) THEN sum(`{x}`) END")
    return F.when(F.count(F.lit(1)) == F.count(_col(x)), F.sum(_col(x)))


def sum_strict_where(x: Column | str, condition: Column) -> Column:
    """``sum_strict`` with rows outside the condition counted as 0."""
    return sum_strict(F.when(condition, _col(x)).otherwise(0))


def sole(x: Column | str) -> Column:
    """The value of a one-row group; more rows are an error, not a choice."""
    return F.when(F.count(F.lit(1)) == 1, F.first(_col(x))).otherwise(
        F.raise_error(F.lit("expected one row per group"))
    )

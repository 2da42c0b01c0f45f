"""The latest state of each group, as an aggregate that merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parts a group's rows are reduced in before they meet.
PARTS = 32


def latest_state(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], state: Sequence[str], name: str = "state"
) -> DataFrame:
    """The ``state`` columns, as one struct, of the last row by ``order`` in each group.

    Of rows alike in ``order`` the one with the largest state is taken; NULL comes
    first. The larger of two candidates is again a candidate, so a task reduces each
    group to one row before anything is sent. Those rows meet in two steps, by group
    and part of the input, then by group: a group that every task has seen comes to
    its last task in ``PARTS`` rows, whatever it holds and however many tasks there are.
    """
    candidate = F.struct(*order, F.struct(*state).alias("state"))
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("_part")
    found = rows.select(*keys, candidate.alias("_last"), part)
    for by in ([*keys, "_part"], [*keys]):
        found = found.groupBy(*by).agg(F.max("_last").alias("_last"))
    return found.select(*keys, F.col("_last.state").alias(name))

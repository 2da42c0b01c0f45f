"""Table 20: decisions on appeals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apothecary.functions.aggregates import sum_strict
from apothecary.functions.scalars import in_listed_order, recode
from apothecary.operators.prep import fill_numeric
from apothecary.operators.reshape import complete
from apothecary.params import DECISIONS, GRANTED, LOCALITIES, REFUSED

KEYS = ("financial_year", "locality", "application_decision")


def digest_current(current: DataFrame) -> DataFrame:
    """This year's decisions by locality, with Total rows beside them.

    Any decision but a refusal counts as granted. Localities other than the
    two reported ones drop out. The totals add up the grouped rows.
    """
    parts = (
        fill_numeric(current)
        .withColumn(
            "application_decision",
            recode(F.col("application_decision"), "refused application", REFUSED, GRANTED),
        )
        .where(F.col("locality").isin(list(LOCALITIES[:2])))
        .groupBy(*KEYS)
        .agg(sum_strict("number").alias("decisions"))
    )
    return with_total_rows(parts, "decisions")


def with_total_rows(parts: DataFrame, value: str) -> DataFrame:
    """Decisions by locality and, beside them, over all localities."""
    year, locality, decision = (parts[k] for k in KEYS)
    return parts.groupingSets(
        [[year, locality, decision], [year, decision]], year, locality, decision
    ).agg(
        F.sum(value).alias("total_decisions"), F.grouping("locality").alias("_total")
    ).select(
        "financial_year",
        F.when(F.col("_total") == 1, LOCALITIES[2]).otherwise(F.col("locality")).alias("locality"),
        "application_decision",
        "total_decisions",
    )


def table_20(history: DataFrame, current: DataFrame) -> DataFrame:
    """All decisions of all years. History comes as published, a few rows per year
    and locality; the current decisions are added up before they are looked at for
    items, for groups and for values. Nothing is kept."""
    rows = fill_numeric(history.select(*KEYS, "total_decisions")).unionByName(
        digest_current(current)
    )
    return (
        complete(rows, "application_decision", ["financial_year", "locality"], "total_decisions")
        .select(*KEYS, "total_decisions")
        .orderBy(
            F.col("financial_year").asc_nulls_last(),
            in_listed_order(F.col("locality"), LOCALITIES),
            in_listed_order(F.col("application_decision"), DECISIONS),
        )
    )

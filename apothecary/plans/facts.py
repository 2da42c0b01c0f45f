"""From claims to the facts a publication reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apothecary.operators import fact
from apothecary.params import ReportParams
from apothecary.schemas import ATTRIBUTE_HISTORY, MONTH_FACT, YEAR_FACT, require

# What the history of a contractor may change.
CHANGING = tuple(ATTRIBUTE_HISTORY.fieldNames()[3:])


def held_by_year(contractors: DataFrame, history: DataFrame, months: DataFrame) -> DataFrame:
    """Contractors once a year, with the attributes they held at its end.

    An attribute that the history does not know by then is the contractor's own.
    """
    years = months.select("CONTRACTOR_ID", "FINANCIAL_YEAR").distinct()
    changing = [c for c in CHANGING if c in history.columns]
    states = fact.attributes_at_year_end(history, years, *changing)
    states = states.select(
        F.col("CONTRACTOR_ID"), "FINANCIAL_YEAR", *[F.col(c).alias(f"{c}_THEN") for c in changing]
    )
    return states.join(contractors, "CONTRACTOR_ID").select(
        "CONTRACTOR_ID",
        "FINANCIAL_YEAR",
        *[
            F.coalesce(f"{c}_THEN", c).alias(c) if c in changing else F.col(c)
            for c in contractors.columns
            if c != "CONTRACTOR_ID"
        ],
    )


def month_sums(claims: DataFrame, contractors: DataFrame) -> DataFrame:
    """Claims of known contractors by month: the one scan and shuffle of claims.

    Everything else works on it, so it should be written before it is used.
    """
    return fact.of_known_contractors(fact.contractor_months(claims), contractors)


def year_fact(months: DataFrame, held: DataFrame, params: ReportParams) -> DataFrame:
    years = fact.contractor_years(months)
    return require(fact.contractor_fact(years, held, fact.YEAR, params), YEAR_FACT)


def month_fact(months: DataFrame, held: DataFrame, params: ReportParams) -> DataFrame:
    return require(fact.contractor_fact(months, held, fact.MONTH, params), MONTH_FACT)

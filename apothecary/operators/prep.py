"""Preparation of fact rows for the extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apothecary.functions.scalars import financial_year_start, month_start, parse_date
from apothecary.functions.scalars import year_end, year_start
from apothecary.params import ReportParams


def columns_containing(df: DataFrame, part: str) -> list[str]:
    return [c for c in df.columns if part.lower() in c.lower()]


def columns_starting(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.lower().startswith(prefix.lower())]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in _NUMERIC]


_NUMERIC = {"byte", "short", "integer", "long", "float", "double", "decimal"}


def fill_numeric(df: DataFrame) -> DataFrame:
    """NULL becomes 0 in every numeric column."""
    return df.fillna(0, subset=numeric_columns(df))


def parse_dates(df: DataFrame) -> DataFrame:
    """Every ``DATE_HIST`` column from text to date, year 9999 to NULL."""
    return df.withColumns(
        {c: parse_date(F.col(c)) for c in columns_containing(df, "DATE_HIST")}
    )


def with_period_bounds(df: DataFrame, params: ReportParams) -> DataFrame:
    """``first_day`` and ``last_day`` of the row's year.

    Year rows use their financial year. Month rows use 1 April and 31 March of
    the month's calendar year, or the true financial year when asked to.
    """
    if "YEAR_MONTH" not in df.columns:
        first, last = year_start(F.col("FINANCIAL_YEAR")), year_end(F.col("FINANCIAL_YEAR"))
    elif params.month_uses_financial_year:
        start = financial_year_start(month_start(F.col("YEAR_MONTH")))
        first = F.make_date(start, F.lit(4), F.lit(1))
        last = F.make_date(start + 1, F.lit(3), F.lit(31))
    else:
        year = F.floor(F.col("YEAR_MONTH") / 100).cast("int")
        first = F.make_date(year, F.lit(4), F.lit(1))
        last = F.make_date(year, F.lit(3), F.lit(31))
    return df.withColumns({"first_day": first, "last_day": last})


def with_review_totals(df: DataFrame) -> DataFrame:
    """Home plus premises reviews; NULL when either part is NULL."""
    return df.withColumns(
        {
            "AUR_ALL": F.col("AUR_HOME") + F.col("AUR_PREM"),
            "NUM_AUR_ALL": F.col("NUM_AUR_HOME") + F.col("NUM_AUR_PREM"),
        }
    )


def prepare(fact: DataFrame, params: ReportParams) -> DataFrame:
    return (
        fact.transform(parse_dates)
        .transform(with_period_bounds, params)
        .transform(with_review_totals)
    )

"""Scalar expressions whose plain Spark form gives other results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date text is day first, with the year-first form also accepted.
DATE_PATTERNS = ("d/M/yyyy", "yyyy-MM-dd")
NO_DATE_YEAR = 9999


def parse_date(text: Column, patterns: Sequence[str] = DATE_PATTERNS) -> Column:
    """First pattern that fits; NULL for other text and for the year 9999.

    A time of day after the date is ignored.
    """
    day = F.substring_index(F.trim(text), " ", 1)
    parsed = F.coalesce(*[F.try_to_date(day, p) for p in patterns])
    return F.when(F.year(parsed) != NO_DATE_YEAR, parsed)


def substring_between(text: Column, start: int, stop: int) -> Column:
    return F.substring(text, start, stop - start + 1)


def year_start(label: Column) -> Column:
    """1 April of the first year of a ``1999/2000`` label."""
    return F.make_date(substring_between(label, 1, 4).cast("int"), F.lit(4), F.lit(1))


def year_end(label: Column) -> Column:
    """31 March of the second year of a ``1999/2000`` label."""
    return F.make_date(substring_between(label, 6, 9).cast("int"), F.lit(3), F.lit(31))


def financial_year_start(date: Column) -> Column:
    """Calendar year in which the April to March year of a date begins."""
    return F.year(F.add_months(date, -3))


def financial_year_label(start_year: Column) -> Column:
    return F.concat(start_year.cast("string"), F.lit("/"), (start_year + 1).cast("string"))


def month_key(date: Column) -> Column:
    return F.year(date) * 100 + F.month(date)


def financial_year_of_month(year_month: Column) -> Column:
    """Label of the April to March year of a 202303-like month key."""
    start = F.floor((year_month - 4) / 100).cast("int")
    return financial_year_label(start)


def month_start(year_month: Column) -> Column:
    return F.try_to_date(F.concat(year_month.cast("string"), F.lit("01")), "yyyyMMdd")


def safe_ratio(a: Column, b: Column) -> Column:
    """Quotient as double, NULL where the divisor is 0 or NULL."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def r_round(x: Column, digits: int = 0) -> Column:
    """Round with ties to even."""
    return F.bround(x, digits)


def signif3(x: Column) -> Column:
    """Round to three significant figures, ties to even; 0 stays 0."""
    value = x.cast("double")
    places = F.lit(2) - F.floor(F.log10(F.abs(value)))
    up = F.pow(F.lit(10.0), places)
    down = F.pow(F.lit(10.0), -places)
    return (
        F.when(value == 0, F.lit(0.0))
        .when(places >= 0, F.bround(value * up, 0) / up)
        .otherwise(F.bround(value / down, 0) * down)
    )


def recode(x: Column, match: str, then: str, otherwise: str) -> Column:
    """Two-way recode that leaves NULL alone."""
    missing = F.lit(None).cast("string")
    return F.when(x.isNull(), missing).when(x == match, then).otherwise(otherwise)


def labelled(x: Column, labels: Mapping[str, str]) -> Column:
    """Label of a code; NULL for a code without a label."""
    out = None
    for code, label in labels.items():
        out = F.when(x == code, label) if out is None else out.when(x == code, label)
    return out


def not_in(x: Column, values: Sequence[str]) -> Column:
    """Anti-membership that keeps NULL rows, which SQL ``NOT IN`` would drop."""
    return ~x.isin(list(values)) | x.isNull()


def position_in(x: Column, values: Sequence[str]) -> Column:
    """1-based position in a list, NULL for values not listed."""
    return F.nullif(F.array_position(F.array(*[F.lit(v) for v in values]), x), F.lit(0))


def in_listed_order(x: Column, values: Sequence[str]) -> Column:
    """Sort key by position in a list, unlisted values last."""
    return position_in(x, values).asc_nulls_last()

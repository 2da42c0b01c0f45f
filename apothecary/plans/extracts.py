"""Extracts: fact rows reduced to measures by period, class and geography."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apothecary.operators.median import exact_median, medians_of_counts, value_counts
from apothecary.operators.prep import prepare
from apothecary.params import ReportParams
from apothecary.plans.measures import MEASURES, MEDIAN, MONTHLY_OVERRIDES
from apothecary.schemas import CLASS, GEOGRAPHY, MONEY_TOTAL_TYPE
from apothecary.session import written

NATIONAL = ("FINANCIAL_YEAR", CLASS)
MONTHLY = ("YEAR_MONTH", CLASS)
SUB_NATIONAL = ("FINANCIAL_YEAR", CLASS, *GEOGRAPHY)
GRAINS = ("national", "sub_national")


def extract(
    fact: DataFrame,
    keys: tuple[str, ...],
    params: ReportParams,
    measures: Iterable[str] | None = None,
) -> DataFrame:
    """Measures by ``keys``; all of them, or those named.

    Everything but the median is a plain sum or count, formed partially before
    one small shuffle. The median has a plan of its own and is joined in only
    when asked for.
    """
    wanted = [m for m in MEASURES if measures is None or m.name in set(measures)]
    if "YEAR_MONTH" in keys:
        wanted = [MONTHLY_OVERRIDES.get(m.name, m) for m in wanted]
    rows = prepare(fact, params)
    out = rows.groupBy(*keys).agg(
        *[m.column() for m in wanted if m != MEDIAN] or [F.count(F.lit(1)).alias("_rows")]
    )
    if MEDIAN in wanted:
        out = _with_median(out, fact, keys, params)
    return out.selectExpr(*[f"{k} AS {k.lower()}" for k in keys], *[m.name for m in wanted])


def _with_median(
    out: DataFrame, fact: DataFrame, keys: tuple[str, ...], params: ReportParams
) -> DataFrame:
    medians = exact_median(
        fact, list(keys), MEDIAN.source, MEDIAN.name, params.median_bracket_accuracy
    )
    medians = medians.select(
        *[F.col(k).alias(k + "_m") for k in keys], MEDIAN.name
    )
    same = None
    for k in keys:
        pair = out[k].eqNullSafe(medians[k + "_m"])
        same = pair if same is None else same & pair
    return out.join(medians, same, "left").drop(*[k + "_m" for k in keys])


def _ordered(df: DataFrame, first: str) -> DataFrame:
    return df.orderBy(F.col(first).asc_nulls_last(), F.col(CLASS.lower()).asc_nulls_last())


def national_extract(fact: DataFrame, params: ReportParams) -> DataFrame:
    return _ordered(extract(fact, NATIONAL, params), "financial_year")


def monthly_extract(month_fact: DataFrame, params: ReportParams) -> DataFrame:
    return _ordered(extract(month_fact, MONTHLY, params), "year_month")


def sub_national_extract(fact: DataFrame, params: ReportParams) -> DataFrame:
    return _ordered(extract(fact, SUB_NATIONAL, params), "financial_year")


def median_values(fact: DataFrame) -> DataFrame:
    """The median's column by class and area, as counts to be written beside the fact."""
    return value_counts(fact, list(SUB_NATIONAL), MEDIAN.source)


def both_grains(fact: DataFrame, params: ReportParams, values: DataFrame | None = None) -> DataFrame:
    """National and sub-national measures from one pass over the fact.

    Sums of the sub-national rows are the national sums, so the grouping sets
    expand the few aggregated rows and not the fact. The median is no such sum;
    it comes from ``values``, the table of ``median_values`` that was written beside
    the fact. Without one, the counts are made and written first.
    """
    if values is None:
        values = written(median_values(fact), "values")
    names = [m.name for m in MEASURES if m != MEDIAN]
    money = {m.name for m in MEASURES if m.is_money}
    keys = [k.lower() for k in SUB_NATIONAL]
    nation = [k.lower() for k in NATIONAL]
    sub = extract(fact, SUB_NATIONAL, params, names)
    sums = [
        F.sum(n).cast(MONEY_TOTAL_TYPE if n in money else "bigint").alias(n) for n in names
    ]
    sets = [[sub[k] for k in keys], [sub[k] for k in nation]]
    grouped = sub.groupingSets(sets, *[sub[k] for k in keys]).agg(
        F.when(F.grouping("icb_code") == 1, GRAINS[0]).otherwise(GRAINS[1]).alias("grain"),
        *sums,
    )

    both = medians_of_counts(values, dict(zip(GRAINS, (list(NATIONAL), list(SUB_NATIONAL)))), list(SUB_NATIONAL), MEDIAN.name)
    both = both.select(F.col("grain").alias("grain_m"), *[F.col(k).alias(k.lower() + "_m") for k in SUB_NATIONAL], MEDIAN.name)
    same = grouped["grain"] == both["grain_m"]
    for k in keys:
        same = same & grouped[k].eqNullSafe(both[k + "_m"])
    return grouped.join(both, same, "left").select("grain", *keys, *[m.name for m in MEASURES])

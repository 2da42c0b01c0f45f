"""The contractor fact, built from dispensing claims.

Claims are by far the largest input. They are read once and shuffled once:
``contractor_months`` adds them up by contractor and month, with partial sums
formed before the shuffle, so a contractor with a third of all claims sends no
more rows than any other. Everything later works on that reduced table; year
rows are sums of month rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apothecary.functions.scalars import (
    financial_year_label,
    financial_year_of_month,
    financial_year_start,
    month_key,
    safe_ratio,
)
from apothecary.operators.latest import latest_state
from apothecary.params import BANDS, ReportParams
from apothecary.schemas import CLASS, GEOGRAPHY, MONEY, MONEY_TYPE, VOLUMES

YEAR = ("FINANCIAL_YEAR",)
MONTH = ("FINANCIAL_YEAR", "YEAR_MONTH")
ATTRIBUTES = (
    CLASS, *GEOGRAPHY, "DIST_SELLING_DISPENSER_HIST", "LPS_DISPENSER_HIST",
    "START_DATE_HIST", "CLOSE_DATE_HIST",
)


def _sums() -> list[Column]:
    return [F.expr(f"sum({c}) AS {c}") for c in (*VOLUMES, *MONEY)]


def contractor_months(claims: DataFrame) -> DataFrame:
    """Claims added up by contractor and month.

    The month is kept as a number while claims are grouped; the label of its
    financial year is written once per month row, not once per claim.
    """
    per_month = (
        claims.withColumn("YEAR_MONTH", month_key(F.col("CLAIM_DATE")))
        .groupBy("CONTRACTOR_ID", "YEAR_MONTH")
        .agg(*_sums())
    )
    return per_month.selectExpr(
        "CONTRACTOR_ID", "YEAR_MONTH", "1L AS MONTHS_ACTIVE", *VOLUMES, *MONEY
    ).withColumn("FINANCIAL_YEAR", financial_year_of_month(F.col("YEAR_MONTH")))


def contractor_years(months: DataFrame) -> DataFrame:
    """Month rows added up by contractor and financial year."""
    return months.groupBy("CONTRACTOR_ID", *YEAR).agg(
        F.sum("MONTHS_ACTIVE").alias("MONTHS_ACTIVE"), *_sums()
    )


def pounds(column: str) -> str:
    """An amount in pence as the money type, as expression text."""
    return f"cast({column} * 0.01BD AS {MONEY_TYPE.simpleString()}) AS {column}"


def of_known_contractors(activity: DataFrame, contractors: DataFrame) -> DataFrame:
    """Activity of pharmacies and appliance contractors only.

    Applied after adding up: the contractor is a grouping key, so the result is
    that of filtering the claims, over far fewer rows.
    """
    return activity.join(contractors.select("CONTRACTOR_ID"), "CONTRACTOR_ID", "left_semi")


def volume_band(average: Column, params: ReportParams) -> Column:
    """Dispensing band of an average; upper bounds are inclusive."""
    out = F.when(average <= params.band_upper_bounds[0], BANDS[0])
    for bound, label in zip(params.band_upper_bounds[1:], BANDS[1:]):
        out = out.when(average <= bound, label)
    return out.when(average.isNotNull(), BANDS[-1])


def with_owner_type(rows: DataFrame, period: tuple[str, ...], params: ReportParams) -> DataFrame:
    """Multiple contractor where the owner has enough rows in the period.

    Owners are counted and joined back rather than windowed, so that the rows
    of one large owner need not meet in a single task.
    """
    large = (
        rows.groupBy(*period, "OWNER_ID")
        .agg(F.count(F.lit(1)).alias("owned"))
        .where(F.col("owned") >= params.multiple_owner_size)
        .select(*period, "OWNER_ID", F.lit(True).alias("is_large"))
    )
    return rows.join(large, [*period, "OWNER_ID"], "left").withColumn(
        "CONTRACTOR_TYPE",
        F.when(F.col("is_large"), "Multiple contractor").otherwise("Independent"),
    )


def contractor_fact(
    activity: DataFrame,
    contractors: DataFrame,
    period: tuple[str, ...],
    params: ReportParams,
) -> DataFrame:
    """Activity per period with contractor attributes, band and owner type.

    ``contractors`` has a row for each contractor, or, with FINANCIAL_YEAR, one for
    each contractor and year. A contractor counts in every period it has claims in. Attributes and owner types
    are settled on narrow rows, without the sixty sums. The sums then meet them
    on contractor and period, the keys by which they were added up, so that
    year sums are not shuffled again.
    """
    by = ["CONTRACTOR_ID", *(YEAR if "FINANCIAL_YEAR" in contractors.columns else ())]
    held = activity.select("CONTRACTOR_ID", *period).join(contractors, by)
    held = with_owner_type(held, period, params).select(
        "CONTRACTOR_ID", *period, *ATTRIBUTES, "CONTRACTOR_TYPE"
    )
    average = safe_ratio(F.col("ITEMS"), F.col("MONTHS_ACTIVE"))
    return (
        activity.join(held, ["CONTRACTOR_ID", *period])
        .withColumn("AVG_MONTHLY_ITEMS", average)
        .withColumn(
            "MONTHLY_DISP_VOL_BAND", volume_band(F.col("AVG_MONTHLY_ITEMS"), params)
        )
        .selectExpr(
            "CONTRACTOR_ID", *reversed(period), *ATTRIBUTES, "CONTRACTOR_TYPE",
            "MONTHLY_DISP_VOL_BAND", "AVG_MONTHLY_ITEMS", *VOLUMES,
            *[pounds(c) for c in MONEY],
        )
    )


def attributes_at_year_end(history: DataFrame, years: DataFrame, *attributes: str) -> DataFrame:
    """The attributes each contractor held on 31 March of every year in ``years``.

    ``history`` has CONTRACTOR_ID, EFFECTIVE_DATE, SEQUENCE (order within a day)
    and the attributes, all of them in every row; ``years`` has CONTRACTOR_ID and
    FINANCIAL_YEAR. The last change inside each financial year is an aggregate with
    results merged before the shuffle, so neither a contractor with a third of all
    changes nor a day with most of them is gathered anywhere. Only these last
    changes, at most one per contractor and year, reach the window that carries a
    state into years without a change.
    """
    start = financial_year_start(F.col("EFFECTIVE_DATE"))
    changes = history.where(F.col("EFFECTIVE_DATE").isNotNull()).withColumn("START", start)
    last = latest_state(changes, ["CONTRACTOR_ID", "START"], ["EFFECTIVE_DATE", "SEQUENCE"], attributes)
    states = last.select(
        "CONTRACTOR_ID",
        financial_year_label(F.col("START")).alias("FINANCIAL_YEAR"),
        "state",
        F.lit(False).alias("asked"),
    )
    asked = years.select("CONTRACTOR_ID", "FINANCIAL_YEAR", F.lit(True).alias("asked"))
    # A contractor's states and years, a few rows each, meet in one window.
    per_year = (
        states.unionByName(asked, allowMissingColumns=True)
        .groupBy("CONTRACTOR_ID", "FINANCIAL_YEAR")
        .agg(
            F.max("state").alias("state"),
            F.bool_or("asked").alias("asked"),
        )
    )
    so_far = (
        Window.partitionBy("CONTRACTOR_ID")
        .orderBy("FINANCIAL_YEAR")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        per_year.withColumn("state", F.last("state", ignorenulls=True).over(so_far))
        .where("asked")
        .select("CONTRACTOR_ID", "FINANCIAL_YEAR", *[F.col(f"state.{a}").alias(a) for a in attributes])
    )


def service_use(claims: DataFrame, fee: str, keys: tuple[str, ...]) -> DataFrame:
    """Fees paid for a service, and contractors paid at least one.

    Claims are reduced to one row per contractor before contractors are
    counted, so no distinct aggregate is needed.
    """
    per_contractor = claims.groupBy(*keys, "CONTRACTOR_ID").agg(F.count(fee).alias("fees"))
    return per_contractor.groupBy(*keys).agg(
        F.sum("fees").alias("services"), F.count_if(F.col("fees") > 0).alias("providers")
    )


def distinct_providers(claims: DataFrame, code: str, keys: tuple[str, ...]) -> DataFrame:
    """Providers counted by dispenser code, whatever addresses they traded from."""
    return claims.groupBy(*keys).agg(F.count_distinct(code).alias("providers"))

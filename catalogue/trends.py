"""Comparisons over time, and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from apothecary.functions.scalars import safe_ratio
from apothecary.operators import checks, trends
from apothecary.operators.reshape import to_long
from apothecary.plans.extracts import NATIONAL, extract
from apothecary.schemas import CLASS, YEAR_FACT
from apothecary.session import run_folder
from catalogue.core import Inputs, query

SERIES = ("appliance_dispenser_hist",)
YEAR = "financial_year"
KEYS = f"{YEAR}, {SERIES[0]}"
OVER = f"(PARTITION BY {SERIES[0]} ORDER BY {YEAR})"
AREA = ("appliance_dispenser_hist", "icb_code")


def _national(s: Inputs, *measures: str):
    return extract(s.year_fact(), NATIONAL, s.params, measures)


def _series(s: Inputs, measure: str, **columns):
    """A national measure with columns made from it per class and year."""
    return _national(s, measure).select(
        YEAR,
        *SERIES,
        measure,
        *[f(F.col(measure), SERIES, YEAR).alias(n) for n, f in columns.items()],
    )


query(
    "win1_change",
    f"SELECT {KEYS}, num_contractors, num_contractors - lag(num_contractors) OVER {OVER}"
    " AS change FROM national",
)(lambda s: _series(s, "num_contractors", change=trends.change))
query(
    "win2_percent_change",
    f"""SELECT {KEYS}, items_total, CAST(items_total - lag(items_total) OVER {OVER} AS DOUBLE)
    / CAST(lag(items_total) OVER {OVER} AS DOUBLE) * 100 AS percent_change FROM national""",
)(lambda s: _series(s, "items_total", percent_change=trends.percent_change))
query(
    "win3_percent_since_first",
    f"""SELECT {KEYS}, items_total, CAST(items_total - first(items_total) OVER {OVER} AS DOUBLE)
    / CAST(first(items_total) OVER {OVER} AS DOUBLE) * 100 AS percent_since_first
    FROM national""",
)(lambda s: _series(s, "items_total", percent_since_first=trends.percent_since_first))
_SHARE = "CAST(eps_items_total_pharm AS DOUBLE) / CAST(items_total AS DOUBLE) * 100"
query(
    "win4_points_since_first",
    f"SELECT {KEYS}, share, share - first(share) OVER {OVER} AS points FROM"
    f" (SELECT *, {_SHARE} AS share FROM national)",
)(
    lambda s: _national(s, "eps_items_total_pharm", "items_total")
    .select(
        YEAR,
        *SERIES,
        (safe_ratio(F.col("eps_items_total_pharm"), F.col("items_total")) * 100).alias("share"),
    )
    .withColumn("points", trends.points_since_first(F.col("share"), SERIES, YEAR))
)
query(
    "win5_fold_since_first",
    f"""SELECT {KEYS}, num_nms_total, CAST(num_nms_total AS DOUBLE)
    / nullif(CAST(first(num_nms_total) OVER {OVER} AS DOUBLE), 0) AS fold FROM national""",
)(lambda s: _series(s, "num_nms_total", fold=trends.fold_since_first))
query(
    "win6_extremes",
    f"""SELECT {KEYS}, items_total, items_total = max(items_total) OVER {OVER} AS highest,
    items_total = min(items_total) OVER {OVER} AS lowest,
    rank() OVER (PARTITION BY {SERIES[0]} ORDER BY items_total DESC) AS place FROM national""",
)(
    lambda s: _series(
        s, "items_total", highest=trends.highest_so_far, lowest=trends.lowest_so_far
    ).withColumn(
        "place", trends.rank_from_highest(F.col("items_total"), SERIES).cast("bigint")
    )
)
query(
    "win6_highest_since",
    f"""SELECT {KEYS}, a.items_total, (SELECT max(b.{YEAR}) FROM national b
    WHERE b.{SERIES[0]} = a.{SERIES[0]} AND b.{YEAR} < a.{YEAR}
    AND b.items_total >= a.items_total) AS highest_since FROM national a""",
)(
    lambda s: trends.highest_since(
        _national(s, "items_total").select(YEAR, *SERIES, "items_total"),
        "items_total", SERIES, YEAR, "highest_since",
    )
)
# The run is restated by counting back: rises since the last year without one.
query(
    "win7_rising_run",
    f"""WITH areas AS (SELECT {KEYS}, icb_code, items_total, items_total > lag(items_total)
    OVER (PARTITION BY {', '.join(AREA)} ORDER BY {YEAR}) AS rise FROM sub_national)
    SELECT {KEYS}, icb_code, items_total, (SELECT count(*) FROM areas b
    WHERE b.icb_code = a.icb_code AND b.{SERIES[0]} = a.{SERIES[0]} AND b.{YEAR} <= a.{YEAR}
    AND b.{YEAR} > (SELECT max(c.{YEAR}) FROM areas c WHERE c.icb_code = a.icb_code
    AND c.{SERIES[0]} = a.{SERIES[0]} AND c.{YEAR} <= a.{YEAR}
    AND c.rise IS NOT TRUE)) AS run FROM areas a""",
)(
    lambda s: trends.rising_run(
        s.year_fact()
        .groupBy(
            F.col("FINANCIAL_YEAR").alias(YEAR),
            F.col(CLASS).alias(SERIES[0]),
            F.col("ICB_CODE").alias("icb_code"),
        )
        .agg(F.sum("ITEMS").alias("items_total")),
        "items_total", AREA, YEAR, "run",
    )
)
query(
    "win8_electronic_providers",
    f"""SELECT {KEYS}, num_eps_pharm, num_contractors, CAST(num_eps_pharm AS DOUBLE)
    / CAST(num_contractors AS DOUBLE) * 100 AS share FROM national""",
)(
    lambda s: _national(s, "num_eps_pharm", "num_contractors").withColumn(
        "share", safe_ratio(F.col("num_eps_pharm"), F.col("num_contractors")) * 100
    ).select(YEAR, *SERIES, "num_eps_pharm", "num_contractors", "share")
)

# -- checks -----------------------------------------------------------------------

query(
    "chk1_duplicates",
    "SELECT l_orderkey AS order_key, l_linenumber AS line, count(*) AS rows FROM lineitem"
    " GROUP BY ALL HAVING count(*) > 1",
)(
    lambda s: checks.duplicate_keys(
        s.table("lineitem").selectExpr("l_orderkey AS order_key", "l_linenumber AS line"),
        ["order_key", "line"],
    )
)
query(
    "chk1_missing",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM year_fact"
        for c in YEAR_FACT.fieldNames()
    ),
)(lambda s: checks.missing_counts(s.year_fact()))
query(
    "chk1_categories",
    "SELECT o_orderstatus AS value, count(*) AS rows FROM orders"
    " WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1",
)(lambda s: checks.unlisted_values(s.table("orders"), "o_orderstatus", ["F", "O"]))


def _yearly_items(months):
    return (
        months.groupBy(F.col("FINANCIAL_YEAR").alias(YEAR), F.col(CLASS).alias(SERIES[0]))
        .agg(F.sum("ITEMS").alias("items"))
    )


query(
    "chk2_differences",
    f"""WITH then_ AS (SELECT FINANCIAL_YEAR AS {YEAR}, APPLIANCE_DISPENSER_HIST AS
    {SERIES[0]}, CAST(sum(ITEMS) AS BIGINT) AS v FROM month_fact WHERE YEAR_MONTH < 200103
    GROUP BY 1, 2), now_ AS (SELECT FINANCIAL_YEAR AS {YEAR}, APPLIANCE_DISPENSER_HIST AS
    {SERIES[0]}, CAST(sum(ITEMS) AS BIGINT) AS v FROM month_fact GROUP BY 1, 2)
    SELECT {KEYS}, then_.v AS published_value, now_.v AS recomputed_value
    FROM then_ FULL JOIN now_ USING ({KEYS}) WHERE then_.v IS DISTINCT FROM now_.v""",
)(
    lambda s: checks.differences(
        # As they stood when months before March 2001 were in, and as they are.
        _yearly_items(s.month_fact().where("YEAR_MONTH < 200103")),
        _yearly_items(s.month_fact()),
        [YEAR, *SERIES],
        "items",
    )
)
_WATCHED = ("num_contractors", "items_total", "num_nms_total")


def _limits(s: Inputs):
    long = to_long(_national(s, *_WATCHED), [YEAR, *SERIES], list(_WATCHED))
    out = checks.control_limits(long, [*SERIES, "measure"], "value", width=1.5)
    return out.select(
        YEAR, *SERIES, "measure", "value", "outlier",
        *[F.round(c, 3).alias(c) for c in ("mean", "lower_limit", "upper_limit")],
    )


query(
    "chk3_control_limits",
    f"""SELECT {KEYS}, measure, value, value < m - 1.5 * d OR value > m + 1.5 * d AS outlier,
    round(m, 3) AS mean, round(m - 1.5 * d, 3) AS lower_limit,
    round(m + 1.5 * d, 3) AS upper_limit FROM (SELECT *,
    avg(value) OVER (PARTITION BY {SERIES[0]}, measure) AS m,
    stddev_samp(value) OVER (PARTITION BY {SERIES[0]}, measure) AS d FROM ("""
    + " UNION ALL ".join(
        f"SELECT {KEYS}, '{m}' AS measure, {m} AS value FROM national" for m in _WATCHED
    )
    + "))",
)(_limits)


def _left_out(s: Inputs):
    long = to_long(_national(s, *_WATCHED), [YEAR, *SERIES], list(_WATCHED))
    out = checks.limits_without_the_point(long, [*SERIES, "measure"], YEAR, "value", width=3.0)
    limits = ("mean", "lower_limit", "upper_limit", "range_lower", "range_upper")
    return out.select(
        YEAR, *SERIES, "measure", "value", "outlier", "range_outlier", *[F.round(c, 2).alias(c) for c in limits])


_LEFT = f"""SELECT *, avg(value) OVER others AS m, stddev_samp(value) OVER others AS d,
    (sum(step) OVER whole - coalesce(step, 0) - coalesce(next_step, 0))
    / nullif(count(step) OVER whole - (step IS NOT NULL)::INT - (next_step IS NOT NULL)::INT, 0) AS r
    FROM (SELECT *, lead(step) OVER line AS next_step FROM (SELECT *, abs(value - lag(value) OVER line) AS step FROM ("""
_LEFT += " UNION ALL ".join(f"SELECT {KEYS}, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM national" for m in _WATCHED)
_LEFT += f""") WINDOW line AS (PARTITION BY {SERIES[0]}, measure ORDER BY {YEAR}))
    WINDOW line AS (PARTITION BY {SERIES[0]}, measure ORDER BY {YEAR}))
    WINDOW whole AS (PARTITION BY {SERIES[0]}, measure),
    others AS (PARTITION BY {SERIES[0]}, measure ORDER BY {YEAR}
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING EXCLUDE CURRENT ROW)"""
query(
    "chk3_without_the_point",
    f"""SELECT {KEYS}, measure, value, value < m - 3 * d OR value > m + 3 * d AS outlier,
    value < m - 2.66 * r OR value > m + 2.66 * r AS range_outlier, round(m, 2) AS mean,
    round(m - 3 * d, 2) AS lower_limit, round(m + 3 * d, 2) AS upper_limit,
    round(m - 2.66 * r, 2) AS range_lower, round(m + 2.66 * r, 2) AS range_upper FROM ({_LEFT})""",
)(_left_out)


def _observed(s: Inputs):
    """NULLs and classes out of list, counted while the year fact is written once more."""
    rows, observed = checks.watched(s.year_fact_from(s.activity()), {CLASS: ["Y"]})
    rows.write.mode("overwrite").parquet(run_folder(s.spark, "files/watched"))
    return checks.seen(s.spark, observed)


query(
    "chk1_observed",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS missing,"
        f" {f"count(*) FILTER ({c} <> 'Y')" if c == CLASS else 'CAST(NULL AS BIGINT)'} AS unlisted FROM year_fact"
        for c in YEAR_FACT.fieldNames()
    ),
)(_observed)

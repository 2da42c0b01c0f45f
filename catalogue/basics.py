"""Preparation, filters, joins, aggregates, reshaping, order and scalars."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from apothecary.functions.aggregates import (
    sole,
    sum0,
    sum0_where,
    sum_strict,
    sum_strict_where,
)
from apothecary.functions.scalars import (
    labelled,
    month_start,
    not_in,
    parse_date,
    position_in,
    r_round,
    recode,
    safe_ratio,
    signif3,
    substring_between,
    year_end,
    year_start,
)
from apothecary.operators import prep
from apothecary.functions.formatting import thousands
from apothecary.operators.median import exact_median
from apothecary.operators.reshape import complete, to_long, to_wide
from apothecary.params import BANDS, DECISIONS, GRANTED, LOCALITIES, REFUSED
from apothecary.plans import appeals, figures, tables
from apothecary.plans.extracts import NATIONAL
from apothecary.schemas import CLASS, VOLUMES
from catalogue.core import Inputs, query
from catalogue.report import signif3 as sql_signif3
from catalogue.sql import median as sql_median

ID = ["CONTRACTOR_ID", "FINANCIAL_YEAR"]
IDS = "CONTRACTOR_ID AS contractor_id, FINANCIAL_YEAR AS financial_year"


def ids(*more: str) -> list[str]:
    return ["CONTRACTOR_ID AS contractor_id", "FINANCIAL_YEAR AS financial_year", *more]


def keyed(df, **columns):
    """Contractor and year with computed columns."""
    return df.select(
        F.col("CONTRACTOR_ID").alias("contractor_id"),
        F.col("FINANCIAL_YEAR").alias("financial_year"),
        *[c.alias(n) for n, c in columns.items()],
    )


# -- preparation ---------------------------------------------------------------

query("prp01_open_ended", f"SELECT {IDS}, closed AS close_date FROM year_fact")(
    lambda s: keyed(s.year_fact(), close_date=parse_date(F.col("CLOSE_DATE_HIST")))
)
query("prp02_dates", f"SELECT {IDS}, opened AS start_date, closed AS close_date FROM year_fact")(
    lambda s: keyed(
        prep.parse_dates(s.year_fact()),
        start_date=F.col("START_DATE_HIST"),
        close_date=F.col("CLOSE_DATE_HIST"),
    )
)
query("prp03_year_bounds", f"SELECT {IDS}, first_day, last_day FROM year_rows")(
    lambda s: keyed(
        s.year_fact(),
        first_day=year_start(F.col("FINANCIAL_YEAR")),
        last_day=year_end(F.col("FINANCIAL_YEAR")),
    )
)
query(
    "prp04_month_bounds",
    f"SELECT {IDS}, YEAR_MONTH AS year_month, first_day, last_day FROM month_rows",
)(
    lambda s: keyed(
        prep.with_period_bounds(s.month_fact(), s.params),
        year_month=F.col("YEAR_MONTH"),
        first_day=F.col("first_day"),
        last_day=F.col("last_day"),
    )
)
query(
    "prp05_review_totals",
    f"SELECT {IDS}, CAST(AUR_ALL AS DECIMAL(19,2)) AS aur_all,"
    " CAST(NUM_AUR_ALL AS BIGINT) AS num_aur_all FROM year_rows",
)(
    lambda s: prep.with_review_totals(s.year_fact()).selectExpr(
        *ids("AUR_ALL AS aur_all", "NUM_AUR_ALL AS num_aur_all")
    )
)
query(
    "prp06_filled",
    f"SELECT {IDS}, " + ", ".join(f"coalesce({v}, 0) AS {v.lower()}" for v in VOLUMES)
    + " FROM year_fact",
)(
    lambda s: prep.fill_numeric(s.year_fact()).selectExpr(
        *ids(*[f"{v} AS {v.lower()}" for v in VOLUMES])
    )
)
query(
    "prp07_recoded",
    "SELECT financial_year, locality, CASE WHEN application_decision = 'refused application'"
    " THEN 'Application refused' ELSE 'Application granted' END AS decision FROM current_rows",
)(
    lambda s: s.appeals_current().select(
        "financial_year",
        "locality",
        recode(F.col("application_decision"), "refused application", REFUSED, GRANTED).alias(
            "decision"
        ),
    )
)
query(
    "prp08_class_labels",
    f"""SELECT {IDS},
    CASE APPLIANCE_DISPENSER_HIST WHEN 'Y' THEN 'Appliance contractors'
        WHEN 'N' THEN 'Community pharmacies' END AS plural,
    CASE APPLIANCE_DISPENSER_HIST WHEN 'Y' THEN 'Total items - appliance contractors'
        WHEN 'N' THEN 'Total items - community pharmacies' END AS items,
    CASE APPLIANCE_DISPENSER_HIST WHEN 'Y' THEN 'Appliance contractor'
        WHEN 'N' THEN 'Community pharmacy' END AS singular FROM year_fact""",
)(
    lambda s: keyed(
        s.year_fact(),
        plural=labelled(F.col(CLASS), figures.CLASSES),
        items=labelled(F.col(CLASS), figures.BY_NUMBER[2].long_classes),
        singular=labelled(F.col(CLASS), figures.SINGLE_CLASSES),
    )
)


FLU_MEASURES = ("num_flu_pharm", "flu_items_total", "flu_cost_total", "flu_fees_total")


def _national_with_flu(s: Inputs):
    return s.extracts()(NATIONAL, [*FLU_MEASURES])


query(
    "prp09_flu_replaced",
    "SELECT financial_year, appliance_dispenser_hist, num_flu_pharm_csv AS num_flu_pharm,"
    " flu_items_total_csv AS flu_items_total, flu_cost_total_csv AS flu_cost_total,"
    " flu_fees_total_csv AS flu_fees_total FROM with_flu",
)(
    lambda s: _national_with_flu(s).select(
        "financial_year", "appliance_dispenser_hist", *FLU_MEASURES
    )
)
query(
    "prp10_month_dates",
    f"SELECT {IDS}, make_date(YEAR_MONTH // 100, YEAR_MONTH % 100, 1) AS month FROM month_fact",
)(lambda s: keyed(s.month_fact(), month=month_start(F.col("YEAR_MONTH"))))
query(
    "prp11_constant",
    "SELECT financial_year, 'Total' AS locality, application_decision FROM current_rows",
)(
    lambda s: s.appeals_current()
    .withColumn("locality", F.lit(LOCALITIES[2]))
    .select("financial_year", "locality", "application_decision")
)
query(
    "prp12_paper_items",
    f"SELECT {IDS}, ITEMS - EPS_ITEMS AS paper_items FROM year_fact",
)(lambda s: keyed(s.year_fact(), paper_items=F.col("ITEMS") - F.col("EPS_ITEMS")))
query(
    "prp13_renamed",
    f"SELECT {IDS}, ITEMS AS total_items, NIC AS total_cost FROM year_fact",
)(
    lambda s: s.year_fact()
    .select("CONTRACTOR_ID", "FINANCIAL_YEAR", "ITEMS", "NIC", "EPS_ITEMS")
    .drop("EPS_ITEMS")
    .toDF("contractor_id", "financial_year", "total_items", "total_cost")
)


def _columns_by_name(s: Inputs):
    fact = s.year_fact().select(*ID, "AVG_MONTHLY_ITEMS", "PFCP_FEES", "PFCP_MONTHS", "CLOSE_DATE_HIST")
    chosen = (
        prep.columns_starting(fact, "pfcp_")
        + prep.columns_containing(fact, "date_hist")
        + [c for c in prep.numeric_columns(fact) if c.startswith("AVG")]
    )
    return fact.selectExpr(*ids(*[f"{c} AS {c.lower()}" for c in chosen]))


query(
    "prp14_chosen_by_name",
    f"SELECT {IDS}, PFCP_FEES AS pfcp_fees, PFCP_MONTHS AS pfcp_months,"
    " CLOSE_DATE_HIST AS close_date_hist, AVG_MONTHLY_ITEMS AS avg_monthly_items FROM year_fact",
)(_columns_by_name)

# -- filters ----------------------------------------------------------------------

query(
    "flt1_class",
    f"SELECT {IDS}, ITEMS AS items FROM year_fact WHERE APPLIANCE_DISPENSER_HIST = 'Y'",
)(lambda s: keyed(s.year_fact().where(F.col(CLASS) == "Y"), items=F.col("ITEMS")))
query(
    "flt2_latest_year",
    f"SELECT {IDS}, ITEMS AS items FROM year_fact"
    " WHERE FINANCIAL_YEAR = '2001/2002' AND APPLIANCE_DISPENSER_HIST = 'N'",
)(
    lambda s: keyed(
        s.year_fact().where(
            (F.col("FINANCIAL_YEAR") == s.params.latest_year) & (F.col(CLASS) == "N")
        ),
        items=F.col("ITEMS"),
    )
)
query(
    "flt3_member",
    f"SELECT {IDS}, ITEMS AS items FROM year_fact"
    " WHERE FINANCIAL_YEAR IN ('2000/2001', '2001/2002')",
)(
    lambda s: keyed(
        s.year_fact().where(F.col("FINANCIAL_YEAR").isin(list(s.params.smoking_years))),
        items=F.col("ITEMS"),
    )
)
query(
    "flt4_not_member",
    f"""SELECT {IDS}, MONTHLY_DISP_VOL_BAND AS band, FLU_ITEMS AS flu_items FROM year_fact
    WHERE APPLIANCE_DISPENSER_HIST = 'N' AND (FLU_ITEMS IS NULL OR FLU_ITEMS NOT IN (1, 2, 3))
    AND FINANCIAL_YEAR NOT IN ('1997/1998', '1998/1999')""",
)(
    lambda s: keyed(
        s.year_fact().where(
            not_in(F.col("FINANCIAL_YEAR"), ["1997/1998", "1998/1999"])
            & not_in(F.col("FLU_ITEMS"), [1, 2, 3])
            & (F.col(CLASS) == "N")
        ),
        band=F.col("MONTHLY_DISP_VOL_BAND"),
        flu_items=F.col("FLU_ITEMS"),
    )
)
query(
    "flt5_month_threshold",
    f"SELECT {IDS}, YEAR_MONTH AS year_month FROM month_fact WHERE YEAR_MONTH > 200103",
)(
    lambda s: keyed(
        s.month_fact().where(F.col("YEAR_MONTH") > s.params.contraception_after_month),
        year_month=F.col("YEAR_MONTH"),
    )
)
query(
    "flt6_localities",
    """SELECT financial_year, locality, application_decision,
    CAST(sum(total_decisions) AS BIGINT) AS decisions FROM appeals
    WHERE locality IN ('Controlled', 'Non-Controlled') GROUP BY ALL""",
)(
    lambda s: s.appeals_history()
    .unionByName(appeals.digest_current(s.appeals_current()))
    .where(F.col("locality").isin(list(LOCALITIES[:2])))
    .groupBy(*appeals.KEYS)
    .agg(F.sum("total_decisions").alias("decisions"))
)

# -- joins ------------------------------------------------------------------------

query(
    "jn1_flu_reference",
    "SELECT financial_year, appliance_dispenser_hist, num_flu_pharm_dwh, num_flu_pharm_csv,"
    " flu_items_total_dwh, flu_items_total_csv, flu_cost_total_dwh, flu_cost_total_csv,"
    " flu_fees_total_dwh, flu_fees_total_csv FROM with_flu",
)(
    lambda s: _national_with_flu(s).drop(*FLU_MEASURES)
)


def _bands_joined(s: Inputs):
    """Both long forms, joined on year and band."""
    source = s.extracts()
    name = "dispensing_volume_band"
    counts = to_long(
        tables.band_totals(source, "band_items"), ["financial_year"], None, name, "pharmacies"
    )
    items = to_long(
        tables.band_totals(source, "vol_items"), ["financial_year"], None, name, "items"
    )
    return counts.join(items, ["financial_year", name], "left")


_BAND_SQL = " UNION ALL ".join(
    f"SELECT financial_year, '{label}' AS dispensing_volume_band,"
    f" band_items_{b} AS pharmacies, vol_items_{b} AS items"
    " FROM national WHERE appliance_dispenser_hist = 'N'"
    for b, label in zip(tables.BAND_MEASURES, BANDS)
)
query("jn2_bands", _BAND_SQL)(_bands_joined)


def _flu_joined(s: Inputs):
    rows = s.extracts()(NATIONAL, ["flu_items_total", "num_flu_pharm"]).where(
        F.col("appliance_dispenser_hist") == "N"
    )
    volume = rows.groupBy("financial_year").agg(sum_strict("flu_items_total").alias("vaccines"))
    mean = rows.groupBy("financial_year").agg(
        r_round(safe_ratio(sum_strict("flu_items_total"), sum_strict("num_flu_pharm")), 0).alias(
            "mean_vaccines"
        )
    )
    return volume.join(mean, "financial_year")


query(
    "jn3_flu_mean",
    "SELECT financial_year, flu_items_total_csv AS vaccines, round_even(CAST("
    "flu_items_total_csv AS DOUBLE) / nullif(CAST(num_flu_pharm_csv AS DOUBLE), 0), 0)"
    " AS mean_vaccines FROM with_flu WHERE appliance_dispenser_hist = 'N'",
)(_flu_joined)
query(
    "jn4_completed",
    """SELECT g.icb_code, g.region_code, b.band, coalesce(n.contractors, 0) AS contractors
    FROM (SELECT DISTINCT ICB_CODE AS icb_code, REGION_CODE AS region_code FROM year_fact) g
    CROSS JOIN (SELECT DISTINCT MONTHLY_DISP_VOL_BAND AS band FROM year_fact) b
    LEFT JOIN (SELECT ICB_CODE AS icb_code, MONTHLY_DISP_VOL_BAND AS band,
        count(*) AS contractors FROM year_fact GROUP BY ALL) n
    ON n.icb_code = g.icb_code AND n.band = b.band""",
)(
    lambda s: complete(
        s.year_fact()
        .groupBy(
            F.col("ICB_CODE").alias("icb_code"),
            F.col("REGION_CODE").alias("region_code"),
            F.col("MONTHLY_DISP_VOL_BAND").alias("band"),
        )
        .agg(F.count(F.lit(1)).alias("contractors")),
        "band",
        ["icb_code", "region_code"],
        "contractors",
    )
)

# -- aggregates -------------------------------------------------------------------



def _by_year(s: Inputs, **columns):
    return (
        s.year_fact()
        .groupBy(F.col("FINANCIAL_YEAR").alias("financial_year"))
        .agg(*[c.alias(n) for n, c in columns.items()])
    )


def _year_sql(columns: str, source: str = "year_fact") -> str:
    return f"SELECT FINANCIAL_YEAR AS financial_year, {columns} FROM {source} GROUP BY 1"


query("agg01_rows", _year_sql("count(*) AS contractors"))(
    lambda s: _by_year(s, contractors=F.count(F.lit(1)))
)
query(
    "agg02_sum0",
    _year_sql(
        "CAST(coalesce(sum(FLU_ITEMS), 0) AS BIGINT) AS flu_items,"
        " CAST(coalesce(sum(FLU_COST), 0) AS DECIMAL(28,2)) AS flu_cost"
    ),
)(lambda s: _by_year(s, flu_items=sum0("FLU_ITEMS"), flu_cost=sum0("FLU_COST")))
query(
    "agg03_count_if",
    _year_sql(
        "count(*) FILTER (WHERE NUM_NMS > 0) AS providers,"
        " count(*) FILTER (WHERE CONTRACTOR_TYPE = 'Independent') AS independent,"
        " count(*) FILTER (WHERE opened >= first_day) AS opened",
        "year_rows",
    ),
)(
    lambda s: prep.prepare(s.year_fact(), s.params)
    .groupBy(F.col("FINANCIAL_YEAR").alias("financial_year"))
    .agg(
        F.count_if(F.col("NUM_NMS") > 0).alias("providers"),
        F.count_if(F.col("CONTRACTOR_TYPE") == "Independent").alias("independent"),
        F.count_if(F.col("START_DATE_HIST") >= F.col("first_day")).alias("opened"),
    )
)
query(
    "agg04_sum_where",
    _year_sql(
        "CAST(coalesce(sum(ITEMS) FILTER (WHERE MONTHLY_DISP_VOL_BAND = '2001 - 4000'), 0)"
        " AS BIGINT) AS items"
    ),
)(
    lambda s: _by_year(
        s, items=sum0_where("ITEMS", F.col("MONTHLY_DISP_VOL_BAND") == "2001 - 4000")
    )
)
query(
    "agg05_median",
    "SELECT FINANCIAL_YEAR AS financial_year, REGION_NAME AS region_name,"
    f" {sql_median('AVG_MONTHLY_ITEMS')} AS median_items FROM year_fact GROUP BY 1, 2",
)(
    lambda s: exact_median(
        s.year_fact(), ["FINANCIAL_YEAR", "REGION_NAME"], "AVG_MONTHLY_ITEMS", "median_items"
    ).selectExpr("FINANCIAL_YEAR AS financial_year", "REGION_NAME AS region_name", "median_items")
)
query(
    "agg06_sum_strict",
    _year_sql(
        "CAST(CASE WHEN count(*) = count(NUM_AUR_HOME) THEN sum(NUM_AUR_HOME) END AS BIGINT)"
        " AS home_reviews,"
        " CAST(CASE WHEN count(*) = count(AUR_PREM) THEN sum(AUR_PREM) END AS DECIMAL(28,2))"
        " AS premises_fees"
    ),
)(
    lambda s: _by_year(
        s, home_reviews=sum_strict("NUM_AUR_HOME"), premises_fees=sum_strict("AUR_PREM")
    )
)
query(
    "agg07_sum_by_class",
    _year_sql(
        "CAST(sum(CASE WHEN APPLIANCE_DISPENSER_HIST = 'N' THEN ITEMS ELSE 0 END) AS BIGINT)"
        " AS pharmacy_items,"
        " CAST(sum(CASE WHEN APPLIANCE_DISPENSER_HIST = 'Y' THEN ITEMS ELSE 0 END) AS BIGINT)"
        " AS appliance_items"
    ),
)(
    lambda s: _by_year(
        s,
        pharmacy_items=sum_strict_where("ITEMS", F.col(CLASS) == "N"),
        appliance_items=sum_strict_where("ITEMS", F.col(CLASS) == "Y"),
    )
)
query(
    "agg08_passed_through",
    "SELECT financial_year, avg_monthly_items_pharm FROM national"
    " WHERE appliance_dispenser_hist = 'N'",
)(
    lambda s: s.extracts()(NATIONAL, ["avg_monthly_items_pharm"])
    .where(F.col("appliance_dispenser_hist") == "N")
    .groupBy("financial_year")
    .agg(sole("avg_monthly_items_pharm").alias("avg_monthly_items_pharm"))
)
query(
    "agg09_ratio",
    _year_sql(
        "CAST(sum(EPS_ITEMS) AS BIGINT) AS eps_items, CAST(sum(ITEMS) AS BIGINT) AS items,"
        " CAST(sum(EPS_ITEMS) AS DOUBLE) / CAST(sum(ITEMS) AS DOUBLE) * 100 AS share"
    ),
)(
    lambda s: _by_year(s, eps_items=sum0("EPS_ITEMS"), items=sum0("ITEMS")).withColumn(
        "share", safe_ratio(F.col("eps_items"), F.col("items")) * 100
    )
)
query(
    "agg10_renamed_keys",
    "SELECT FINANCIAL_YEAR AS year_label, REGION_CODE AS area_code, REGION_NAME AS area_name,"
    " CAST(sum(ITEMS) AS BIGINT) AS items FROM year_fact GROUP BY 1, 2, 3",
)(
    lambda s: s.year_fact()
    .groupBy(
        F.col("FINANCIAL_YEAR").alias("year_label"),
        F.col("REGION_CODE").alias("area_code"),
        F.col("REGION_NAME").alias("area_name"),
    )
    .agg(sum_strict("ITEMS").alias("items"))
)
query(
    "agg11_leftover_key",
    "SELECT financial_year, CAST(sum(costs_total) AS DECIMAL(38,2)) AS costs FROM national"
    " GROUP BY financial_year",
)(
    lambda s: s.extracts()(NATIONAL, ["costs_total"])
    .groupBy("financial_year")
    .agg(sum_strict("costs_total").alias("costs"))
)
query(
    "agg12_distinct_groups",
    "SELECT financial_year, count(DISTINCT appliance_dispenser_hist) AS classes FROM national"
    " GROUP BY financial_year",
)(
    lambda s: s.extracts()(NATIONAL, ["num_contractors"])
    .groupBy("financial_year")
    .agg(F.count_distinct("appliance_dispenser_hist").alias("classes"))
)
query("agg13_totals_beside_parts", "SELECT * FROM current_year")(
    lambda s: appeals.digest_current(s.appeals_current())
)

# -- reshaping, sets, order -----------------------------------------------------------

query("rsh1_long", f"SELECT * EXCLUDE (items) FROM ({_BAND_SQL})")(
    lambda s: to_long(
        tables.band_totals(s.extracts(), "band_items"), ["financial_year"], None,
        "dispensing_volume_band", "pharmacies",
    )
)
query(
    "rsh2_long_chosen",
    " UNION ALL ".join(
        f"SELECT {IDS}, '{c}' AS measure, {c} AS value FROM year_fact"
        for c in ("NUM_MUR", "NUM_NMS")
    ),
)(
    lambda s: to_long(
        s.year_fact().select(*ID, "NUM_MUR", "NUM_NMS", "ITEMS"), ID, ["NUM_MUR", "NUM_NMS"]
    ).toDF("contractor_id", "financial_year", "measure", "value")
)
query(
    "rsh3_wide",
    "SELECT financial_year, scs_nrtprod_cost AS products, scs_cnslt AS consultations"
    " FROM (SELECT financial_year, CAST(sum(scs_cnslt) AS DECIMAL(28,2)) AS scs_cnslt,"
    " CAST(sum(scs_nrtprod_cost) AS DECIMAL(28,2)) AS scs_nrtprod_cost FROM national"
    " GROUP BY 1)",
)(
    lambda s: to_wide(
        to_long(
            s.extracts()(NATIONAL, ["scs_cnslt", "scs_nrtprod_cost"])
            .groupBy("financial_year")
            .agg(
                sum_strict("scs_cnslt").cast("decimal(28,2)").alias("consultations"),
                sum_strict("scs_nrtprod_cost").cast("decimal(28,2)").alias("products"),
            ),
            ["financial_year"],
        ),
        ["financial_year"], "measure", "value", ["products", "consultations"],
    )
)
query("set1_appended", "SELECT * FROM appeals")(
    lambda s: s.appeals_history().unionByName(appeals.digest_current(s.appeals_current()))
)
def _placed(s: Inputs, order):
    boards = (
        s.year_fact()
        .groupBy(F.col("FINANCIAL_YEAR").alias("financial_year"), F.col("ICB_CODE").alias("icb_code"))
        .agg(F.sum("FLU_ITEMS").alias("flu_items"))
    )
    place = F.row_number().over(Window.partitionBy("financial_year").orderBy(order, "icb_code"))
    return boards.withColumn("place", place.cast("bigint")).orderBy("financial_year", order)


query(
    "ord1_ascending",
    """SELECT icb_code, flu_items, row_number() OVER (PARTITION BY financial_year
    ORDER BY flu_items ASC NULLS LAST, icb_code) AS place, financial_year FROM (
    SELECT FINANCIAL_YEAR AS financial_year, ICB_CODE AS icb_code,
    CAST(sum(FLU_ITEMS) AS BIGINT) AS flu_items FROM year_fact GROUP BY 1, 2)""",
)(lambda s: _placed(s, F.col("flu_items").asc_nulls_last()))
query(
    "ord2_descending",
    """SELECT icb_code, flu_items, row_number() OVER (PARTITION BY financial_year
    ORDER BY flu_items DESC NULLS LAST, icb_code) AS place, financial_year FROM (
    SELECT FINANCIAL_YEAR AS financial_year, ICB_CODE AS icb_code,
    CAST(sum(FLU_ITEMS) AS BIGINT) AS flu_items FROM year_fact GROUP BY 1, 2)""",
)(lambda s: _placed(s, F.col("flu_items").desc_nulls_last()))


def _listed(s: Inputs):
    rows = s.appeals_history().unionByName(appeals.digest_current(s.appeals_current()))
    place = F.row_number().over(
        Window.partitionBy("financial_year").orderBy(
            position_in(F.col("locality"), LOCALITIES).asc_nulls_last(),
            position_in(F.col("application_decision"), DECISIONS).asc_nulls_last(),
        )
    )
    return rows.withColumn("place", place.cast("bigint"))


query(
    "ord3_listed",
    """SELECT *, row_number() OVER (PARTITION BY financial_year ORDER BY
    CASE locality WHEN 'Controlled' THEN 1 WHEN 'Non-Controlled' THEN 2 ELSE 3 END,
    CASE application_decision WHEN 'Application granted' THEN 1
    WHEN 'Application refused' THEN 2 ELSE 5 END) AS place FROM appeals""",
)(_listed)

# -- scalars ---------------------------------------------------------------------------

query(
    "scl01_substring",
    f"SELECT {IDS}, substr(FINANCIAL_YEAR, 1, 4) AS first_year,"
    " substr(FINANCIAL_YEAR, 6, 4) AS second_year FROM year_fact",
)(
    lambda s: keyed(
        s.year_fact(),
        first_year=substring_between(F.col("FINANCIAL_YEAR"), 1, 4),
        second_year=substring_between(F.col("FINANCIAL_YEAR"), 6, 9),
    )
)
query(
    "scl02_concatenate",
    f"SELECT {IDS}, CASE WHEN FLU_ITEMS IS NULL THEN NULL ELSE ICB_CODE || '-' || FLU_ITEMS"
    " END AS joined FROM year_fact",
)(
    lambda s: keyed(
        s.year_fact(),
        joined=F.concat("ICB_CODE", F.lit("-"), F.col("FLU_ITEMS").cast("string")),
    )
)
query(
    "scl03_text_to_date",
    f"SELECT {IDS}, closed AS day_first, CAST(NULL AS DATE) AS misfit FROM year_fact",
)(
    lambda s: keyed(
        s.year_fact(),
        day_first=parse_date(F.col("CLOSE_DATE_HIST")),
        misfit=parse_date(F.col("MONTHLY_DISP_VOL_BAND")),
    )
)
query(
    "scl04_text",
    f"SELECT {IDS}, CAST(ITEMS AS VARCHAR) AS items, CAST(NIC AS VARCHAR) AS cost FROM year_fact",
)(
    lambda s: keyed(
        s.year_fact(), items=F.col("ITEMS").cast("string"), cost=F.col("NIC").cast("string")
    )
)
query(
    "scl05_branches",
    f"SELECT {IDS}, CASE APPLIANCE_DISPENSER_HIST WHEN 'Y' THEN 'Appliance contractors'"
    " WHEN 'N' THEN 'Community pharmacies' END AS label FROM year_fact",
)(lambda s: keyed(s.year_fact(), label=labelled(F.col(CLASS), figures.CLASSES)))
query(
    "scl06_two_branches",
    f"SELECT {IDS}, CASE WHEN FLU_ITEMS IS NULL THEN NULL WHEN FLU_ITEMS = 0 THEN 'none'"
    " ELSE 'some' END AS flu FROM year_fact",
)(
    lambda s: keyed(
        s.year_fact(), flu=recode(F.col("FLU_ITEMS").cast("string"), "0", "none", "some")
    )
)
query(
    "scl07_missing",
    f"SELECT {IDS}, FLU_ITEMS IS NULL AS no_flu FROM year_fact",
)(lambda s: keyed(s.year_fact(), no_flu=F.col("FLU_ITEMS").isNull()))
query(
    "scl08_arithmetic",
    f"""SELECT {IDS}, AUR_HOME + AUR_PREM AS plus, ITEMS - EPS_ITEMS AS minus,
    ITEMS * 3 AS times, CAST(NIC AS DOUBLE) / nullif(CAST(NUM_MUR AS DOUBLE), 0) AS per_review
    FROM year_fact""",
)(
    lambda s: keyed(
        s.year_fact(),
        plus=F.col("AUR_HOME") + F.col("AUR_PREM"),
        minus=F.col("ITEMS") - F.col("EPS_ITEMS"),
        times=F.col("ITEMS") * 3,
        per_review=safe_ratio(F.col("NIC"), F.col("NUM_MUR")),
    )
)
query(
    "scl09_round",
    f"SELECT {IDS}, round_even(CAST(NIC AS DOUBLE) / CAST(ITEMS AS DOUBLE), 2) AS cents,"
    " round_even(CAST(ITEMS AS DOUBLE) / 2, 0) AS half FROM year_fact",
)(
    lambda s: keyed(
        s.year_fact(),
        cents=r_round(safe_ratio(F.col("NIC"), F.col("ITEMS")), 2),
        half=r_round(F.col("ITEMS").cast("double") / 2, 0),
    )
)
query(
    "scl10_significant",
    f"SELECT {IDS}, {sql_signif3('CAST(ITEMS AS DOUBLE)')} AS items,"
    f" {sql_signif3('CAST(EPS_ITEMS AS DOUBLE)')} AS eps_items,"
    f" {sql_signif3('(CAST(NIC AS DOUBLE) / CAST(ITEMS AS DOUBLE))')} AS cost FROM year_fact",
)(
    lambda s: keyed(
        s.year_fact(),
        items=signif3(F.col("ITEMS")),
        eps_items=signif3(F.col("EPS_ITEMS")),
        cost=signif3(safe_ratio(F.col("NIC"), F.col("ITEMS"))),
    )
)
query(
    "scl11_thousands",
    # As many decimals as any amount needs for seven significant digits.
    f"""WITH needed AS (SELECT max(CASE WHEN abs(NIC) < 100000 AND NIC * 10 % 1 <> 0 THEN 2
    WHEN abs(NIC) < 1000000 AND round_even(NIC, 1) % 1 <> 0 THEN 1 ELSE 0 END) AS d FROM year_fact)
    SELECT {IDS}, format('{{:,}}', ITEMS) AS items, CASE d
    WHEN 0 THEN format('{{:,.0f}}', CAST(NIC AS DOUBLE)) WHEN 1 THEN format('{{:,.1f}}', CAST(NIC AS DOUBLE))
    ELSE format('{{:,.2f}}', CAST(NIC AS DOUBLE)) END AS cost FROM year_fact, needed""",
)(
    lambda s: thousands(
        keyed(s.year_fact(), ITEMS=F.col("ITEMS"), NIC=F.col("NIC")),
        {"ITEMS": "items", "NIC": "cost"},
    )
)
query(
    "scl12_comparisons",
    f"SELECT {IDS}, FLU_ITEMS > 0 AS has_flu, LPS_DISPENSER_HIST = 'Y' AS is_lps,"
    " closed <= last_day AS has_closed FROM year_rows",
)(
    lambda s: keyed(
        prep.prepare(s.year_fact(), s.params),
        has_flu=F.col("FLU_ITEMS") > 0,
        is_lps=F.col("LPS_DISPENSER_HIST") == "Y",
        has_closed=F.col("CLOSE_DATE_HIST") <= F.col("last_day"),
    )
)
query(
    "scl13_position",
    f"SELECT {IDS}, list_position(['0 - 2000', '2001 - 4000', '4001 - 6000', '6001 - 8000',"
    " '8001 - 10000', '10000+'], MONTHLY_DISP_VOL_BAND) AS place FROM year_fact",
)(
    lambda s: keyed(
        s.year_fact(), place=position_in(F.col("MONTHLY_DISP_VOL_BAND"), BANDS).cast("int")
    )
)
query(
    "scl14_membership",
    f"SELECT {IDS}, FINANCIAL_YEAR IN ('2000/2001', '2001/2002') AS recent FROM year_fact",
)(
    lambda s: keyed(
        s.year_fact(), recent=F.col("FINANCIAL_YEAR").isin(list(s.params.smoking_years))
    )
)

"""Summary tables 1 to 20.

Nineteen tables are one operation with different settings: filter an extract,
group it, sum some measures, add ratios. ``TableSpec`` holds the settings.
Table 4 reshapes bands and table 20 (``plans.appeals``) has its own steps.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apothecary.functions.aggregates import sole, sum_strict, sum_strict_where
from apothecary.functions.scalars import in_listed_order, not_in, r_round, safe_ratio
from apothecary.params import BANDS, ReportParams
from apothecary.plans.extracts import NATIONAL, SUB_NATIONAL, extract
from apothecary.plans.flu import FLU_MEASURES, with_flu_reference
from apothecary.plans.measures import BY_NAME
from apothecary.schemas import MONEY_TOTAL_TYPE

CLASS = "appliance_dispenser_hist"
YEAR = ("financial_year",)
REGION = ("financial_year", "region_code", "region_name")
ICB = ("financial_year", "icb_code", "icb_name")


@dataclass(frozen=True)
class Ratio:
    over: str
    under: str
    scale: int = 1
    digits: int | None = None

    def column(self) -> Column:
        out = safe_ratio(F.col(self.over), F.col(self.under))
        if self.scale != 1:
            out = out * self.scale
        return out if self.digits is None else r_round(out, self.digits)


RATIOS = {
    "electronic_share": Ratio("eps_items_total_pharm", "items_total", scale=100),
    "fees_per_pharmacy": Ratio("prof_fees_total_pharm", "num_contractors"),
    "cost_per_fee": Ratio("costs_total", "prof_fees_total_pharm", digits=2),
    "items_per_pharmacy": Ratio("items_total", "num_contractors"),
}
# Not additive: taken over from the one extract row behind a table row.
PASSED_THROUGH = ("avg_monthly_items_pharm",)


@dataclass(frozen=True)
class TableSpec:
    number: int
    title: str
    columns: tuple[str, ...]
    keys: tuple[str, ...] = YEAR
    contractor_class: str | None = "N"
    years: str = "all"

    @property
    def name(self) -> str:
        return f"table_{self.number:02d}"

    @property
    def grain(self) -> tuple[str, ...]:
        return NATIONAL if self.keys == YEAR else SUB_NATIONAL

    def measures(self) -> list[str]:
        """Measures to sum: the columns, with ratios replaced by their parts."""
        out: list[str] = []
        for c in self.columns:
            parts = (RATIOS[c].over, RATIOS[c].under) if c in RATIOS else (c,)
            out += [p for p in parts if p not in out]
        return out


# The measures of each table, in output order.
ATTRIBUTES = (
    "num_contractors", "num_open_pharm", "num_close_pharm", "num_lps_pharm",
    "num_ind_pharm", "num_multi_pharm", "num_dist_selling_pharm",
)
REVIEWS = (
    "num_contractors", "num_aur_home_pharm", "num_aur_home_total_pharm",
    "num_aur_home_total_fee_pharm", "num_aur_prem_pharm", "num_aur_prem_total_pharm",
    "num_aur_prem_total_fee_pharm", "num_aur_all_pharm", "num_aur_all_total_pharm",
    "num_aur_all_total_fee_pharm", "num_stoma_pharm", "num_stoma_total_pharm",
    "num_stoma_total_fee_pharm",
)
AREA_REVIEWS = (
    "num_contractors", "num_aur_home_pharm", "num_aur_prem_pharm", "num_aur_all_pharm",
    "num_aur_home_total_pharm", "num_aur_prem_total_pharm", "num_aur_all_total_pharm",
    "num_aur_home_total_fee_pharm", "num_aur_prem_total_fee_pharm",
    "num_aur_all_total_fee_pharm", "num_stoma_pharm", "num_stoma_total_pharm",
    "num_stoma_total_fee_pharm",
)
AREA_SERVICES = (
    "num_contractors", "items_total", "num_eps_pharm", "eps_items_total_pharm",
    "electronic_share", "num_nms_pharm", "num_nms_total", "num_nms_fee_total",
    "num_flu_pharm", "flu_items_total", "flu_cost_total", "flu_fees_total",
    "num_cpcs_drugs_pharm", "cpcs_fees_pharm", "cpcs_drugs_pharm",
    "num_hep_c_service_pharm", "hep_c_service_pharm", "hep_c_kit_pharm",
    "num_hypten_inc", "hyptenset_fees", "hyptencheck_fees", "hypten_inc",
    "num_scs_cnslt", "scs_setup", "scs_cnslt", "scs_nrtprod_cost", "items_per_pharmacy",
)
SPECS: tuple[TableSpec, ...] = (
    TableSpec(2, "Pharmacies by attribute", ATTRIBUTES),
    TableSpec(3, "Pharmacy items and cost", (
        "num_contractors", "items_total", "costs_total", "avg_monthly_items_pharm",
        "num_eps_pharm", "eps_items_total_pharm", "electronic_share",
    )),
    TableSpec(5, "Pharmacy essential service fees", (
        "num_contractors", "prof_fees_total_pharm", "prof_fees_pharm",
        "fees_per_pharmacy", "cost_per_fee", "num_cd_fee", "cd_fee",
        "num_cd_sched2_fee", "cd_sched2_fee", "num_cd_sched3_fee", "cd_sched3_fee",
        "num_add_fee_2a", "add_fee_2a", "num_add_fee_mf_pharm", "add_fee_mf_pharm",
        "num_expensive_fees_pharm", "no_expensive_fees_pharm", "expensive_fee_pharm",
        "num_oope_item_count_pharm", "oope_item_count_pharm", "oope_val_pharm",
        "num_discharge_meds", "discharge_meds",
    )),
    TableSpec(6, "Pharmacy advanced services", (
        "num_contractors", "num_nms_pharm", "num_nms_total", "num_nms_fee_total",
        "num_flu_pharm_csv", "flu_items_total_csv", "flu_cost_total_csv",
        "flu_fees_total_csv", "num_hypten_inc", "hyptenset_fees", "hyptencheck_fees",
        "hypten_inc", "num_scs_cnslt", "scs_setup", "scs_cnslt", "scs_nrtprod_cost",
        "num_t1c_cnslt", "t1c_set_up", "t1c_consult", "t1c_prod_cost",
        "num_pfcp_payment", "pfcp_optin", "pfcp_fees", "pfcp_payment", "pfcp_vat",
        "pfcp_umsmideduct", "pfcp_umsmiremuneration", "pfcp_umsmireimbursement",
        "num_hep_c_service_pharm", "hep_c_service_pharm", "hep_c_kit_pharm",
        "num_mur_pharm", "num_mur_total", "num_mur_fee_total",
    )),
    TableSpec(7, "Pharmacy appliance reviews and stoma service", REVIEWS),
    TableSpec(8, "Pharmacy consultation service and urgent supply", (
        "num_contractors", "num_cpcs_drugs_pharm", "cpcs_fees_pharm",
        "cpcs_drugs_pharm", "num_gprefpath_fees", "gprefpath_fees",
        "num_ums_drugs_pharm", "ums_fees_pharm", "ums_drugs_pharm",
    )),
    TableSpec(9, "Pharmacy pandemic services", (
        "num_contractors", "num_cvdtestreg_fees", "cvdtestreg_fees",
        "num_cvdtestset_fees", "cvdtestset_fees", "num_cvdtest_kits", "cvdtest_kits",
        "num_cvd_19_costs", "cvd_19_costs", "num_cvd_19_vaccine", "cvd_19_vaccine",
        "num_cvd_prem_refrid", "cvd_prem_refrid", "num_ppe_claims", "ppe_claims",
        "num_home_del", "num_home_del_total", "home_del_cost_total",
    ), years="pandemic"),
    TableSpec(10, "Appliance contractor items, cost and fees", (
        "num_contractors", "items_total", "costs_total", "avg_monthly_items_pharm",
        "num_eps_pharm", "eps_items_total_pharm", "electronic_share",
        "prof_fees_total_pharm", "prof_fees_pharm", "num_expensive_fees_pharm",
        "no_expensive_fees_pharm", "expensive_fee_pharm", "num_oope_item_count_pharm",
        "oope_item_count_pharm", "oope_val_pharm", "num_add_fee_mf_pharm",
        "add_fee_mf_pharm",
    ), contractor_class="Y"),
    TableSpec(11, "Appliance contractor reviews and stoma service", REVIEWS,
              contractor_class="Y"),
    TableSpec(12, "All contractors: items, cost and fees", (
        "num_contractors", "items_total", "costs_total", "num_eps_pharm",
        "eps_items_total_pharm", "electronic_share", "prof_fees_total_pharm",
        "prof_fees_pharm", "num_add_fee_mf_pharm", "add_fee_mf_pharm",
        "num_expensive_fees_pharm", "no_expensive_fees_pharm", "expensive_fee_pharm",
        "num_oope_item_count_pharm", "oope_item_count_pharm", "oope_val_pharm",
    ), contractor_class=None),
    TableSpec(13, "All contractors: reviews and stoma service", REVIEWS,
              contractor_class=None),
    TableSpec(14, "Regions: pharmacies by attribute", ATTRIBUTES, REGION, years="latest"),
    TableSpec(15, "Local boards: pharmacies by attribute", ATTRIBUTES, ICB, years="latest"),
    TableSpec(16, "Regions: pharmacy services", AREA_SERVICES, REGION, years="latest"),
    TableSpec(17, "Local boards: pharmacy services", AREA_SERVICES, ICB, years="latest"),
    TableSpec(18, "Regions: reviews and stoma service", AREA_REVIEWS, REGION,
              contractor_class=None, years="latest"),
    TableSpec(19, "Local boards: reviews and stoma service", AREA_REVIEWS, ICB,
              contractor_class=None, years="latest"),
)
BY_NUMBER = {s.number: s for s in SPECS}
OTHER_TITLES = {
    1: "Contractors by class",
    4: "Pharmacies and items by dispensing band",
    20: "Decisions on appeals",
}
TITLES = {**OTHER_TITLES, **{s.number: s.title for s in SPECS}}
BAND_MEASURES = ("0_2000", "2001_4000", "4001_6000", "6001_8000", "8001_10000", "10000")

# A source of extracts: (grain, measure names) to a DataFrame.
Extracts = Callable[[tuple[str, ...], list[str]], DataFrame]


def extracts_of(fact: DataFrame, flu: DataFrame | None, params: ReportParams) -> Extracts:
    """Extracts computed from the fact, only with the measures asked for.

    National flu measures come from the flu reference, as ``_csv`` columns and
    under their own names.
    """

    def get(grain: tuple[str, ...], measures: list[str]) -> DataFrame:
        own = [m.removesuffix("_csv") for m in measures]
        out = extract(fact, grain, params, own)
        if grain == NATIONAL and set(own) & set(FLU_MEASURES):
            out = with_flu_reference(out, flu, params)
        return out

    return get


def _measure_sum(name: str) -> Column:
    if name in PASSED_THROUGH:
        return sole(name).alias(name)
    out = sum_strict(name)
    if BY_NAME[name.removesuffix("_csv")].is_money:
        out = out.cast(MONEY_TOTAL_TYPE)
    return out.alias(name)


def _filters(df: DataFrame, spec: TableSpec, params: ReportParams) -> DataFrame:
    if spec.years == "latest":
        df = df.where(F.col("financial_year") == params.latest_year)
    elif spec.years == "pandemic":
        df = df.where(not_in(F.col("financial_year"), params.pandemic_excluded_years))
    if spec.contractor_class is not None:
        df = df.where(F.col(CLASS) == spec.contractor_class)
    return df


def summary_table(spec: TableSpec, extracts: Extracts, params: ReportParams) -> DataFrame:
    """A table by its settings. Filters on keys reach the scan of the fact."""
    measures = spec.measures()
    grouped = (
        extracts(spec.grain, measures)
        .transform(_filters, spec, params)
        .groupBy(*spec.keys)
        .agg(*[_measure_sum(m) for m in measures])
    )
    return grouped.select(
        *spec.keys,
        *[RATIOS[c].column().alias(c) if c in RATIOS else F.col(c) for c in spec.columns],
    ).orderBy(*[F.col(k).asc_nulls_last() for k in spec.keys])


def table_1(extracts: Extracts) -> DataFrame:
    """Contractors of each class and together, by sums inside one group."""
    n = "num_contractors"
    return (
        extracts(NATIONAL, [n])
        .groupBy("financial_year")
        .agg(
            sum_strict_where(n, F.col(CLASS) == "N").alias("community_pharmacies"),
            sum_strict_where(n, F.col(CLASS) == "Y").alias("appliance_contractors"),
            sum_strict(n).alias("all_contractors"),
        )
        .orderBy(F.col("financial_year").asc_nulls_last())
    )


def band_totals(extracts: Extracts, prefix: str) -> DataFrame:
    """Band measures of pharmacies by year, one column per band label."""
    names = [f"{prefix}_{b}" for b in BAND_MEASURES]
    return (
        extracts(NATIONAL, names)
        .where(F.col(CLASS) == "N")
        .groupBy("financial_year")
        .agg(*[sum_strict(n).alias(label) for n, label in zip(names, BANDS)])
    )


def table_4(extracts: Extracts) -> DataFrame:
    """Pharmacies and items by dispensing band.

    Both measures of a band leave the wide row together, so the long forms need
    not be joined to each other again.
    """
    pairs = [
        F.struct(
            F.lit(label).alias("dispensing_volume_band"),
            F.col(f"band_items_{b}").alias("number_of_pharmacies"),
            F.col(f"vol_items_{b}").alias("number_of_items"),
        )
        for b, label in zip(BAND_MEASURES, BANDS)
    ]
    names = [f"{p}_{b}" for p in ("band_items", "vol_items") for b in BAND_MEASURES]
    wide = (
        extracts(NATIONAL, names)
        .where(F.col(CLASS) == "N")
        .groupBy("financial_year")
        .agg(*[sum_strict(n).alias(n) for n in names])
    )
    return wide.select("financial_year", F.inline(F.array(*pairs))).orderBy(
        F.col("financial_year").asc_nulls_last(),
        in_listed_order(F.col("dispensing_volume_band"), BANDS),
    )


def table(number: int, extracts: Extracts, params: ReportParams) -> DataFrame:
    """Tables 1 to 19 by number."""
    if number == 1:
        return table_1(extracts)
    if number == 4:
        return table_4(extracts)
    return summary_table(BY_NUMBER[number], extracts, params)

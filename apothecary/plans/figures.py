"""Figure datasets 1 to 19: long for plotting, wide and formatted for display."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apothecary.functions.aggregates import sum_strict
from apothecary.functions.formatting import thousands
from apothecary.functions.scalars import (
    labelled,
    month_start,
    not_in,
    r_round,
    safe_ratio,
    signif3,
)
from apothecary.operators.reshape import to_long
from apothecary.params import ReportParams
from apothecary.plans.extracts import MONTHLY, NATIONAL
from apothecary.plans.measures import BY_NAME
from apothecary.plans.tables import CLASS, Extracts
from apothecary.schemas import MONEY_TOTAL_TYPE


@dataclass(frozen=True)
class Series:
    """A plotted measure: its label in the long form, its column in the wide one."""

    measure: str
    label: str
    column: str


@dataclass(frozen=True)
class FigureSpec:
    number: int
    series: tuple[Series, ...]
    contractor_class: str | None = None
    years: str = "all"
    # Labels by class, for the long and the wide form. Without them the figure
    # has one row per period.
    long_classes: dict[str, str] | None = None
    wide_classes: dict[str, str] | None = None
    summed: bool = True
    round_long: bool = False
    round_wide: bool = False
    falling_order: bool = False
    monthly: bool = False

    @property
    def name(self) -> str:
        return f"figure_{self.number:02d}"

    @property
    def period(self) -> str:
        return "year_month" if self.monthly else "financial_year"

    @property
    def keys(self) -> list[str]:
        return [self.period, "contractor_type"] if self.long_classes else [self.period]


# Labels of figures, series and contractor classes.
CLASSES = {"Y": "Appliance contractors", "N": "Community pharmacies"}
SINGLE_CLASSES = {"Y": "Appliance contractor", "N": "Community pharmacy"}
HOME_REVIEWS = "Total Home Appliance Use Reviews (AUR)"
PREMISES_REVIEWS = "Total Premises Appliance Use Reviews (AUR)"
ALL_REVIEWS = "Total All Appliance Use Reviews (AUR)"
SPECS: tuple[FigureSpec, ...] = (
    FigureSpec(
        1,
        (Series("num_contractors", "Number of contractors", "number_of_contractors"),),
        long_classes=CLASSES, wide_classes=CLASSES, summed=False,
    ),
    FigureSpec(
        2,
        (Series("items_total", "Total items", "total_items"),),
        long_classes={
            "Y": "Total items - appliance contractors",
            "N": "Total items - community pharmacies",
        },
        wide_classes=CLASSES, summed=False,
    ),
    FigureSpec(
        3,
        (Series("average_items", "Average items", "average_items"),),
        long_classes=SINGLE_CLASSES, wide_classes=SINGLE_CLASSES, summed=False,
        round_long=True,
    ),
    FigureSpec(
        4,
        (
            Series("paper_items", "Items dispensed by paper prescription",
                   "paper_items_dispensed"),
            Series("eps_items_total_pharm", "Items dispensed by EPS", "eps_items_dispensed"),
            Series("items_total", "All items dispensed", "all_items_dispensed"),
        ),
        round_long=True,
    ),
    FigureSpec(
        5,
        (
            Series("costs_total", "Total reimbursement", "total_reimbursement"),
            Series("prof_fees_pharm", "Value of single activity fees",
                   "value_of_single_activity_fees"),
        ),
    ),
    FigureSpec(
        6,
        (Series("flu_items_total_csv", "Flu vaccines", "number_of_flu_vaccines"),),
        contractor_class="N",
    ),
    FigureSpec(
        7,
        (
            Series("flu_cost_total_csv", "Cost of vaccines", "cost_of_vaccines"),
            Series("flu_fees_total_csv", "Value of Fees received", "value_of_fees_received"),
        ),
        contractor_class="N",
    ),
    FigureSpec(
        8,
        (Series("num_nms_total",
                "Total New Medicine Services undertaken - community pharmacies",
                "new_medicine_services"),),
        contractor_class="N", summed=False,
    ),
    FigureSpec(
        9,
        (Series("num_nms_fee_total",
                "Total Cost of New Medicine Services undertaken - community pharmacies",
                "cost_of_new_medicine_services"),),
        contractor_class="N", summed=False,
    ),
    FigureSpec(
        10,
        (
            Series("num_aur_home_total_pharm", HOME_REVIEWS, "home_reviews"),
            Series("num_aur_prem_total_pharm", PREMISES_REVIEWS, "premises_reviews"),
            Series("num_aur_all_total_pharm", ALL_REVIEWS, "all_reviews"),
        ),
    ),
    FigureSpec(
        11,
        (
            Series("num_aur_home_total_fee_pharm", HOME_REVIEWS, "cost_of_home_reviews"),
            Series("num_aur_prem_total_fee_pharm", PREMISES_REVIEWS,
                   "cost_of_premises_reviews"),
            Series("num_aur_all_total_fee_pharm", ALL_REVIEWS, "cost_of_all_reviews"),
        ),
    ),
    FigureSpec(
        12,
        (Series("num_stoma_total_pharm", "Total Advance Services", "stoma_customisations"),),
        long_classes={
            "Y": "Total Stoma Appliance Customisation (SAC) provided by appliance contractors",
            "N": "Total Stoma Appliance Customisation (SAC) provided by community pharmacies",
        },
        wide_classes=CLASSES, summed=False,
    ),
    FigureSpec(
        13,
        (Series("num_stoma_total_fee_pharm", "Cost of Advance Services fees",
                "cost_of_stoma_customisations"),),
        long_classes={
            "Y": "Total Cost of Stoma Appliance Customisation (SAC) "
                 "provided by appliance contractors",
            "N": "Total Cost of Stoma Appliance Customisation (SAC) "
                 "provided by community pharmacies",
        },
        wide_classes=CLASSES, summed=False,
    ),
    FigureSpec(
        14,
        (Series("cpcs_fees_pharm", "Total Cost of Community Pharmacy Consultation Services",
                "cost_of_consultations"),),
        contractor_class="N", years="consultation", summed=False,
    ),
    FigureSpec(
        15,
        (Series("cpcs_drugs_pharm",
                "Total Cost of Drugs provided during Community Pharmacy Consultation Services",
                "cost_of_consultation_drugs"),),
        contractor_class="N", years="consultation", summed=False,
    ),
    FigureSpec(
        16,
        (
            Series("scs_cnslt", "Cost of Smoking Cessation Service (SCS) consultation fees",
                   "cost_of_consultation_fees"),
            Series("scs_nrtprod_cost",
                   "Cost of Nicotine Replacement Therapy (NRT) products provided during "
                   "SCS consultations", "cost_of_products"),
        ),
        years="smoking", falling_order=True,
    ),
    FigureSpec(
        17,
        (
            Series("t1c_prod_cost",
                   "Cost of oral contraception (OC) products provided during PCS "
                   "consultations", "cost_of_products"),
            Series("t1c_consult",
                   "Cost of Pharmacy Contraception Service (PCS) consultation fees",
                   "cost_of_consultation_fees"),
        ),
        years="contraception", falling_order=True, monthly=True,
    ),
    FigureSpec(
        18,
        (Series("cvd_19_vaccine", "Cost of vaccine fees", "cost_of_vaccine_fees"),),
        contractor_class="N", years="pandemic", round_long=True, round_wide=True,
        falling_order=True,
    ),
)
BY_NUMBER = {s.number: s for s in SPECS}

# Measures that are computed from those of an extract row.
DERIVED = {
    "average_items": ("items_total", "num_contractors"),
    "paper_items": ("items_total", "eps_items_total_pharm"),
}


def _derived(name: str) -> Column:
    a, b = (F.col(c) for c in DERIVED[name])
    return (safe_ratio(a, b) if name == "average_items" else a - b).alias(name)


def _years(df: DataFrame, years: str, params: ReportParams) -> DataFrame:
    year = F.col("year_month" if years == "contraception" else "financial_year")
    if years == "consultation":
        return df.where(not_in(year, params.consultation_excluded_years))
    if years == "pandemic":
        return df.where(not_in(year, params.pandemic_excluded_years))
    if years == "smoking":
        return df.where(year.isin(list(params.smoking_years)))
    if years == "contraception":
        return df.where(year > params.contraception_after_month)
    return df


def figure_values(
    spec: FigureSpec, extracts: Extracts, params: ReportParams, classes: dict[str, str] | None
) -> DataFrame:
    """One row per period, or period and class, with the measures as numbers."""
    measures = [s.measure for s in spec.series]
    sources: list[str] = []
    for m in measures:
        sources += [s for s in DERIVED.get(m, (m,)) if s not in sources]
    df = _years(extracts(MONTHLY if spec.monthly else NATIONAL, sources), spec.years, params)
    if spec.contractor_class is not None:
        df = df.where(F.col(CLASS) == spec.contractor_class)
    columns = [_derived(m) if m in DERIVED else F.col(m) for m in measures]
    if not spec.summed:
        kind = [labelled(F.col(CLASS), classes).alias("contractor_type")] if classes else []
        return df.select(spec.period, *kind, *columns)
    return (
        df.select(spec.period, *columns)
        .groupBy(spec.period)
        .agg(*[_total(m) for m in measures])
    )


def _total(name: str) -> Column:
    total = sum_strict(name)
    source = BY_NAME.get(name.removesuffix("_csv"))
    if source is not None and source.is_money:
        total = total.cast(MONEY_TOTAL_TYPE)
    return total.alias(name)


def figure_long(spec: FigureSpec, extracts: Extracts, params: ReportParams) -> DataFrame:
    """Rows of period, class where there is one, measure label and value."""
    values = figure_values(spec, extracts, params, spec.long_classes)
    long = to_long(values, spec.keys, [s.measure for s in spec.series])
    order = [F.col(k).asc_nulls_last() for k in spec.keys]
    if spec.falling_order:
        order = [F.col("measure").desc_nulls_last(), *order]
    long = long.orderBy(*order)
    value = F.col("value")
    return long.select(
        *_period_columns(spec),
        labelled(F.col("measure"), {s.measure: s.label for s in spec.series}).alias("measure"),
        (signif3(value) if spec.round_long else value).alias("value"),
    )


def _period_columns(spec: FigureSpec) -> list[Column]:
    if spec.monthly:
        return [month_start(F.col("year_month")).alias("year_month")]
    return [F.col(k) for k in spec.keys]


def figure_wide(spec: FigureSpec, extracts: Extracts, params: ReportParams) -> DataFrame:
    """The display table: one column of text per measure, named by measure."""
    if spec.number == 6:
        return flu_display(extracts)
    values = figure_values(spec, extracts, params, spec.wide_classes)
    columns = {s.measure: s.column for s in spec.series}
    if spec.number == 3:
        values = values.withColumn(
            "average_items", r_round(F.col("average_items"), 0).cast("bigint")
        )
    if spec.round_wide:
        values = values.withColumns({m: signif3(F.col(m)) for m in columns})
    values = values.select(
        *_period_columns(spec), *[F.col(m) for m in columns]
    )
    out = thousands(values, columns)
    return out.orderBy(*[F.col(k).asc_nulls_last() for k in spec.keys])


def flu_display(extracts: Extracts) -> DataFrame:
    """Flu vaccines of pharmacies and their mean per providing pharmacy.

    Both come from one aggregate of the same rows, so no join is needed.
    """
    items, providers = "flu_items_total_csv", "num_flu_pharm_csv"
    per_year = (
        extracts(NATIONAL, [items, providers])
        .where(F.col(CLASS) == "N")
        .groupBy("financial_year")
        .agg(sum_strict(items).alias(items), sum_strict(providers).alias(providers))
        .select(
            "financial_year",
            F.col(items).alias("vaccines"),
            r_round(safe_ratio(F.col(items), F.col(providers)), 0).cast("bigint").alias("mean"),
        )
    )
    return thousands(
        per_year, {"vaccines": "number_of_flu_vaccines", "mean": "average_per_pharmacy"}
    ).orderBy(F.col("financial_year").asc_nulls_last())


def fee_display(fees: DataFrame) -> DataFrame:
    """Figure 19: the fee schedule with dates in place of date text."""
    pattern = "dd MMM yyyy"
    return fees.select(
        F.col("fee_name"),
        F.col("fee_value_pence"),
        F.try_to_date("fee_start", pattern).alias("fee_start_date"),
        F.try_to_date("fee_end", pattern).alias("fee_end_date"),
    )

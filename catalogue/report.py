"""Extracts, summary tables and figures."""

from __future__ import annotations

from apothecary.plans import appeals, extracts, figures, tables
from catalogue.core import Inputs, query
from catalogue.sql import MONEY_MEASURES, NAMES, strict
from catalogue.table_columns import COLUMNS

# -- extracts -----------------------------------------------------------------

query("ext1_national", "SELECT * FROM national")(
    lambda s: extracts.national_extract(s.year_fact(), s.params)
)
query("ext2_monthly", "SELECT * FROM monthly")(
    lambda s: extracts.monthly_extract(s.month_fact(), s.params)
)
query("ext3_sub_national", "SELECT * FROM sub_national")(
    lambda s: extracts.sub_national_extract(s.year_fact(), s.params)
)
query(
    "agg14_both_grains",
    "SELECT 'sub_national' AS grain, * FROM sub_national UNION ALL BY NAME"
    " SELECT 'national' AS grain, * FROM national",
)(lambda s: extracts.both_grains(s.year_fact(), s.params, s.year_values()))

# -- tables -------------------------------------------------------------------

_RATIOS = {
    "electronic_share": "CAST(sum(eps_items_total_pharm) AS DOUBLE)"
    " / nullif(CAST(sum(items_total) AS DOUBLE), 0) * 100",
    "fees_per_pharmacy": "CAST(sum(prof_fees_total_pharm) AS DOUBLE)"
    " / nullif(CAST(sum(num_contractors) AS DOUBLE), 0)",
    "cost_per_fee": "round_even(CAST(sum(costs_total) AS DOUBLE)"
    " / nullif(CAST(sum(prof_fees_total_pharm) AS DOUBLE), 0), 2)",
    "items_per_pharmacy": "CAST(sum(items_total) AS DOUBLE)"
    " / nullif(CAST(sum(num_contractors) AS DOUBLE), 0)",
}
_EARLY = "('1994/1995', '1995/1996', '1996/1997', '1997/1998', '1998/1999')"
_CLASS_OF = {10: "Y", 11: "Y", 12: None, 13: None, 18: None, 19: None}
_REGIONS, _BOARDS = (14, 16, 18), (15, 17, 19)


def _table_sql(number: int) -> str:
    out = []
    for c in COLUMNS[number]:
        if c in _RATIOS:
            out.append(f"{_RATIOS[c]} AS {c}")
        elif c == "avg_monthly_items_pharm":
            out.append(f"max({c}) AS {c}")
        else:
            out.append(strict(c, c))
    keys, where, source = "financial_year", ["true"], "with_flu" if number == 6 else "national"
    if number in _REGIONS + _BOARDS:
        source = "sub_national"
        area = "region" if number in _REGIONS else "icb"
        keys += f", {area}_code, {area}_name"
        where.append("financial_year = '2001/2002'")
    contractor_class = _CLASS_OF.get(number, "N")
    if contractor_class:
        where.append(f"appliance_dispenser_hist = '{contractor_class}'")
    if number == 9:
        where.append(f"financial_year NOT IN {_EARLY}")
    return (
        f"SELECT {keys}, {', '.join(out)} FROM {source}"
        f" WHERE {' AND '.join(where)} GROUP BY {keys}"
    )


def _table(number: int):
    return lambda s: tables.table(number, s.extracts(), s.params)


query(
    "tab01_contractors",
    """SELECT financial_year,
    CAST(sum(CASE WHEN appliance_dispenser_hist = 'N' THEN num_contractors ELSE 0 END)
        AS BIGINT) AS community_pharmacies,
    CAST(sum(CASE WHEN appliance_dispenser_hist = 'Y' THEN num_contractors ELSE 0 END)
        AS BIGINT) AS appliance_contractors,
    CAST(sum(num_contractors) AS BIGINT) AS all_contractors
    FROM national GROUP BY financial_year""",
)(_table(1))

_BANDS = {
    "0_2000": "0 - 2000", "2001_4000": "2001 - 4000", "4001_6000": "4001 - 6000",
    "6001_8000": "6001 - 8000", "8001_10000": "8001 - 10000", "10000": "10000+",
}
query(
    "tab04_bands",
    " UNION ALL ".join(
        f"SELECT financial_year, '{label}' AS dispensing_volume_band,"
        f" band_items_{b} AS number_of_pharmacies, vol_items_{b} AS number_of_items"
        " FROM national WHERE appliance_dispenser_hist = 'N'"
        for b, label in _BANDS.items()
    ),
)(_table(4))

_TABLE_NAMES = {
    2: "attributes", 3: "activity", 5: "essential_fees", 6: "advanced_services",
    7: "reviews", 8: "consultations", 9: "pandemic", 10: "appliance_activity",
    11: "appliance_reviews", 12: "all_activity", 13: "all_reviews",
    14: "region_attributes", 15: "board_attributes", 16: "region_services",
    17: "board_services", 18: "region_reviews", 19: "board_reviews",
}
for _number, _name in _TABLE_NAMES.items():
    query(f"tab{_number:02d}_{_name}", _table_sql(_number))(_table(_number))

query(
    "tab20_appeals",
    """SELECT g.financial_year, g.locality, d.application_decision,
    coalesce(a.total_decisions, 0) AS total_decisions
    FROM (SELECT DISTINCT financial_year, locality FROM appeals) g
    CROSS JOIN (SELECT DISTINCT application_decision FROM appeals) d
    LEFT JOIN appeals a ON a.financial_year = g.financial_year AND a.locality = g.locality
    AND a.application_decision = d.application_decision""",
)(lambda s: appeals.table_20(s.appeals_history(), s.appeals_current()))

# -- figures ------------------------------------------------------------------


def signif3(x: str) -> str:
    e = f"(2 - floor(log10(abs({x}))))"
    return (
        f"CASE WHEN {x} = 0 THEN 0.0::DOUBLE WHEN {e} >= 0"
        f" THEN round_even({x} * pow(10.0, {e}), 0) / pow(10.0, {e})"
        f" ELSE round_even({x} / pow(10.0, -{e}), 0) * pow(10.0, -{e}) END"
    )


def amount_text(x: str, name: str) -> str:
    """Amounts with as many decimals, up to two, as the column needs."""
    v = f"CAST({x} AS DECIMAL(28,2))"
    need = (
        f"CASE WHEN abs({v}) < 100000 THEN CASE WHEN {v} % 1 = 0 THEN 0"
        f" WHEN ({v} * 10) % 1 = 0 THEN 1 ELSE 2 END"
        f" WHEN abs({v}) < 1000000 THEN CASE WHEN round_even({v}, 1) % 1 = 0 THEN 0 ELSE 1 END"
        " ELSE 0 END"
    )
    shown = f"max({need}) OVER ()"
    d = f"CAST({v} AS DOUBLE)"
    return (
        f"CASE {shown} WHEN 0 THEN format('{{:,.0f}}', {d})"
        f" WHEN 1 THEN format('{{:,.1f}}', {d}) ELSE format('{{:,.2f}}', {d}) END AS {name}"
    )


def _text(measure: str, name: str) -> str:
    if measure.removesuffix("_csv") in MONEY_MEASURES:
        return amount_text(measure, name)
    return f"format('{{:,}}', {measure}) AS {name}"


def _label(labels: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    return f"CASE appliance_dispenser_hist {cases} END"


_BOTH = {"Y": "Appliance contractors", "N": "Community pharmacies"}
_SAC = "Stoma Appliance Customisation (SAC) provided by"
_AUR = {
    "home": "Total Home Appliance Use Reviews (AUR)",
    "prem": "Total Premises Appliance Use Reviews (AUR)",
    "all": "Total All Appliance Use Reviews (AUR)",
}
# Figures with one row per class: measure, label, wide column, class labels.
_BY_CLASS = {
    1: ("num_contractors", "Number of contractors", "number_of_contractors", _BOTH, _BOTH),
    2: ("items_total", "Total items", "total_items",
        {"Y": "Total items - appliance contractors",
         "N": "Total items - community pharmacies"}, _BOTH),
    12: ("num_stoma_total_pharm", "Total Advance Services", "stoma_customisations",
         {"Y": f"Total {_SAC} appliance contractors",
          "N": f"Total {_SAC} community pharmacies"}, _BOTH),
    13: ("num_stoma_total_fee_pharm", "Cost of Advance Services fees",
         "cost_of_stoma_customisations",
         {"Y": f"Total Cost of {_SAC} appliance contractors",
          "N": f"Total Cost of {_SAC} community pharmacies"}, _BOTH),
}
_N = "appliance_dispenser_hist = 'N'"
_FOUR = "('1994/1995', '1995/1996', '1996/1997', '1997/1998')"
# Figures with one row per year: source, filter, (measure, label, wide column).
_BY_YEAR = {
    5: ("national", "true", (
        ("costs_total", "Total reimbursement", "total_reimbursement"),
        ("prof_fees_pharm", "Value of single activity fees", "value_of_single_activity_fees"),
    )),
    7: ("with_flu", _N, (
        ("flu_cost_total_csv", "Cost of vaccines", "cost_of_vaccines"),
        ("flu_fees_total_csv", "Value of Fees received", "value_of_fees_received"),
    )),
    8: ("national", _N, (
        ("num_nms_total", "Total New Medicine Services undertaken - community pharmacies",
         "new_medicine_services"),
    )),
    9: ("national", _N, (
        ("num_nms_fee_total",
         "Total Cost of New Medicine Services undertaken - community pharmacies",
         "cost_of_new_medicine_services"),
    )),
    10: ("national", "true", (
        ("num_aur_home_total_pharm", _AUR["home"], "home_reviews"),
        ("num_aur_prem_total_pharm", _AUR["prem"], "premises_reviews"),
        ("num_aur_all_total_pharm", _AUR["all"], "all_reviews"),
    )),
    11: ("national", "true", (
        ("num_aur_home_total_fee_pharm", _AUR["home"], "cost_of_home_reviews"),
        ("num_aur_prem_total_fee_pharm", _AUR["prem"], "cost_of_premises_reviews"),
        ("num_aur_all_total_fee_pharm", _AUR["all"], "cost_of_all_reviews"),
    )),
    14: ("national", f"{_N} AND financial_year NOT IN {_FOUR}", (
        ("cpcs_fees_pharm", "Total Cost of Community Pharmacy Consultation Services",
         "cost_of_consultations"),
    )),
    15: ("national", f"{_N} AND financial_year NOT IN {_FOUR}", (
        ("cpcs_drugs_pharm",
         "Total Cost of Drugs provided during Community Pharmacy Consultation Services",
         "cost_of_consultation_drugs"),
    )),
    16: ("national", "financial_year IN ('2000/2001', '2001/2002')", (
        ("scs_cnslt", "Cost of Smoking Cessation Service (SCS) consultation fees",
         "cost_of_consultation_fees"),
        ("scs_nrtprod_cost", "Cost of Nicotine Replacement Therapy (NRT) products provided"
         " during SCS consultations", "cost_of_products"),
    )),
    17: ("monthly", "year_month > 200103", (
        ("t1c_consult", "Cost of Pharmacy Contraception Service (PCS) consultation fees",
         "cost_of_consultation_fees"),
        ("t1c_prod_cost", "Cost of oral contraception (OC) products provided during PCS"
         " consultations", "cost_of_products"),
    )),
}


def _long(number: int):
    def build(s: Inputs):
        source = s.monthly_extracts() if number == 17 else s.extracts()
        return figures.figure_long(figures.BY_NUMBER[number], source, s.params)

    return build


def _wide(number: int):
    def build(s: Inputs):
        source = s.monthly_extracts() if number == 17 else s.extracts()
        return figures.figure_wide(figures.BY_NUMBER[number], source, s.params)

    return build


for _number, (_m, _l, _c, _long_labels, _wide_labels) in _BY_CLASS.items():
    query(
        f"fig{_number:02d}_long",
        f"SELECT financial_year, {_label(_long_labels)} AS contractor_type,"
        f" '{_l}' AS measure, {_m} AS value FROM national",
    )(_long(_number))
    query(
        f"fig{_number:02d}_wide",
        f"SELECT financial_year, {_label(_wide_labels)} AS contractor_type,"
        f" {_text(_m, _c)} FROM national",
    )(_wide(_number))

for _number, (_source, _where, _series) in _BY_YEAR.items():
    _key = "year_month" if _number == 17 else "financial_year"
    _shown = "make_date(year_month // 100, year_month % 100, 1) AS year_month"
    _shown = _shown if _number == 17 else _key
    _sums = ", ".join(strict(m, m) for m, _, _ in _series)
    _grouped = f"(SELECT {_key}, {_sums} FROM {_source} WHERE {_where} GROUP BY {_key})"
    query(
        f"fig{_number:02d}_long",
        " UNION ALL ".join(
            f"SELECT {_shown}, '{label}' AS measure, {m} AS value FROM {_grouped}"
            for m, label, _ in _series
        ),
    )(_long(_number))
    query(
        f"fig{_number:02d}_wide",
        f"SELECT {_shown}, {', '.join(_text(m, c) for m, _, c in _series)} FROM {_grouped}",
    )(_wide(_number))

_ONE = {"Y": "Appliance contractor", "N": "Community pharmacy"}
_MEAN = "(CAST(items_total AS DOUBLE) / num_contractors)"
query(
    "fig03_long",
    f"SELECT financial_year, {_label(_ONE)} AS contractor_type, 'Average items' AS measure,"
    f" {signif3(_MEAN)} AS value FROM national",
)(_long(3))
query(
    "fig03_wide",
    f"SELECT financial_year, {_label(_ONE)} AS contractor_type,"
    f" format('{{:,}}', CAST(round_even({_MEAN}, 0) AS BIGINT)) AS average_items FROM national",
)(_wide(3))

_EPS = """(SELECT financial_year, CAST(sum(items_total - eps_items_total_pharm) AS BIGINT)
    AS paper, CAST(sum(eps_items_total_pharm) AS BIGINT) AS eps,
    CAST(sum(items_total) AS BIGINT) AS items FROM national GROUP BY financial_year)"""
query(
    "fig04_long",
    " UNION ALL ".join(
        f"SELECT financial_year, '{label}' AS measure, {signif3(f'CAST({c} AS DOUBLE)')}"
        f" AS value FROM {_EPS}"
        for c, label in (
            ("paper", "Items dispensed by paper prescription"),
            ("eps", "Items dispensed by EPS"),
            ("items", "All items dispensed"),
        )
    ),
)(_long(4))
query(
    "fig04_wide",
    "SELECT financial_year, format('{:,}', paper) AS paper_items_dispensed,"
    " format('{:,}', eps) AS eps_items_dispensed, format('{:,}', items)"
    f" AS all_items_dispensed FROM {_EPS}",
)(_wide(4))

_FLU_SUMS = (
    f"(SELECT financial_year, {strict('flu_items_total_csv', 'items')},"
    f" {strict('num_flu_pharm_csv', 'providers')} FROM with_flu"
    f" WHERE {_N} GROUP BY financial_year)"
)
query(
    "fig06_long",
    "SELECT financial_year, 'Flu vaccines' AS measure, items AS value FROM " + _FLU_SUMS,
)(_long(6))
query(
    "fig06_wide",
    "SELECT financial_year, format('{:,}', items) AS number_of_flu_vaccines,"
    " format('{:,}', CAST(round_even(CAST(items AS DOUBLE) / nullif(providers, 0), 0)"
    f" AS BIGINT)) AS average_per_pharmacy FROM {_FLU_SUMS}",
)(_wide(6))

_VACCINES = (
    f"(SELECT financial_year, {signif3('CAST(v AS DOUBLE)')} AS v FROM (SELECT"
    f" financial_year, sum(cvd_19_vaccine) AS v FROM national WHERE {_N}"
    f" AND financial_year NOT IN {_EARLY} GROUP BY financial_year))"
)
query(
    "fig18_long",
    f"SELECT financial_year, 'Cost of vaccine fees' AS measure, v AS value FROM {_VACCINES}",
)(_long(18))
query(
    "fig18_wide",
    f"SELECT financial_year, {amount_text('v', 'cost_of_vaccine_fees')} FROM {_VACCINES}",
)(_wide(18))

assert len(NAMES) == 118

"""The 118 measures of an extract, as one ordered list."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from apothecary.schemas import MONEY, MONEY_TOTAL_TYPE


@dataclass(frozen=True)
class Measure:
    """``kind`` says how ``source`` is reduced, ``test`` which rows count."""

    name: str
    kind: str
    source: str = ""
    test: tuple[str, str, str] | None = None

    def column(self) -> Column:
        """The aggregate. One expression text each: a wide extract is then
        handed to Spark in about a hundred calls rather than many hundreds."""
        condition = " {} ".format(self.test[1]).join(self.test[::2]) if self.test else ""
        if self.kind == "rows":
            text = "count(1)"
        elif self.kind == "count_if":
            text = f"count_if({condition})"
        else:
            text = f"coalesce(sum({self.source}){_where(condition)}, 0)"
        if self.is_money:
            text = f"cast({text} AS {MONEY_TOTAL_TYPE.simpleString()})"
        return F.expr(f"{text} AS {self.name}")

    @property
    def title(self) -> str:
        tested = f" where {' '.join(self.test)}" if self.test else ""
        if self.kind in ("rows", "count_if"):
            return f"Contractors{tested}"
        return f"{'Median' if self.kind == 'median' else 'Total'} of {self.source}{tested}"

    @property
    def is_money(self) -> bool:
        return self.kind == "total" and (self.source in MONEY or self.source == "AUR_ALL")


def _where(condition: str) -> str:
    return f" FILTER (WHERE {condition})" if condition else ""


def rows(name: str) -> Measure:
    return Measure(name, "rows")


def total(name: str, source: str) -> Measure:
    return Measure(name, "total", source)


def total_where(name: str, source: str, column: str, value: str) -> Measure:
    return Measure(name, "total", source, (column, "=", f"'{value}'"))


def matching(name: str, column: str, value: str) -> Measure:
    return Measure(name, "count_if", test=(column, "=", f"'{value}'"))


def providers(name: str, column: str) -> Measure:
    """Contractors with anything in a column."""
    return Measure(name, "count_if", test=(column, ">", "0"))


def dated(name: str, column: str, op: str, bound: str) -> Measure:
    return Measure(name, "count_if", test=(column, op, bound))


def middle(name: str, source: str) -> Measure:
    """Median. Not a sum, so ``plans.extracts`` computes it apart."""
    return Measure(name, "median", source)


# Measure names, the fact column each reads, and its rule.
MEASURES: tuple[Measure, ...] = (
    rows("num_contractors"),
    total("items_total", "ITEMS"),
    total("costs_total", "NIC"),
    total("prof_fees_total_pharm", "NUM_PROF_FEES"),
    total("prof_fees_pharm", "PROF_FEES"),
    middle("avg_monthly_items_pharm", "AVG_MONTHLY_ITEMS"),
    matching("band_items_0_2000", "MONTHLY_DISP_VOL_BAND", "0 - 2000"),
    matching("band_items_2001_4000", "MONTHLY_DISP_VOL_BAND", "2001 - 4000"),
    matching("band_items_4001_6000", "MONTHLY_DISP_VOL_BAND", "4001 - 6000"),
    matching("band_items_6001_8000", "MONTHLY_DISP_VOL_BAND", "6001 - 8000"),
    matching("band_items_8001_10000", "MONTHLY_DISP_VOL_BAND", "8001 - 10000"),
    matching("band_items_10000", "MONTHLY_DISP_VOL_BAND", "10000+"),
    total_where("vol_items_0_2000", "ITEMS", "MONTHLY_DISP_VOL_BAND", "0 - 2000"),
    total_where("vol_items_2001_4000", "ITEMS", "MONTHLY_DISP_VOL_BAND", "2001 - 4000"),
    total_where("vol_items_4001_6000", "ITEMS", "MONTHLY_DISP_VOL_BAND", "4001 - 6000"),
    total_where("vol_items_6001_8000", "ITEMS", "MONTHLY_DISP_VOL_BAND", "6001 - 8000"),
    total_where("vol_items_8001_10000", "ITEMS", "MONTHLY_DISP_VOL_BAND", "8001 - 10000"),
    total_where("vol_items_10000", "ITEMS", "MONTHLY_DISP_VOL_BAND", "10000+"),
    matching("num_ind_pharm", "CONTRACTOR_TYPE", "Independent"),
    matching("num_multi_pharm", "CONTRACTOR_TYPE", "Multiple contractor"),
    matching("num_dist_selling_pharm", "DIST_SELLING_DISPENSER_HIST", "Y"),
    dated("num_open_pharm", "START_DATE_HIST", ">=", "first_day"),
    dated("num_close_pharm", "CLOSE_DATE_HIST", "<=", "last_day"),
    matching("num_lps_pharm", "LPS_DISPENSER_HIST", "Y"),
    providers("num_mur_pharm", "NUM_MUR"),
    total("num_mur_total", "NUM_MUR"),
    total("num_mur_fee_total", "MUR_FEES"),
    providers("num_nms_pharm", "NUM_NMS"),
    total("num_nms_total", "NUM_NMS"),
    total("num_nms_fee_total", "NMS_FEES"),
    providers("num_aur_home_pharm", "NUM_AUR_HOME"),
    providers("num_aur_prem_pharm", "NUM_AUR_PREM"),
    providers("num_aur_all_pharm", "NUM_AUR_ALL"),
    total("num_aur_home_total_pharm", "NUM_AUR_HOME"),
    total("num_aur_prem_total_pharm", "NUM_AUR_PREM"),
    total("num_aur_all_total_pharm", "NUM_AUR_ALL"),
    total("num_aur_home_total_fee_pharm", "AUR_HOME"),
    total("num_aur_prem_total_fee_pharm", "AUR_PREM"),
    total("num_aur_all_total_fee_pharm", "AUR_ALL"),
    providers("num_stoma_pharm", "NUM_CUSTOM_STOMA_FEES"),
    total("num_stoma_total_pharm", "NUM_CUSTOM_STOMA_FEES"),
    total("num_stoma_total_fee_pharm", "CUSTOM_STOMA_FEES"),
    providers("num_home_del", "NUM_HOME_DEL"),
    total("num_home_del_total", "NUM_HOME_DEL"),
    total("home_del_cost_total", "HOME_DEL_COST"),
    providers("num_flu_pharm", "FLU_ITEMS"),
    total("flu_items_total", "FLU_ITEMS"),
    total("flu_cost_total", "FLU_COST"),
    total("flu_fees_total", "FLU_FEES"),
    providers("num_eps_pharm", "EPS_ITEMS"),
    total("eps_items_total_pharm", "EPS_ITEMS"),
    providers("num_cd_fee", "CD_FEE"),
    total("cd_fee", "CD_FEE"),
    providers("num_cd_sched2_fee", "CD_SCHED2_FEE"),
    total("cd_sched2_fee", "CD_SCHED2_FEE"),
    providers("num_cd_sched3_fee", "CD_SCHED3_FEE"),
    total("cd_sched3_fee", "CD_SCHED3_FEE"),
    providers("num_add_fee_2a", "ADD_FEE_2A"),
    total("add_fee_2a", "ADD_FEE_2A"),
    providers("num_add_fee_mf_pharm", "ADD_FEE_MF"),
    total("add_fee_mf_pharm", "ADD_FEE_MF"),
    providers("num_expensive_fees_pharm", "EXPENSIVE_FEE"),
    total("no_expensive_fees_pharm", "NO_EXPENSIVE_FEES"),
    total("expensive_fee_pharm", "EXPENSIVE_FEE"),
    providers("num_oope_item_count_pharm", "OOPE_ITEM_COUNT"),
    total("oope_item_count_pharm", "OOPE_ITEM_COUNT"),
    total("oope_val_pharm", "OOPE_VAL"),
    providers("num_ums_drugs_pharm", "UMS_DRUGS"),
    total("ums_fees_pharm", "UMS_FEES"),
    total("ums_drugs_pharm", "UMS_DRUGS"),
    providers("num_cpcs_drugs_pharm", "CPCS_FEES"),
    total("cpcs_fees_pharm", "CPCS_FEES"),
    total("cpcs_drugs_pharm", "CPCS_DRUGS"),
    providers("num_hep_c_service_pharm", "HEP_C_SERVICE"),
    total("hep_c_kit_pharm", "HEP_C_KIT"),
    total("hep_c_service_pharm", "HEP_C_SERVICE"),
    providers("num_hypten_inc", "HYPTENCHECK_FEES"),
    total("hyptencheck_fees", "HYPTENCHECK_FEES"),
    total("hyptenset_fees", "HYPTENSET_FEES"),
    total("hypten_inc", "HYPTEN_INC"),
    providers("num_scs_cnslt", "SCS_CNSLT"),
    total("scs_cnslt", "SCS_CNSLT"),
    total("scs_nrtprod_charge", "SCS_NRTPROD_CHARGE"),
    total("scs_nrtprod_cost", "SCS_NRTPROD_COST"),
    total("scs_setup", "SCS_SETUP"),
    providers("num_ssp_fees", "SSP_FEES"),
    total("ssp_fees", "SSP_FEES"),
    providers("num_gprefpath_fees", "GPREFPATH_FEES"),
    total("gprefpath_fees", "GPREFPATH_FEES"),
    providers("num_cvdtestreg_fees", "CVDTESTREG_FEES"),
    total("cvdtestreg_fees", "CVDTESTREG_FEES"),
    providers("num_cvdtestset_fees", "CVDTESTSET_FEES"),
    total("cvdtestset_fees", "CVDTESTSET_FEES"),
    providers("num_cvdtest_kits", "CVDTEST_KITS"),
    total("cvdtest_kits", "CVDTEST_KITS"),
    providers("num_cvd_19_costs", "CVD_19_COSTS"),
    total("cvd_19_costs", "CVD_19_COSTS"),
    providers("num_cvd_19_vaccine", "CVD_19_VACCINE"),
    total("cvd_19_vaccine", "CVD_19_VACCINE"),
    providers("num_cvd_prem_refrid", "CVD_PREM_REFRID"),
    total("cvd_prem_refrid", "CVD_PREM_REFRID"),
    providers("num_discharge_meds", "DISCHARGE_MEDS"),
    total("discharge_meds", "DISCHARGE_MEDS"),
    providers("num_ppe_claims", "PPE_CLAIMS"),
    total("ppe_claims", "PPE_CLAIMS"),
    providers("num_t1c_cnslt", "T1C_CONSULT"),
    total("t1c_set_up", "T1C_SET_UP"),
    total("t1c_prod_cost", "T1C_PROD_COST"),
    total("t1c_consult", "T1C_CONSULT"),
    providers("num_pfcp_payment", "PFCP_PAYMENT"),
    total("pfcp_optin", "PFCP_OPTIN"),
    total("pfcp_fees", "PFCP_FEES"),
    total("pfcp_payment", "PFCP_PAYMENT"),
    total("pfcp_months", "PFCP_MONTHS"),
    total("pfcp_vat", "PFCP_VAT"),
    total("pfcp_umsmideduct", "PFCP_UMSMIDEDUCT"),
    total("pfcp_umsmiremuneration", "PFCP_UMSMIREMUNERATION"),
    total("pfcp_umsmireimbursement", "PFCP_UMSMIREIMBURSEMENT"),)

BY_NAME = {m.name: m for m in MEASURES}
MEDIAN = BY_NAME["avg_monthly_items_pharm"]

# The monthly extract counts consultation providers on drug cost, not on fees.
MONTHLY_OVERRIDES = {
    "num_cpcs_drugs_pharm": providers("num_cpcs_drugs_pharm", "CPCS_DRUGS"),
}

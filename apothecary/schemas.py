"""Declared schemas. Readers use these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Volume and money columns of the contractor fact.
VOLUMES = (
    "ITEMS", "EPS_ITEMS", "FLU_ITEMS", "NUM_MUR", "NUM_NMS", "NUM_AUR_HOME",
    "NUM_AUR_PREM", "NUM_CUSTOM_STOMA_FEES", "NUM_HOME_DEL", "NUM_PROF_FEES",
    "NO_EXPENSIVE_FEES", "OOPE_ITEM_COUNT", "PFCP_MONTHS",
)
MONEY = (
    "NIC", "PROF_FEES", "MUR_FEES", "NMS_FEES", "AUR_HOME", "AUR_PREM",
    "CUSTOM_STOMA_FEES", "HOME_DEL_COST", "FLU_COST", "FLU_FEES", "CD_FEE",
    "CD_SCHED2_FEE", "CD_SCHED3_FEE", "ADD_FEE_2A", "ADD_FEE_MF",
    "EXPENSIVE_FEE", "OOPE_VAL", "UMS_FEES", "UMS_DRUGS", "CPCS_FEES",
    "CPCS_DRUGS", "HEP_C_KIT", "HEP_C_SERVICE", "HYPTENCHECK_FEES",
    "HYPTENSET_FEES", "HYPTEN_INC", "SCS_CNSLT", "SCS_NRTPROD_CHARGE",
    "SCS_NRTPROD_COST", "SCS_SETUP", "SSP_FEES", "GPREFPATH_FEES",
    "CVDTESTREG_FEES", "CVDTESTSET_FEES", "CVDTEST_KITS", "CVD_19_COSTS",
    "CVD_19_VACCINE", "CVD_PREM_REFRID", "DISCHARGE_MEDS", "PPE_CLAIMS",
    "T1C_CONSULT", "T1C_SET_UP", "T1C_PROD_COST", "PFCP_OPTIN", "PFCP_FEES",
    "PFCP_PAYMENT", "PFCP_VAT", "PFCP_UMSMIDEDUCT", "PFCP_UMSMIREMUNERATION",
    "PFCP_UMSMIREIMBURSEMENT",
)
GEOGRAPHY = ("ICB_CODE", "ICB_NAME", "REGION_CODE", "REGION_NAME")
CLASS = "APPLIANCE_DISPENSER_HIST"

MONEY_TYPE = T.DecimalType(18, 2)
# Totals of money keep this type through every further sum.
MONEY_TOTAL_TYPE = T.DecimalType(28, 2)


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _fact(period: list[T.StructField]) -> T.StructType:
    return T.StructType(
        [T.StructField("CONTRACTOR_ID", T.LongType(), False)]
        + period
        + _text(CLASS, *GEOGRAPHY, "CONTRACTOR_TYPE", "DIST_SELLING_DISPENSER_HIST",
                "LPS_DISPENSER_HIST", "MONTHLY_DISP_VOL_BAND", "START_DATE_HIST",
                "CLOSE_DATE_HIST")
        + [T.StructField("AVG_MONTHLY_ITEMS", T.DoubleType())]
        + [T.StructField(n, T.LongType()) for n in VOLUMES]
        + [T.StructField(n, MONEY_TYPE) for n in MONEY]
    )


YEAR_FACT = _fact(_text("FINANCIAL_YEAR"))
# A month row also names its financial year, by which the table is partitioned.
MONTH_FACT = _fact([T.StructField("YEAR_MONTH", T.IntegerType())] + _text("FINANCIAL_YEAR"))

# Claims added up by contractor and month, before attributes are joined; amounts
# in pence.
ACTIVITY = T.StructType(
    [T.StructField("CONTRACTOR_ID", T.LongType(), False)]
    + _text("FINANCIAL_YEAR")
    + [T.StructField("YEAR_MONTH", T.IntegerType()), T.StructField("MONTHS_ACTIVE", T.LongType())]
    + [T.StructField(n, T.LongType()) for n in VOLUMES]
    + [T.StructField(n, T.LongType()) for n in MONEY]
)

# How often the median's column has each value, by class and area; written beside the year fact.
YEAR_VALUES = T.StructType(
    _text("FINANCIAL_YEAR", CLASS, *GEOGRAPHY)
    + [T.StructField("bucket", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("rows", T.LongType())]
)

# Contractors with the attributes they hold.
CONTRACTORS = T.StructType(
    [T.StructField("CONTRACTOR_ID", T.LongType(), False)]
    + _text("OWNER_ID", CLASS, *GEOGRAPHY, "DIST_SELLING_DISPENSER_HIST",
            "LPS_DISPENSER_HIST", "START_DATE_HIST", "CLOSE_DATE_HIST")
)

# A claim line: what it adds to each fact column; money in pence.
CLAIMS = T.StructType(
    [T.StructField("CONTRACTOR_ID", T.LongType(), False), T.StructField("CLAIM_DATE", T.DateType())]
    + [T.StructField(n, T.LongType()) for n in (*VOLUMES, *MONEY)]
)
# A change of attributes: what a contractor holds from a day on.
ATTRIBUTE_HISTORY = T.StructType(
    [
        T.StructField("CONTRACTOR_ID", T.LongType(), False),
        T.StructField("EFFECTIVE_DATE", T.DateType()),
        T.StructField("SEQUENCE", T.LongType()),
    ]
    + _text("OWNER_ID", CLASS, *GEOGRAPHY, "DIST_SELLING_DISPENSER_HIST", "LPS_DISPENSER_HIST")
)

FLU = T.StructType(
    _text("FINANCIAL_YEAR", CLASS)
    + [
        T.StructField("num_flu_pharm", T.LongType()),
        T.StructField("flu_items_total", T.LongType()),
        T.StructField("flu_cost_total", MONEY_TYPE),
        T.StructField("flu_fees_total", MONEY_TYPE),
    ]
)
APPEALS_HISTORY = T.StructType(
    _text("financial_year", "locality", "application_decision")
    + [T.StructField("total_decisions", T.LongType())]
)
APPEALS_CURRENT = T.StructType(
    _text("financial_year", "locality", "application_decision")
    + [T.StructField("number", T.LongType())]
)
FEE_SCHEDULE = T.StructType(
    _text("fee_name")
    + [T.StructField("fee_value_pence", T.IntegerType())]
    + _text("fee_start", "fee_end")
)


def require(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` cut to the schema's columns and types; fails on a missing one."""
    have = {c.lower() for c in df.columns}
    missing = [n for n in schema.fieldNames() if n.lower() not in have]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.selectExpr(
        *[f"cast({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields]
    )

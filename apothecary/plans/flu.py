"""Flu measures taken from a reference file instead of the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apothecary.params import ReportParams

FLU_MEASURES = ("num_flu_pharm", "flu_items_total", "flu_cost_total", "flu_fees_total")
KEYS = ("financial_year", "appliance_dispenser_hist")


def with_flu_reference(
    national: DataFrame, flu: DataFrame, params: ReportParams
) -> DataFrame:
    """National extract left-joined to the flu reference.

    Clashing measures get the suffixes ``_dwh`` and ``_csv``; the plain names
    then hold the reference value, NULL for years it lacks. NULL keys match
    each other. The reference is a small file, which Spark broadcasts by its
    size.
    """
    measures = [m for m in FLU_MEASURES if m in national.columns]
    left = national.withColumnsRenamed({m: m + "_dwh" for m in measures})
    right = flu.select(
        *[F.col(k).alias(k + "_r") for k in KEYS],
        *[
            F.col(m).cast(national.schema[m].dataType).alias(m + "_csv") for m in measures
        ],
    )
    same = left[KEYS[0]].eqNullSafe(right[KEYS[0] + "_r"]) & left[KEYS[1]].eqNullSafe(
        right[KEYS[1] + "_r"]
    )
    joined = left.join(right, same, "left").drop(*[k + "_r" for k in KEYS])

    def final(m: str):
        if params.flu_falls_back_to_warehouse:
            return F.coalesce(m + "_csv", m + "_dwh")
        return F.col(m + "_csv")

    return joined.withColumns({m: final(m) for m in measures})

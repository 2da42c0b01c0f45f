"""Settings of one publication run."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dispensing volume bands, in report order.
BANDS = (
    "0 - 2000",
    "2001 - 4000",
    "4001 - 6000",
    "6001 - 8000",
    "8001 - 10000",
    "10000+",
)

# Localities and appeal decisions, in report order.
LOCALITIES = ("Controlled", "Non-Controlled", "Total")
GRANTED = "Application granted"
REFUSED = "Application refused"
DECISIONS = (
    GRANTED,
    REFUSED,
    "Appeal withdrawn - application granted",
    "Appeal withdrawn - application refused",
    "Remit back to NHSE",
)


@dataclass(frozen=True)
class ReportParams:
    """Year lists and switches; the defaults are those of the 2023/24 report."""

    latest_year: str = "2023/2024"
    pandemic_excluded_years: tuple[str, ...] = (
        "2015/2016",
        "2016/2017",
        "2017/2018",
        "2018/2019",
        "2019/2020",
    )
    consultation_excluded_years: tuple[str, ...] = (
        "2015/2016",
        "2016/2017",
        "2017/2018",
        "2018/2019",
    )
    smoking_years: tuple[str, ...] = ("2022/2023", "2023/2024")
    contraception_after_month: int = 202303
    band_upper_bounds: tuple[int, ...] = (2000, 4000, 6000, 8000, 10000)
    multiple_owner_size: int = 6
    # Month rows take their year bounds from the calendar year of the month.
    # True switches to the financial year the month belongs to.
    month_uses_financial_year: bool = False
    # Years missing from the flu reference stay NULL. True falls back to the
    # value of the warehouse.
    flu_falls_back_to_warehouse: bool = False
    # Rank accuracy of the bracket around the exact median (1 / this share).
    median_bracket_accuracy: int = 2_000

    def for_latest_year_of(self, fact: DataFrame) -> ReportParams:
        """The same settings with the latest year read from the fact."""
        latest = fact.agg(F.max("FINANCIAL_YEAR")).first()[0]
        return replace(self, latest_year=latest)

"""Headline queries, timed. Prints one line of JSON.

``month_sums`` scans the claims; ``facts_written`` is the whole build of the
stored facts from claims. The other queries read the stored facts, as reports
do, and are timed from call to last row.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from apothecary.operators import fact
from apothecary.session import forget_written
from catalogue import QUERIES
from catalogue.core import Inputs

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
NAMES = (
    "ext1_national", "ext2_monthly", "ext3_sub_national", "agg14_both_grains",
    "tab01_contractors", "tab03_activity", "tab04_bands", "tab05_essential_fees",
    "tab06_advanced_services", "tab12_all_activity", "tab15_board_attributes",
    "tab17_board_services", "tab19_board_reviews", "tab20_appeals",
    "fig04_long", "fig04_wide", "fig17_wide",
    "agg05_median", "fct6_year_end_state", "fct7_owner_type", "fct8_service_use",
    "fct9_distinct_providers", "win7_rising_run", "chk1_duplicates", "chk2_differences",
)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("apothecary-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "20g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    inputs = Inputs(spark, FOLDER)
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 3)

    timed("facts_written", lambda: (inputs.year_fact(), inputs.month_fact()))
    months = fact.contractor_months(inputs.claims())
    timed("month_sums", lambda: months.write.format("noop").mode("overwrite").save())
    for name in NAMES:
        timed(name, lambda name=name: QUERIES[name](inputs).collect())
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    forget_written(spark)
    spark.stop()


if __name__ == "__main__":
    main()

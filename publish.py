"""The publication as a job: facts and reference files in, a version with tables and figures out.

Lines of the reference files that are no rows are left out and told in ``out/rejects``.

    spark-submit publish.py --years … --months … --flu … --appeals-history …
        --appeals-current … --out … [--values …] [--latest-year 2023/2024]
        [--jdbc-url … --jdbc-property user=… --jdbc-property driver=…]
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from apothecary.params import ReportParams
from apothecary.plans.publication import Publication
from apothecary.schemas import MONTH_FACT, YEAR_FACT, YEAR_VALUES
from apothecary.session import configure
from apothecary.sinks.files import write_csv
from apothecary.sources.reference import (
    checked_appeals_current,
    checked_appeals_history,
    checked_flu,
)
from apothecary.sources.warehouse import JdbcTable, read_fact


def arguments(words: Sequence[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Write all tables and figures.")
    parser.add_argument("--years", required=True, help="contractor-year fact, Parquet or table")
    parser.add_argument("--months", required=True, help="contractor-month fact, Parquet or table")
    parser.add_argument("--values", help="counts written beside the year fact, Parquet")
    parser.add_argument("--flu", required=True, help="folder with the flu reference CSV")
    parser.add_argument("--appeals-history", required=True, help="earlier decisions, CSV")
    parser.add_argument("--appeals-current", required=True, help="this year's decisions, CSV")
    parser.add_argument("--out", required=True, help="output folder")
    parser.add_argument("--latest-year", help="default: the last year of the fact")
    parser.add_argument("--jdbc-url", help="read --years and --months as tables of this database")
    parser.add_argument("--jdbc-property", action="append", default=[], help="key=value, repeatable")
    return parser.parse_args(words)


def database(args: argparse.Namespace, table: str) -> JdbcTable:
    """A fact's table in the database the arguments name."""
    properties = dict(p.split("=", 1) for p in args.jdbc_property)
    return JdbcTable(args.jdbc_url, table, properties=properties)


def read(spark: SparkSession, args: argparse.Namespace, place: str, schema: StructType) -> DataFrame:
    if args.jdbc_url:
        return database(args, place).read(spark, schema)
    return read_fact(spark, place, schema)


def run(spark: SparkSession, words: Sequence[str]) -> None:
    args = arguments(words)
    configure(spark)
    years = read(spark, args, args.years, YEAR_FACT)
    params = ReportParams()
    if args.latest_year:
        params = replace(params, latest_year=args.latest_year)
    else:
        params = params.for_latest_year_of(years)
    files = {
        "flu": checked_flu(spark, args.flu),
        "appeals_history": checked_appeals_history(spark, args.appeals_history),
        "appeals_current": checked_appeals_current(spark, args.appeals_current),
    }
    # Before the run, so that a line left out is known whatever comes of it.
    for name, checked in files.items():
        write_csv(checked.rejects, f"{args.out}/rejects/{name}")
    version = Publication(
        spark,
        years,
        read(spark, args, args.months, MONTH_FACT),
        *[checked.rows for checked in files.values()],
        params,
        read_fact(spark, args.values, YEAR_VALUES) if args.values else None,
    ).publish(args.out)
    print(version)


if __name__ == "__main__":
    session = SparkSession.builder.appName("contractor-statistics").getOrCreate()
    run(session, sys.argv[1:])
    session.stop()

"""The facts as a job: claims, contractors and their history in, facts out.

    spark-submit build_facts.py --claims … --contractors … [--history …] --out …

``publish.py`` reads what this writes: ``out/years`` and ``out/months``, partitioned by
financial year and month, and ``out/values``, the counts from which medians of the
years are taken. ``out/sums`` has the claims added up by month; it is
written first, so that claims are read once. Run again, the job reads and writes only
the months that changed claim files have claims of; see ``apothecary.plans.refresh``.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from apothecary.plans.refresh import Facts
from apothecary.session import configure


def arguments(words: Sequence[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Build the year and month facts from claims.")
    parser.add_argument("--claims", required=True, help="claim lines, Parquet")
    parser.add_argument("--contractors", required=True, help="contractors, Parquet")
    parser.add_argument("--history", help="changes of contractor attributes, Parquet")
    parser.add_argument("--out", required=True, help="output folder")
    return parser.parse_args(words)


def run(spark: SparkSession, words: Sequence[str]) -> None:
    args = arguments(words)
    configure(spark)
    done = Facts(spark, args.out).refresh(args.claims, args.contractors, args.history)
    print("all months" if done.whole else f"months: {', '.join(map(str, done.months)) or 'none'}")


if __name__ == "__main__":
    session = SparkSession.builder.appName("contractor-facts").getOrCreate()
    run(session, sys.argv[1:])
    session.stop()

"""Small reference files: flu measures, appeal decisions, the fee schedule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apothecary.schemas import APPEALS_CURRENT, APPEALS_HISTORY, FEE_SCHEDULE, FLU, require


BROKEN = "_broken_line"


@dataclass(frozen=True)
class Checked:
    """The good rows of a file, and its bad lines: reason, number of lines, and one of them."""

    rows: DataFrame
    rejects: DataFrame


def checked_csv(spark: SparkSession, path: str, schema: T.StructType, snake: bool = False) -> Checked:
    """A CSV with a header, told apart into rows of ``schema`` and lines that are none.

    Columns are found by name, others ignored; a column the file lacks is an error. A line
    is rejected if it has more or fewer fields than the header, or a text where the schema
    has another type. A line with several faults counts for each. An empty field is NULL
    and no fault.
    """
    header = spark.read.csv(path, header=True).columns
    names = [c.strip().lower().replace(" ", "_") if snake else c for c in header]
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, BROKEN]])
    lines = spark.read.csv(path, schema=text, header=True, enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN)
    require(lines.limit(0), schema)
    faults = [F.when(F.col(BROKEN).isNotNull(), F.lit("number of fields"))]
    for f in schema.fields:
        kind = f.dataType.simpleString()
        if kind != "string":
            faults.append(F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(kind).isNull(), F.lit(f"{f.name} is no {kind}")))
    told = lines.withColumn("_faults", F.filter(F.array(*faults), lambda x: x.isNotNull()))
    good = told.where(F.size("_faults") == 0)
    own = F.coalesce(BROKEN, F.to_csv(F.struct(*[F.coalesce(f"`{n}`", F.lit("")).alias(n) for n in names])))
    bad = told.where(F.size("_faults") > 0).select(own.alias("line"), F.explode("_faults").alias("reason"))
    rejects = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"), F.min("line").alias("example"))
    return Checked(require(good.drop("_faults", BROKEN), schema), rejects)


def checked_flu(spark: SparkSession, folder: str) -> Checked:
    return checked_csv(spark, folder, FLU)


def checked_appeals_history(spark: SparkSession, path: str) -> Checked:
    """Decisions of earlier years, exported from the last publication; headers such as ``Financial Year``."""
    return checked_csv(spark, path, APPEALS_HISTORY, snake=True)


def checked_appeals_current(spark: SparkSession, path: str) -> Checked:
    return checked_csv(spark, path, APPEALS_CURRENT, snake=True)


def read_flu(spark: SparkSession, folder: str) -> DataFrame:
    return checked_flu(spark, folder).rows


def read_appeals_history(spark: SparkSession, path: str) -> DataFrame:
    return checked_appeals_history(spark, path).rows


def read_appeals_current(spark: SparkSession, path: str) -> DataFrame:
    return checked_appeals_current(spark, path).rows


# Fee name, pence, first and last day.
FEES = (
    ("Professional fee", 90, "01 Jan 2001", "30 Nov 2016"),
    ("Single activity fee", 113, "01 Dec 2016", "31 Mar 2017"),
    ("Single activity fee", 125, "01 Apr 2017", "31 Oct 2017"),
    ("Single activity fee", 129, "01 Nov 2017", "31 Oct 2018"),
    ("Single activity fee", 126, "01 Nov 2018", "31 Jul 2019"),
    ("Single activity fee", 127, "01 Aug 2019", "31 Jul 2021"),
    ("Single activity fee", 129, "01 Aug 2021", "31 Mar 2022"),
    ("Single activity fee", 127, "01 Apr 2022", "31 Mar 2024"),
)


def fee_schedule(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(FEES), FEE_SCHEDULE)

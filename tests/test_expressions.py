"""NULL rules, rounding, dates and recodes on hand-made rows."""

import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from apothecary.functions import scalars
from apothecary.functions.aggregates import (
    sole,
    sum0,
    sum0_where,
    sum_strict,
    sum_strict_where,
)
from apothecary.functions.formatting import thousands

D = datetime.date


def values(df, column="v"):
    return [r[column] for r in df.collect()]


@pytest.fixture
def sums(spark):
    rows = [("none", None), ("none", None), ("part", 3), ("part", None), ("all", 2), ("all", 5)]
    return spark.createDataFrame(rows, "g string, x long")


def by_group(df, column):
    return {r["g"]: r["v"] for r in df.groupBy("g").agg(column.alias("v")).collect()}


def test_sum0_skips_null_and_gives_zero(sums):
    assert by_group(sums, sum0("x")) == {"none": 0, "part": 3, "all": 7}
    assert by_group(sums, sum0_where("x", F.col("x") > 4)) == {"none": 0, "part": 0, "all": 5}


def test_sum_strict_propagates_null(sums):
    assert by_group(sums, sum_strict("x")) == {"none": None, "part": None, "all": 7}
    assert by_group(sums, sum_strict(F.col("x"))) == {"none": None, "part": None, "all": 7}


def test_sum_strict_where_counts_other_rows_as_zero(sums):
    got = by_group(sums, sum_strict_where("x", F.col("x") > 4))
    assert got == {"none": 0, "part": 0, "all": 5}


def test_sums_over_no_rows(sums):
    row = sums.where("false").agg(sum0("x").alias("a"), sum_strict("x").alias("b")).first()
    assert (row["a"], row["b"]) == (0, None)


def test_sole_refuses_a_second_row(sums):
    one = sums.where("x = 3").groupBy("g").agg(sole("x").alias("v"))
    assert values(one) == [3]
    with pytest.raises(PySparkException):
        sums.groupBy("g").agg(sole("x").alias("v")).collect()


@pytest.mark.parametrize(
    "text, date",
    [
        ("31/12/9999", None),
        ("9999-12-31", None),
        ("01/04/2023", D(2023, 4, 1)),
        ("1/4/2023", D(2023, 4, 1)),
        ("2023-04-01", D(2023, 4, 1)),
        ("01/04/2023 00:00:00", D(2023, 4, 1)),
        ("31/12/9999 00:00", None),
        ("bad", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, date):
    df = spark.createDataFrame([(text,)], "t string")
    assert values(df.select(scalars.parse_date(F.col("t")).alias("v"))) == [date]


def test_year_bounds(spark):
    df = spark.createDataFrame([("1999/2000",)], "y string")
    row = df.select(
        scalars.year_start(F.col("y")).alias("a"), scalars.year_end(F.col("y")).alias("b")
    ).first()
    assert (row["a"], row["b"]) == (D(1999, 4, 1), D(2000, 3, 31))


@pytest.mark.parametrize(
    "date, label", [(D(2023, 3, 31), "2022/2023"), (D(2023, 4, 1), "2023/2024")]
)
def test_financial_year_turns_on_1_april(spark, date, label):
    df = spark.createDataFrame([(date,)], "d date")
    got = df.select(
        scalars.financial_year_label(scalars.financial_year_start(F.col("d"))).alias("v")
    )
    assert values(got) == [label]


def test_financial_year_of_month(spark):
    df = spark.createDataFrame([(200301,), (200303,), (200304,), (200312,)], "m int")
    got = values(df.select(scalars.financial_year_of_month(F.col("m")).alias("v")))
    assert got == ["2002/2003", "2002/2003", "2003/2004", "2003/2004"]


def test_ratio_by_zero_or_null_is_null(spark):
    df = spark.createDataFrame([(6, 4), (6, 0), (6, None), (None, 4)], "a long, b long")
    got = df.select(scalars.safe_ratio(F.col("a"), F.col("b")).alias("v"))
    assert values(got) == [1.5, None, None, None]


@pytest.mark.parametrize(
    "x, digits, rounded", [(2.5, 0, 2.0), (3.5, 0, 4.0), (0.125, 2, 0.12), (-2.5, 0, -2.0)]
)
def test_round_ties_to_even(spark, x, digits, rounded):
    df = spark.createDataFrame([(x,)], "x double")
    assert values(df.select(scalars.r_round(F.col("x"), digits).alias("v"))) == [rounded]


@pytest.mark.parametrize(
    "x, rounded",
    [(0.0, 0.0), (99950.0, 100000.0), (0.0012345, 0.00123), (-12345.0, -12300.0),
     (1000.0, 1000.0), (None, None)],
)
def test_signif3(spark, x, rounded):
    df = spark.createDataFrame([(x,)], "x double")
    got = values(df.select(scalars.signif3(F.col("x")).alias("v")))[0]
    assert got == (None if rounded is None else pytest.approx(rounded, rel=1e-15))


def test_recode_leaves_null_alone(spark):
    df = spark.createDataFrame([("r",), ("other",), (None,)], "x string")
    assert values(df.select(scalars.recode(F.col("x"), "r", "R", "G").alias("v"))) == [
        "R", "G", None,
    ]


def test_labels_without_match_are_null(spark):
    df = spark.createDataFrame([("Y",), ("?",), (None,)], "x string")
    assert values(df.select(scalars.labelled(F.col("x"), {"Y": "yes"}).alias("v"))) == [
        "yes", None, None,
    ]


def test_not_in_keeps_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert values(df.where(scalars.not_in(F.col("v"), ["a"]))) == ["b", None]


def test_listed_order_puts_unlisted_last(spark):
    df = spark.createDataFrame([(None,), ("zz",), ("b",), ("a",)], "v string")
    got = values(df.orderBy(scalars.in_listed_order(F.col("v"), ["b", "a"])))
    assert got[:2] == ["b", "a"] and set(got[2:]) == {"zz", None}


def test_month_start(spark):
    df = spark.createDataFrame([(202304,), (None,)], "m int")
    assert values(df.select(scalars.month_start(F.col("m")).alias("v"))) == [D(2023, 4, 1), None]


def test_thousands(spark):
    df = spark.createDataFrame(
        [(1234567, 1234567.4, 12.5), (5, 2000000.6, 3.25), (None, None, None)],
        "n long, big double, small double",
    )
    got = thousands(df, {"n": "a", "big": "b", "small": "c"}).collect()
    assert [tuple(r) for r in got] == [
        ("1,234,567", "1,234,567", "12.50"),
        ("5", "2,000,001", "3.25"),
        (None, None, None),
    ]

"""Long series and hot groups: previous values as high, latest states."""

import random

import pytest
from pyspark.sql import functions as F

from apothecary.operators import fact, latest, search, trends


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def as_high(rows):
    """By a stack of the values still in sight, as text (key, period, value, found)."""
    out, series = [], {}
    for k, y, x in rows:
        if y is not None and x is not None:
            series.setdefault(k, {}).setdefault(y, []).append(x)
    found = {}
    for k, periods in series.items():
        sight = []
        for y in sorted(periods):
            for x in periods[y]:
                seen = [p for p, v in sight if v >= x]
                found[k, y, x] = seen[-1] if seen else None
            top = max(periods[y])
            while sight and sight[-1][1] <= top:
                sight.pop()
            sight.append((y, top))
    for k, y, x in rows:
        out.append((k, y, x, found.get((k, y, x))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("fan_bits", [1, 6])
def test_highest_since_by_brute_force(spark, monkeypatch, fan_bits):
    monkeypatch.setattr(search, "FAN_BITS", fan_bits)
    monkeypatch.setattr(search, "FAN", 1 << fan_bits)
    rng = random.Random(fan_bits)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(60)]), rng.choice([None, *range(30)])) for _ in range(400)]
    rows += [("c", y, -y) for y in range(150)] + [("d", y, y) for y in range(150)] + [("c", 7, -7)] * 30
    df = spark.createDataFrame(rows, "k string, y int, x int")
    got = trends.highest_since(df, "x", ["k"], "y", "since").collect()
    assert sorted([tuple(r) for r in got], key=repr) == as_high(rows)


def test_highest_since_of_a_long_series(spark):
    n = 100_000
    df = spark.range(n).select(F.lit("k").alias("k"), F.col("id").alias("y"), F.pmod(F.xxhash64("id"), F.lit(1_000_000)).alias("x"))
    got = trends.highest_since(df, "x", ["k"], "y", "since")
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    rows = [tuple(r) for r in got.collect()]
    assert sorted(rows, key=repr) == as_high([r[:3] for r in rows]) and len(rows) == n


def test_highest_since_of_nothing(spark):
    df = spark.createDataFrame([], "k string, y int, x int")
    assert trends.highest_since(df, "x", ["k"], "y", "since").columns == ["k", "y", "x", "since"]
    one = spark.createDataFrame([("a", None, 1), ("a", 1, None)], "k string, y int, x int")
    assert {r["since"] for r in trends.highest_since(one, "x", ["k"], "y", "since").collect()} == {None}


def test_latest_state_of_a_hot_group(spark):
    rows = spark.range(0, 50_000, 1, 24).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 97).alias("k"),
        (F.col("id") % 50).alias("day"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("seq"), F.col("id").cast("string").alias("v"))
    got = latest.latest_state(rows, ["k"], ["day", "seq"], ["v"])
    wanted = {}
    for r in rows.collect():
        wanted[r["k"]] = max(wanted.get(r["k"], (-1, -1, "")), (r["day"], r["seq"], r["v"]))
    assert {r["k"]: r["state"]["v"] for r in got.collect()} == {k: v[2] for k, v in wanted.items()}
    # Reduced before each of the two shuffles.
    text = plan(got)
    assert "collect_list" not in text and text.count("partial_max") >= 2


def test_latest_state_with_nulls_and_ties(spark):
    rows = [("a", None, 1, "x"), ("a", None, 2, None), ("b", 1, 1, "p"), ("b", 1, 1, "q"), ("c", 2, None, None), (None, 1, 1, "n"), (None, 1, 0, "m")]
    got = latest.latest_state(spark.createDataFrame(rows, "k string, day int, seq int, v string"), ["k"], ["day", "seq"], ["v"])
    assert {r["k"]: r["state"]["v"] for r in got.collect()} == {"a": None, "b": "q", "c": None, None: "n"}


def test_states_at_year_end_gather_no_group(spark):
    day = F.expr("date'2020-05-01'")
    history = spark.range(20_000).select(F.lit(1).cast("long").alias("CONTRACTOR_ID"), day.alias("EFFECTIVE_DATE"), F.col("id").alias("SEQUENCE"), F.col("id").cast("string").alias("STATE"))
    years = spark.createDataFrame([(1, "2020/2021"), (1, "2021/2022")], "CONTRACTOR_ID long, FINANCIAL_YEAR string")
    got = fact.attributes_at_year_end(history, years, "STATE")
    assert "collect_list" not in plan(got)
    assert {tuple(r) for r in got.collect()} == {(1, "2020/2021", "19999"), (1, "2021/2022", "19999")}

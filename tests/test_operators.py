"""Operators on hand-made frames, and against plain Python."""

import datetime
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from apothecary.operators import checks, fact, prep, trends
from apothecary.operators.median import exact_median
from apothecary.operators.reshape import complete, to_long, to_wide
from apothecary.params import DECISIONS, ReportParams
from apothecary.plans.appeals import digest_current, table_20
from apothecary.schemas import APPEALS_CURRENT, APPEALS_HISTORY, MONEY, VOLUMES
from apothecary.sources import reference
from apothecary.sources.warehouse import JdbcTable

D = datetime.date


# -- median ---------------------------------------------------------------------


def medians(spark, groups, accuracy=2_000):
    rows = [(g, x) for g, xs in groups.items() for x in xs]
    df = spark.createDataFrame(rows, "g string, x double")
    return {r["g"]: r["m"] for r in exact_median(df, ["g"], "x", "m", accuracy).collect()}


def test_median_of_small_groups(spark):
    groups = {"one": [4.0], "two": [1.0, 4.0], "three": [9.0, 1.0, 5.0, None], "none": [None]}
    assert medians(spark, groups) == {"one": 4.0, "two": 2.5, "three": 5.0}


def test_median_with_null_key(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 7.0)], "g string, x double")
    got = {r["g"]: r["m"] for r in exact_median(df, ["g"], "x", "m").collect()}
    assert got == {None: 1.5, "a": 7.0}


@pytest.mark.parametrize("accuracy", [20, 100, 2_000, 10_000])
def test_median_of_large_skewed_groups(spark, accuracy):
    """A bracket far narrower than the group, ties, and one dominant group."""
    rng = random.Random(accuracy)
    groups = {
        "hot": [rng.lognormvariate(8, 2) for _ in range(30_000)],
        "ties": [float(rng.choice([1, 1, 1, 2])) for _ in range(5_001)],
        "even": [float(rng.randrange(10**6)) for _ in range(4_000)],
    }
    got = medians(spark, groups, accuracy)
    assert got == {g: pytest.approx(statistics.median(xs), rel=1e-15) for g, xs in groups.items()}


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), min_size=1, max_size=40))
def test_median_property(spark, xs):
    present = [x for x in xs if x is not None]
    wanted = {"g": pytest.approx(statistics.median(present))} if present else {}
    assert medians(spark, {"g": xs}, 50) == wanted


def test_building_a_median_runs_nothing_and_keeps_nothing(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", 1.0)], "g string, x double")
    kept = set(spark.sparkContext._jsc.getPersistentRDDs())
    spark.sparkContext.setJobGroup("lazy", "lazy")
    out = exact_median(df, ["g"], "x", "m")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= kept
    assert out.first()["m"] == 2.0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# -- preparation ------------------------------------------------------------------


def test_month_bounds_by_calendar_and_financial_year(spark):
    df = spark.createDataFrame([(202303,), (202304,)], "YEAR_MONTH int")
    calendar = prep.with_period_bounds(df, ReportParams()).collect()
    assert [r["first_day"] for r in calendar] == [D(2023, 4, 1), D(2023, 4, 1)]
    assert [r["last_day"] for r in calendar] == [D(2023, 3, 31), D(2023, 3, 31)]
    true_year = prep.with_period_bounds(df, ReportParams(month_uses_financial_year=True))
    rows = true_year.collect()
    assert [r["first_day"] for r in rows] == [D(2022, 4, 1), D(2023, 4, 1)]
    assert [r["last_day"] for r in rows] == [D(2023, 3, 31), D(2024, 3, 31)]


def test_opened_and_closed_on_the_edges_of_the_year(spark):
    df = spark.createDataFrame(
        [("31/03/2022", "31/03/2023"), ("01/04/2022", "01/04/2023"), ("1/4/2030", None)],
        "START_DATE_HIST string, CLOSE_DATE_HIST string",
    ).withColumn("FINANCIAL_YEAR", F.lit("2022/2023"))
    got = (
        prep.with_period_bounds(prep.parse_dates(df), ReportParams())
        .selectExpr("START_DATE_HIST >= first_day AS o", "CLOSE_DATE_HIST <= last_day AS c")
        .collect()
    )
    assert [(r["o"], r["c"]) for r in got] == [(False, True), (True, False), (True, None)]


def test_review_totals_need_both_parts(spark):
    df = spark.createDataFrame(
        [(1, 2, 3, 4), (None, 2, 3, None)],
        "AUR_HOME int, AUR_PREM int, NUM_AUR_HOME int, NUM_AUR_PREM int",
    )
    got = prep.with_review_totals(df).select("AUR_ALL", "NUM_AUR_ALL").collect()
    assert [tuple(r) for r in got] == [(3, 7), (None, None)]


def test_fill_numeric_leaves_text(spark):
    df = spark.createDataFrame([(None, None, None)], "a long, b double, c string")
    assert tuple(prep.fill_numeric(df).first()) == (0, 0.0, None)


# -- reshaping and completion -------------------------------------------------------


def test_wide_columns_keep_the_order_asked_for(spark):
    df = spark.createDataFrame([("y", 2, 1)], "k string, zebra long, apple long")
    wide = to_wide(to_long(df, ["k"]), ["k"], "measure", "value", ["zebra", "apple"])
    assert wide.columns == ["k", "zebra", "apple"]
    assert tuple(wide.first()) == ("y", 2, 1)


def test_complete_adds_missing_pairs_only(spark):
    df = spark.createDataFrame(
        [("a", 1, 5), ("b", 1, 6), ("a", 2, 7), (None, 2, 8)], "item string, g int, n long"
    )
    got = {(r["item"], r["g"]): r["n"] for r in complete(df, "item", ["g"], "n").collect()}
    assert got == {
        ("a", 1): 5, ("b", 1): 6, (None, 1): 0, ("a", 2): 7, ("b", 2): 0, (None, 2): 8,
    }


# -- appeals --------------------------------------------------------------------------


def test_current_decisions(spark):
    rows = [
        ("2", "Controlled", "refused application", 3),
        ("2", "Controlled", "anything else", None),
        ("2", "Non-Controlled", "refused application", 4),
        ("2", "Elsewhere", "refused application", 100),
        ("2", "Controlled", None, 1),
    ]
    got = digest_current(spark.createDataFrame(rows, APPEALS_CURRENT)).collect()
    assert {tuple(r) for r in got} == {
        ("2", "Controlled", "Application refused", 3),
        ("2", "Controlled", "Application granted", 0),
        ("2", "Controlled", None, 1),
        ("2", "Non-Controlled", "Application refused", 4),
        ("2", "Total", "Application refused", 7),
        ("2", "Total", "Application granted", 0),
        ("2", "Total", None, 1),
    }


def test_table_20_completes_and_orders(spark):
    history = spark.createDataFrame(
        [("1", "Total", DECISIONS[4], None), ("1", "Controlled", DECISIONS[0], 2),
         ("1", "Controlled", "unlisted", 1)],
        APPEALS_HISTORY,
    )
    current = spark.createDataFrame([("2", "Controlled", "granted", 9)], APPEALS_CURRENT)
    got = [tuple(r) for r in table_20(history, current).collect()]
    assert got[:3] == [
        ("1", "Controlled", DECISIONS[0], 2),
        ("1", "Controlled", DECISIONS[4], 0),
        ("1", "Controlled", "unlisted", 1),
    ]
    assert len(got) == 3 * 4
    assert [r[:2] for r in got][3::3] == [("1", "Total"), ("2", "Controlled"), ("2", "Total")]


# -- trends ---------------------------------------------------------------------------


def test_trends(spark):
    rows = [("c", y, x) for y, x in zip(range(8), [4, 5, 6, 6, 3, 4, 8, 9])]
    df = spark.createDataFrame(rows, "k string, y int, x long")
    x = F.col("x")
    got = trends.rising_run(
        df.withColumns(
            {
                "change": trends.change(x, ["k"], "y"),
                "percent": trends.percent_change(x, ["k"], "y"),
                "since": trends.percent_since_first(x, ["k"], "y"),
                "fold": trends.fold_since_first(x, ["k"], "y"),
                "top": trends.highest_so_far(x, ["k"], "y"),
                "low": trends.lowest_so_far(x, ["k"], "y"),
                "rank": trends.rank_from_highest(x, ["k"]),
            }
        ),
        "x", ["k"], "y", "run",
    )
    got = trends.highest_since(got, "x", ["k"], "y", "highest").orderBy("y").collect()
    assert [r["change"] for r in got] == [None, 1, 1, 0, -3, 1, 4, 1]
    assert [r["run"] for r in got] == [0, 1, 2, 0, 0, 1, 2, 3]
    assert [r["top"] for r in got] == [True, True, True, True, False, False, True, True]
    assert [r["low"] for r in got] == [True, False, False, False, True, False, False, False]
    assert got[1]["percent"] == 25.0 and got[7]["since"] == 125.0 and got[7]["fold"] == 2.25
    assert [r["highest"] for r in got] == [None, None, None, 2, 3, 3, None, None]
    assert [r["rank"] for r in got] == [6, 5, 3, 3, 8, 6, 2, 1]


# -- fact -----------------------------------------------------------------------------


def test_volume_bands_include_their_upper_bound(spark):
    df = spark.createDataFrame([(0.0,), (2000.0,), (2000.1,), (10000.0,), (10000.5,), (None,)],
                               "a double")
    got = df.select(fact.volume_band(F.col("a"), ReportParams()).alias("v")).collect()
    assert [r["v"] for r in got] == [
        "0 - 2000", "0 - 2000", "2001 - 4000", "8001 - 10000", "10000+", None,
    ]


def test_month_sums_with_one_hot_contractor(spark):
    """A third of all claims by one contractor, against plain Python sums."""
    rng = random.Random(3)
    columns = (*VOLUMES, *MONEY)
    claims, wanted = [], {}
    for i in range(3_000):
        who = 7 if i % 3 == 0 else rng.randrange(40)
        day = D(2020, 1, 1) + datetime.timedelta(days=rng.randrange(400))
        row = {c: rng.choice([None, 0, rng.randrange(10**9)]) for c in columns}
        claims.append((who, day, *row.values()))
        sums = wanted.setdefault((who, day.year * 100 + day.month), dict.fromkeys(columns))
        for c, x in row.items():
            if x is not None:
                sums[c] = (sums[c] or 0) + x
    schema = "CONTRACTOR_ID long, CLAIM_DATE date, " + ", ".join(f"{c} long" for c in columns)
    months = fact.contractor_months(spark.createDataFrame(claims, schema))
    got = {
        (r["CONTRACTOR_ID"], r["YEAR_MONTH"]): {c: r[c] for c in columns}
        for r in months.collect()
    }
    assert got == wanted
    years = fact.contractor_years(months).where(
        "CONTRACTOR_ID = 7 AND FINANCIAL_YEAR = '2019/2020'"
    )
    hot = [v for (who, m), v in wanted.items() if who == 7 and 201904 <= m <= 202003]
    row = years.first()
    assert row["MONTHS_ACTIVE"] == len(hot) == 3
    assert row["NIC"] == sum(v["NIC"] for v in hot)


def test_owner_type_counts_per_period(spark):
    rows = [("y1", "big")] * 6 + [("y1", "small")] * 5 + [("y2", "big")] * 5
    df = spark.createDataFrame(rows, "FINANCIAL_YEAR string, OWNER_ID string")
    got = fact.with_owner_type(df, fact.YEAR, ReportParams()).groupBy(
        "FINANCIAL_YEAR", "OWNER_ID", "CONTRACTOR_TYPE").count().collect()
    assert {tuple(r) for r in got} == {
        ("y1", "big", "Multiple contractor", 6),
        ("y1", "small", "Independent", 5),
        ("y2", "big", "Independent", 5),
    }


def test_year_end_state_carries_forward(spark):
    history = spark.createDataFrame(
        [(1, D(2020, 5, 1), 1, "a"), (1, D(2020, 5, 1), 2, "b"), (1, D(2021, 3, 31), 1, "c"),
         (1, D(2022, 4, 1), 1, None), (2, D(2021, 6, 1), 1, "z")],
        "CONTRACTOR_ID long, EFFECTIVE_DATE date, SEQUENCE int, STATE string",
    )
    years = spark.createDataFrame(
        [(1, "2019/2020"), (1, "2020/2021"), (1, "2021/2022"), (1, "2022/2023"),
         (2, "2022/2023")],
        "CONTRACTOR_ID long, FINANCIAL_YEAR string",
    )
    got = fact.attributes_at_year_end(history, years, "STATE").collect()
    assert {tuple(r) for r in got} == {
        (1, "2019/2020", None), (1, "2020/2021", "c"), (1, "2021/2022", "c"),
        (1, "2022/2023", None), (2, "2022/2023", "z"),
    }


# -- checks ---------------------------------------------------------------------------


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert [tuple(r) for r in checks.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    assert {tuple(r) for r in checks.missing_counts(df).collect()} == {("k", 0), ("v", 1)}
    assert [tuple(r) for r in checks.unlisted_values(df, "v", ["a"]).collect()] == [("b", 1)]
    other = spark.createDataFrame([(1, "a"), (3, "n")], "k int, v string")
    got = checks.differences(df.where("v = 'a' OR v IS NULL"), other, ["k"], "v").collect()
    assert {tuple(r) for r in got} == {(3, None, "n")}


def test_control_limits_flag_an_outlier(spark):
    rows = [("s", i, 10.0 + i % 2) for i in range(20)] + [("s", 99, 60.0)]
    df = spark.createDataFrame(rows, "s string, t int, v double")
    got = checks.control_limits(df, ["s"], "v").where("outlier").collect()
    assert [r["t"] for r in got] == [99]


# -- sources -----------------------------------------------------------------------------


def test_jdbc_reads_in_slices(spark):
    table = JdbcTable("jdbc:x", "FACT", slices=8, properties={"user": "u"})
    options = table.sliced(5, 900)
    assert (options["lowerBound"], options["upperBound"]) == ("5", "900")
    assert table.sliced(4, 4)["numPartitions"] == "1" and "lowerBound" not in table.sliced(None, None)
    assert table.bounds_query() == "SELECT min(CONTRACTOR_ID) AS low, max(CONTRACTOR_ID) AS high FROM FACT"
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "CONTRACTOR_ID"
    assert options["user"] == "u" and options["dbtable"] == "FACT"


def test_job_names_a_database():
    from publish import arguments, database

    words = ["--years", "Y", "--months", "M", "--flu", "f", "--appeals-history", "h", "--appeals-current", "c", "--out", "o"]
    args = arguments([*words, "--jdbc-url", "jdbc:x", "--jdbc-property", "user=u", "--jdbc-property", "driver=d"])
    options = database(args, args.years).sliced(1, 9)
    assert (options["url"], options["dbtable"], options["user"], options["driver"]) == ("jdbc:x", "Y", "u", "d")


def test_flu_file_with_missing_column_fails(spark, tmp_path):
    (tmp_path / "flu.csv").write_text("FINANCIAL_YEAR,num_flu_pharm\n1999/2000,1\n")
    with pytest.raises(ValueError, match="APPLIANCE_DISPENSER_HIST"):
        reference.read_flu(spark, str(tmp_path))


def test_fee_schedule_dates(spark):
    from apothecary.plans.figures import fee_display

    rows = fee_display(reference.fee_schedule(spark)).collect()
    assert len(rows) == 8
    assert rows[0]["fee_start_date"] == D(2001, 1, 1)
    assert rows[-1]["fee_end_date"] == D(2024, 3, 31)


def test_an_outlier_in_a_short_series_is_flagged(spark):
    rows = [("s", t, v) for t, v in enumerate([10.0, 11.0, 10.0, 11.0, 60.0, 10.0])] + [("s", 9, None), ("one", 1, 5.0), ("two", 1, 5.0), ("two", 2, 6.0)]
    df = spark.createDataFrame(rows, "s string, t int, v double")
    assert not any(r["outlier"] for r in checks.control_limits(df, ["s"], "v").collect())
    got = {(r["s"], r["t"]): r for r in checks.limits_without_the_point(df, ["s"], "t", "v").collect()}
    assert [k for k, r in got.items() if r["outlier"]] == [("s", 4)] and got["s", 4]["range_outlier"]
    others = [10.0, 11.0, 10.0, 11.0, 10.0]
    assert got["s", 4]["upper_limit"] == pytest.approx(statistics.mean(others) + 3 * statistics.stdev(others))
    assert got["s", 4]["range_upper"] == pytest.approx(statistics.mean(others) + 2.66 * 1.0)
    assert ("s", 9) not in got and got["one", 1]["mean"] is None and got["two", 1]["mean"] == 6.0
    assert got["two", 1]["outlier"] is None and got["one", 1]["range_outlier"] is None


def test_counts_are_taken_while_rows_are_written(spark, tmp_path):
    df = spark.createDataFrame([("Y", 1), ("N", None), (None, 2), ("?", 3)], "c string, n int")
    rows, observed = checks.watched(df, {"c": ["Y", "N"]})
    rows.write.parquet(str(tmp_path / "out"))
    assert {tuple(r) for r in checks.seen(spark, observed).collect()} == {("c", 4, 1, 1), ("n", 4, 1, None)}


def test_completion_measures_its_items(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", None, 2), (None, "y", 3)], "g string, item string, n int")
    out = complete(df, "item", ["g"], "n")
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert out.count() == 9 and {tuple(r) for r in out.where("n > 0").collect()} == {("a", "x", 1), ("b", None, 2), (None, "y", 3)}
    with pytest.raises(ValueError, match="more than 2"):
        complete(df, "item", ["g"], "n", most=2)
    assert complete(df.limit(0), "item", ["g"], "n").count() == 0


def test_broken_lines_are_reported_and_the_others_unchanged(spark, tmp_path):
    good = ["2020/2021,Controlled,Application granted,5", '2020/2021,"Non, Controlled",Application refused,', ",,,7"]
    bad = ["2020/2021,Controlled", "2020/2021,Total,Application granted,five", "2020/2021,Total,Application granted,6,extra", "2021/2022,Total,Application granted,1.5.2"]
    header = "Financial Year,Locality,Application Decision,Total Decisions"
    for name, lines in (("clean.csv", good), ("broken.csv", [good[0], bad[0], bad[1], good[1], bad[2], good[2], bad[3]])):
        (tmp_path / name).write_text("\n".join([header, *lines]) + "\n")
    clean = reference.checked_appeals_history(spark, str(tmp_path / "clean.csv"))
    broken = reference.checked_appeals_history(spark, str(tmp_path / "broken.csv"))
    assert clean.rejects.isEmpty() and clean.rows.schema.fieldNames() == APPEALS_HISTORY.fieldNames()
    assert sorted(map(str, broken.rows.collect())) == sorted(map(str, clean.rows.collect()))
    got = {r["reason"]: (r["lines"], r["example"]) for r in broken.rejects.collect()}
    assert got["number of fields"] == (2, bad[0]) and got["total_decisions is no bigint"][0] == 2
    with pytest.raises(ValueError, match="locality"):
        (tmp_path / "other.csv").write_text("financial year\n1\n")
        reference.read_appeals_history(spark, str(tmp_path / "other.csv"))

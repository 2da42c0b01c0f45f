"""Invariants of tables, quirks of extracts, and the publication run."""

import random
import statistics
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from apothecary.operators.median import medians_of_counts, value_counts
from apothecary.params import ReportParams
from apothecary.plans import figures, tables
from apothecary.plans.extracts import (
    MONTHLY,
    NATIONAL,
    SUB_NATIONAL,
    both_grains,
    extract,
    national_extract,
)
from apothecary.plans.flu import with_flu_reference
from apothecary.plans.measures import MEASURES
from apothecary.plans.publication import changed_values, contents, field_dictionary
from apothecary.schemas import FLU, YEAR_FACT, require
from apothecary.sinks.bundle import Bundle
from catalogue.core import Inputs
from catalogue.inputs import _publication
from catalogue.table_columns import COLUMNS

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, FOLDER)


def row_sets(df):
    return sorted(map(str, df.collect()))


def test_list_sizes():
    assert len(MEASURES) == len({m.name for m in MEASURES}) == 118
    assert {s.number: list(s.columns) for s in tables.SPECS} == COLUMNS
    assert [s.number for s in figures.SPECS] == list(range(1, 19))


def test_partial_extract_equals_full_one(inputs):
    names = ["items_total", "num_stoma_pharm", "avg_monthly_items_pharm"]
    keys = [k.lower() for k in SUB_NATIONAL]
    part = extract(inputs.year_fact(), SUB_NATIONAL, inputs.params, names)
    full = extract(inputs.year_fact(), SUB_NATIONAL, inputs.params).select(*part.columns)
    assert part.columns == keys + ["items_total", "avg_monthly_items_pharm", "num_stoma_pharm"]
    assert row_sets(part) == row_sets(full)


def test_both_grains_equal_the_two_extracts(inputs):
    both = both_grains(inputs.year_fact(), inputs.params)
    for grain, keys in (("national", NATIONAL), ("sub_national", SUB_NATIONAL)):
        alone = extract(inputs.year_fact(), keys, inputs.params)
        got = both.where(F.col("grain") == grain).select(*alone.columns)
        assert row_sets(got) == row_sets(alone)


def test_both_grains_read_the_fact_once(inputs):
    both = both_grains(inputs.year_fact(), inputs.params, inputs.year_values())
    assert both._jdf.queryExecution().optimizedPlan().toString().count("Relation [CONTRACTOR_ID") == 1
    assert row_sets(both) == row_sets(both_grains(inputs.year_fact(), inputs.params))


def test_medians_of_counts_merge(spark):
    """Counts of two halves, added up, give the median of the whole at both grains."""
    rng = random.Random(8)
    rows = [(rng.choice(["p", "q", None]), rng.choice(["a", "b"]), rng.choice([None, 0.0, -2.5, rng.gauss(0, 40), float(rng.randrange(5))])) for _ in range(900)]
    halves = [value_counts(spark.createDataFrame(r, "g string, k string, v double"), ["g", "k"], "v") for r in (rows[:450], rows[450:])]
    got = medians_of_counts(halves[0].unionByName(halves[1]), {"coarse": ["g"], "fine": ["g", "k"]}, ["g", "k"], "m").collect()
    wanted = {}
    for g, k, v in rows:
        if v is not None:
            wanted.setdefault(("coarse", g, None), []).append(v)
            wanted.setdefault(("fine", g, k), []).append(v)
    assert {(r["grain"], r["g"], r["k"]): r["m"] for r in got} == {key: pytest.approx(statistics.median(v)) for key, v in wanted.items()}


def fact_rows(spark, rows):
    """Year fact rows from the columns given; the others are NULL."""
    full = [tuple(r.get(n) for n in YEAR_FACT.fieldNames()) for r in rows]
    return spark.createDataFrame(full, YEAR_FACT)


def test_missing_geography_and_measures(spark):
    """Rows without a board form a group of their own, also next to grouping sets."""
    base = {"FINANCIAL_YEAR": "2022/2023", "APPLIANCE_DISPENSER_HIST": "N"}
    rows = [
        {**base, "CONTRACTOR_ID": 1, "ITEMS": 5, "AVG_MONTHLY_ITEMS": 1.0},
        {**base, "CONTRACTOR_ID": 2, "AVG_MONTHLY_ITEMS": 4.0},
        {**base, "CONTRACTOR_ID": 3, "ICB_CODE": "A", "ICB_NAME": "a", "ITEMS": 7,
         "AVG_MONTHLY_ITEMS": 9.0, "START_DATE_HIST": "9999-12-31",
         "CLOSE_DATE_HIST": "31/12/9999"},
        {**base, "CONTRACTOR_ID": 4, "ICB_CODE": "A", "ICB_NAME": "a"},
    ]
    both = both_grains(fact_rows(spark, rows), ReportParams()).collect()
    got = {
        (r["grain"], r["icb_code"]): (
            r["num_contractors"], r["items_total"], r["avg_monthly_items_pharm"],
            r["num_open_pharm"], r["num_close_pharm"], r["num_nms_pharm"],
        )
        for r in both
    }
    assert got == {
        ("national", None): (4, 12, 4.0, 0, 0, 0),
        ("sub_national", None): (2, 5, 2.5, 0, 0, 0),
        ("sub_national", "A"): (2, 7, 9.0, 0, 0, 0),
    }


def test_facts_follow_their_settings(spark, inputs):
    many = Inputs(spark, FOLDER, replace(inputs.params, multiple_owner_size=1))
    kinds = many.year_fact().select("CONTRACTOR_TYPE").distinct().collect()
    assert [r[0] for r in kinds] == ["Multiple contractor"]
    assert many.year_fact().count() == inputs.year_fact().count()


def test_all_contractors_equal_both_classes(inputs):
    ex = inputs.extracts()
    whole = {r["financial_year"]: r for r in tables.table(12, ex, inputs.params).collect()}
    parts = {}
    for n in (3, 10):
        for r in tables.table(n, ex, inputs.params).collect():
            parts[r["financial_year"]] = parts.get(r["financial_year"], 0) + r["items_total"]
    assert parts == {y: r["items_total"] for y, r in whole.items()}


def test_regions_add_up_to_boards(inputs):
    ex = inputs.extracts()
    for region, board in ((14, 15), (16, 17), (18, 19)):
        a = tables.table(region, ex, inputs.params).agg(F.sum("num_contractors")).first()[0]
        b = tables.table(board, ex, inputs.params).agg(F.sum("num_contractors")).first()[0]
        assert a == b


def test_bands_add_up_to_pharmacies(inputs):
    ex = inputs.extracts()
    bands = tables.table(4, ex, inputs.params).groupBy("financial_year").agg(
        F.sum("number_of_pharmacies").alias("n"))
    whole = tables.table(1, ex, inputs.params).selectExpr("financial_year", "community_pharmacies n")
    assert row_sets(bands) == row_sets(whole)


def test_table_4_order(inputs):
    rows = tables.table(4, inputs.extracts(), inputs.params).collect()
    assert [r["dispensing_volume_band"] for r in rows[:6]] == [
        "0 - 2000", "2001 - 4000", "4001 - 6000", "6001 - 8000", "8001 - 10000", "10000+",
    ]
    years = [r["financial_year"] for r in rows]
    assert years == sorted(years)


def test_extract_is_ordered(inputs):
    rows = national_extract(inputs.year_fact(), inputs.params).collect()
    keys = [(r["financial_year"], r["appliance_dispenser_hist"]) for r in rows]
    assert keys == sorted(keys)


def test_monthly_consultations_count_drug_cost(spark, inputs):
    fact = inputs.month_fact().where("(CPCS_FEES > 0) <> (coalesce(CPCS_DRUGS, 0) > 0)")
    got = extract(fact, MONTHLY, inputs.params, ["num_cpcs_drugs_pharm"])
    wanted = fact.where("CPCS_DRUGS > 0").count()
    assert got.agg(F.sum("num_cpcs_drugs_pharm")).first()[0] == wanted


def national(spark, rows):
    return spark.createDataFrame(
        rows,
        "financial_year string, appliance_dispenser_hist string, num_flu_pharm long,"
        " flu_items_total long",
    )


def test_unmatched_flu_years_stay_missing_unless_asked(spark):
    df = national(spark, [("1", "N", 5, 50), ("2", "N", 6, 60), (None, "N", 7, 70)])
    flu = spark.createDataFrame([("1", "N", 1, 10, None, None), (None, "N", 2, 20, None, None)], FLU)
    strict = with_flu_reference(df, flu, ReportParams())
    loose = with_flu_reference(df, flu, ReportParams(flu_falls_back_to_warehouse=True))
    pick = lambda d: {r["financial_year"]: r["num_flu_pharm"] for r in d.collect()}
    assert pick(strict) == {"1": 1, "2": None, None: 2}
    assert pick(loose) == {"1": 1, "2": 6, None: 2}


def test_missing_fact_column_fails(spark):
    with pytest.raises(ValueError, match="ICB_NAME"):
        require(spark.createDataFrame([(1,)], "CONTRACTOR_ID long"), YEAR_FACT)


def test_smoking_figure_is_named_by_measure(inputs):
    wide = figures.figure_wide(figures.BY_NUMBER[16], inputs.extracts(), inputs.params)
    long = figures.figure_long(figures.BY_NUMBER[16], inputs.extracts(), inputs.params)
    first = long.first()
    assert first["measure"].startswith("Cost of Nicotine")
    shown = {r["financial_year"]: r["cost_of_products"] for r in wide.collect()}
    assert float(shown[first["financial_year"]].replace(",", "")) == pytest.approx(
        float(first["value"]), abs=1)


def test_fields_and_contents(spark):
    assert field_dictionary(spark).count() == 27
    titles = [r["title"] for r in contents(spark).orderBy("position").collect()]
    assert len(titles) == 21 and titles[0] == "Metadata"


def test_publication(spark, inputs, tmp_path):
    out, bundle = str(tmp_path / "out"), Bundle(spark, str(tmp_path / "out"))
    publication = _publication(inputs)
    first = publication.publish(out)
    assert bundle.current() == first
    rows = {r["name"]: r["rows"] for r in bundle.manifest(first).collect()}
    assert len([n for n in rows if n.startswith("tables/")]) == 20 and all(rows.values())
    assert rows["figures/figure_17/wide"] and rows["figures/figure_19"] and len(rows) == 20 + 2 * 18 + 1
    stored = spark.read.parquet(f"{first}/tables/table_03/parquet")
    assert stored.schema["items_total"].metadata["title"] == "Total of ITEMS"
    alone = tables.table(3, inputs.extracts(), inputs.params)
    assert row_sets(stored) == row_sets(alone)
    csv = spark.read.csv(f"{first}/figures/figure_17/wide", header=True)
    assert csv.columns == ["year_month", "cost_of_products", "cost_of_consultation_fees"]

    # A run that fails leaves the version that was there.
    broken = replace(publication, appeals_current=publication.appeals_current.drop("number"))
    with pytest.raises(Exception):
        broken.publish(out)
    assert bundle.current() == first and bundle.damaged(first).isEmpty()
    second = publication.publish(out, (3,), False)
    assert bundle.current() == second and changed_values(spark, second, second).isEmpty()
    stored.limit(3).write.mode("append").parquet(f"{first}/tables/table_03/parquet")
    assert [r["name"] for r in bundle.damaged(first).collect()] == ["tables/table_03"]
    publication.publish(out, (3,), False)
    assert len(list((tmp_path / "out/versions").iterdir())) == 3  # two complete ones and what failed
    assert bundle.current() != second


def test_values_that_changed_are_listed(spark, inputs, tmp_path):
    bundle = Bundle(spark, str(tmp_path))

    def version(rows, more=()):
        staged = bundle.stage()
        for n, r in ((1, rows), (2, [("x", 1.0, 1)]), *more):
            spark.createDataFrame(r, "k string, v double, n int").write.parquet(f"{staged}/tables/table_{n:02d}/parquet")
        bundle.commit(staged, keep=9)
        return staged

    old = version([("a", 1.0, 1), ("a", 2.0, 1), ("b", None, 2), (None, 5.0, None)])
    new = version([("a", 2.0, 1), ("a", 3.0, 1), ("b", 0.0, 2), (None, 5.0, None)], [(3, [("y", None, 4)])])
    got = {tuple(r) for r in changed_values(spark, old, new).collect()}
    assert got == {
        (1, "a", "v", 1, 1.0, 2.0, True, True), (1, "a", "v", 2, 2.0, 3.0, True, True), (1, "b", "v", 1, None, 0.0, True, True),
        (3, "y", "v", 1, None, None, False, True), (3, "y", "n", 1, None, 4.0, False, True),
    }
    assert "table_02" not in changed_values(spark, old, new)._jdf.queryExecution().optimizedPlan().toString()


def test_job_from_files(spark, inputs, tmp_path):
    """The command line job, over facts and reference files on disk."""
    from apothecary.sinks.files import write_csv
    from publish import run

    at = lambda name: str(tmp_path / name)
    inputs.year_fact().write.partitionBy("FINANCIAL_YEAR").parquet(at("years"))
    inputs.month_fact().write.partitionBy("FINANCIAL_YEAR").parquet(at("months"))
    write_csv(inputs.flu_reference(), at("flu"))
    write_csv(inputs.appeals_history(), at("history"))
    write_csv(inputs.appeals_current(), at("current"))
    run(
        spark,
        ["--years", at("years"), "--months", at("months"), "--flu", at("flu"),
         "--appeals-history", at("history"), "--appeals-current", at("current"),
         "--out", at("out"), "--latest-year", "2001/2002"],
    )
    version = Bundle(spark, at("out")).current()
    stored = spark.read.parquet(f"{version}/tables/table_17/parquet")
    alone = tables.table(17, inputs.extracts(), inputs.params)
    assert row_sets(stored) == row_sets(alone)
    appeals = spark.read.parquet(f"{version}/tables/table_20/parquet")
    assert appeals.where("financial_year = '2001/2002'").count() == 9


def test_job_from_claims_to_publication(spark, inputs, tmp_path):
    """Claim files, contractors and a history that moves one contractor to another class."""
    from apothecary.sinks.files import write_csv
    from build_facts import run as build
    from publish import run as publish

    at = lambda name: str(tmp_path / name)
    inputs.claims().write.parquet(at("claims"))
    inputs.contractors().write.parquet(at("contractors"))
    names = ("OWNER_ID", "APPLIANCE_DISPENSER_HIST", "ICB_CODE", "ICB_NAME", "REGION_CODE", "REGION_NAME",
             "DIST_SELLING_DISPENSER_HIST", "LPS_DISPENSER_HIST")
    history = inputs.contractors().where("CONTRACTOR_ID = 1").selectExpr(
        "CONTRACTOR_ID", "DATE'1998-05-01' AS EFFECTIVE_DATE", "1L AS SEQUENCE", *names
    )
    history = history.withColumn("LPS_DISPENSER_HIST", F.lit("Z"))
    history.write.parquet(at("history"))
    build(spark, ["--claims", at("claims"), "--contractors", at("contractors"), "--history", at("history"), "--out", at("facts")])
    years = spark.read.parquet(at("facts/years"))
    own = inputs.year_fact()
    assert years.count() == own.count()
    assert years.agg(F.sum("NIC")).first() == own.agg(F.sum("NIC")).first()
    lps = {r["FINANCIAL_YEAR"]: r["LPS_DISPENSER_HIST"] for r in years.where("CONTRACTOR_ID = 1").collect()}
    assert {lps[y] for y in lps if y >= "1998/1999"} == {"Z"} and "Z" not in {lps[y] for y in lps if y < "1998/1999"}
    write_csv(inputs.flu_reference(), at("flu"))
    write_csv(inputs.appeals_history(), at("old"))
    write_csv(inputs.appeals_current(), at("new"))
    publish(
        spark,
        ["--years", at("facts/years"), "--months", at("facts/months"), "--flu", at("flu"),
         "--values", at("facts/values"), "--appeals-history", at("old"), "--appeals-current", at("new"), "--out", at("out"), "--latest-year", "2001/2002"],
    )
    assert spark.read.parquet(f"{Bundle(spark, at('out')).current()}/tables/table_03/parquet").count() > 0

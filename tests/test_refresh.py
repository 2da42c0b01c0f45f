"""Facts kept up to date: which partitions a run writes, and that the result is that of a full build."""

import pytest
from pyspark.sql import functions as F

from apothecary.operators.digests import digest
from apothecary.plans.refresh import Facts
from apothecary.schemas import ATTRIBUTE_HISTORY, MONTH_FACT, YEAR_FACT, YEAR_VALUES
from apothecary.sources.warehouse import read_fact
from catalogue.core import Inputs

TABLES = (("years", YEAR_FACT), ("months", MONTH_FACT), ("values", YEAR_VALUES))


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    """Claims of two years and contractors as files."""
    folder = tmp_path_factory.mktemp("refresh")
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    claims = inputs.claims().where("CLAIM_DATE BETWEEN '1999-04-01' AND '2001-03-31'")
    claims = claims.unionByName(claims.limit(3).withColumn("CLAIM_DATE", F.lit(None).cast("date")))
    claims.write.parquet(str(folder / "all"))
    inputs.contractors().write.parquet(str(folder / "contractors"))
    return folder, spark.read.parquet(str(folder / "all")), str(folder / "contractors")


def contents(spark, folder):
    return {name: tuple(digest(read_fact(spark, f"{folder}/{name}", schema)).first()) for name, schema in TABLES}


def full_build(spark, sources, tmp_path, claims, history=None):
    at = str(tmp_path / "full")
    Facts(spark, at).refresh(claims, sources[2], history)
    return contents(spark, at)


def times(folder, table):
    return {p.parent.name: p.stat().st_mtime_ns for p in sorted((folder / "facts" / table).rglob("*.parquet"))}


def test_a_changed_month_rewrites_its_own_partitions(spark, sources, tmp_path):
    claims, facts = str(tmp_path / "claims"), Facts(spark, str(tmp_path / "facts"))
    _, lines, contractors = sources
    late = F.col("CLAIM_DATE") >= "2001-03-01"
    lines.where(~late | F.col("CLAIM_DATE").isNull()).write.parquet(claims)
    assert facts.refresh(claims, contractors).whole
    months, years = times(tmp_path, "months"), times(tmp_path, "years")
    assert facts.refresh(claims, contractors).months == ()

    lines.where(late).write.mode("append").parquet(claims)
    done = facts.refresh(claims, contractors)
    assert not done.whole and done.months == (200103,)
    after, years_after = times(tmp_path, "months"), times(tmp_path, "years")
    assert {m for m in after if after[m] != months.get(m)} == {"YEAR_MONTH=200103"}
    assert {y for y in years_after if years_after[y] != years.get(y)} == {"FINANCIAL_YEAR=2000%2F2001"}
    assert contents(spark, str(tmp_path / "facts")) == full_build(spark, sources, tmp_path, claims)

    written = read_fact(spark, str(tmp_path / "facts/months"), MONTH_FACT).where("YEAR_MONTH = 200103")
    counted = {r["column_name"]: r for r in facts.checks("months").collect()}
    assert counted["ITEMS"]["rows"] == written.count() and counted["ITEMS"]["missing"] == 0
    assert counted["PFCP_UMSMIREMUNERATION"]["missing"] == written.where("PFCP_UMSMIREMUNERATION IS NULL").count()
    assert counted["CONTRACTOR_TYPE"]["unlisted"] == 0 and counted["ITEMS"]["unlisted"] is None


def test_files_that_go_take_their_months(spark, sources, tmp_path):
    claims, facts = tmp_path / "claims", Facts(spark, str(tmp_path / "facts"))
    _, lines, contractors = sources
    last_year = F.col("CLAIM_DATE") < "2000-04-01"
    lines.where(~last_year | F.col("CLAIM_DATE").isNull()).write.parquet(str(claims / "a"))
    lines.where(last_year).coalesce(1).write.parquet(str(claims / "b"))
    lines.where("CLAIM_DATE = '2000-05-02'").write.parquet(str(claims / "c"))
    paths = [str(claims / x) for x in "abc"]

    def refresh():
        return facts.refresh(str(claims / "*"), contractors)

    assert refresh().whole and len(paths) == 3
    for part in (claims / "b").glob("*.parquet"):
        part.unlink()
    done = refresh()
    assert len(done.months) == 12 and max(done.months) == 200003
    got = read_fact(spark, str(tmp_path / "facts/years"), YEAR_FACT)
    assert got.where("FINANCIAL_YEAR = '1999/2000'").isEmpty()
    assert contents(spark, str(tmp_path / "facts")) == full_build(spark, sources, tmp_path, str(claims / "*"))


def test_other_contractors_or_history_build_all(spark, sources, tmp_path):
    claims, facts = str(tmp_path / "claims"), Facts(spark, str(tmp_path / "facts"))
    folder, lines, contractors = sources
    lines.write.parquet(claims)
    facts.refresh(claims, contractors)
    history = spark.createDataFrame([], ATTRIBUTE_HISTORY)
    history.write.parquet(str(tmp_path / "history"))
    assert facts.refresh(claims, contractors, str(tmp_path / "history")).whole
    assert facts.refresh(claims, contractors, str(tmp_path / "history")).months == ()


def test_digests_do_not_depend_on_order(spark):
    df = spark.range(100).select(F.col("id").alias("a"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("b"))
    one = digest(df).first()
    assert one == digest(df.orderBy(F.rand(1)).select("b", "a").repartition(7)).first()
    assert one != digest(df.union(df.limit(1))).first()
    swapped = spark.createDataFrame([(None, 1)], "a int, b int"), spark.createDataFrame([(1, None)], "a int, b int")
    assert digest(swapped[0]).first() != digest(swapped[1]).first()
    assert digest(df.limit(0)).first()["rows"] == 0

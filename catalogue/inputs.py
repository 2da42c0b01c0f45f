"""Sources, sinks, and the contractor fact built from claims."""

from __future__ import annotations

from dataclasses import replace
from uuid import uuid4

from pyspark.sql import functions as F

from apothecary.functions.scalars import financial_year_label, financial_year_start, safe_ratio
from apothecary.operators import fact
from apothecary.plans import facts, figures, tables
from apothecary.plans.extracts import NATIONAL, extract
from apothecary.plans.publication import Publication, changed_values, published_values
from apothecary.plans.refresh import Facts
from apothecary.schemas import MONEY, VOLUMES, YEAR_FACT
from apothecary.session import run_folder
from apothecary.sinks.bundle import Bundle
from apothecary.sinks.files import write_csv, write_rows
from apothecary.sources import reference
from apothecary.sources.warehouse import read_fact
from catalogue.core import BODIES, Inputs, query

ACTIVITY_COLUMNS = ", ".join(
    f"{c} AS {c.lower()}" for c in (*VOLUMES, *MONEY)
)
YEAR_LABEL = "CAST(y AS VARCHAR) || '/' || CAST(y + 1 AS VARCHAR)"


def lower(df):
    return df.toDF(*[c.lower() for c in df.columns])


# -- contractor fact -----------------------------------------------------------

query(
    "fct1_known_contractors",
    f"SELECT id AS contractor_id, {YEAR_LABEL} AS financial_year, ITEMS AS items, NIC AS nic"
    " FROM year_sums WHERE id IN (SELECT id FROM contractors WHERE class = 'N' AND lps = 'N')",
)(
    lambda s: lower(
        fact.of_known_contractors(
            fact.contractor_years(fact.contractor_months(s.claims())),
            s.contractors().where("APPLIANCE_DISPENSER_HIST = 'N' AND LPS_DISPENSER_HIST = 'N'"),
        ).selectExpr("CONTRACTOR_ID", "FINANCIAL_YEAR", "ITEMS", fact.pounds("NIC"))
    )
)
query(
    "fct2_active_contractors",
    f"SELECT id AS contractor_id, {YEAR_LABEL} AS financial_year, months AS months_active,"
    f" {ACTIVITY_COLUMNS} FROM year_sums",
)(
    lambda s: lower(
        fact.contractor_years(s.activity()).selectExpr(
            "CONTRACTOR_ID", "FINANCIAL_YEAR", "MONTHS_ACTIVE", *VOLUMES,
            *[fact.pounds(c) for c in MONEY],
        )
    )
)
query(
    "fct3_financial_year",
    f"SELECT CAST(shipped AS DATE) AS claim_date, {YEAR_LABEL} AS financial_year,"
    " count(*) AS claims FROM claims GROUP BY ALL",
)(
    lambda s: s.claims()
    .groupBy(
        F.col("CLAIM_DATE").alias("claim_date"),
        financial_year_label(financial_year_start(F.col("CLAIM_DATE"))).alias("financial_year"),
    )
    .agg(F.count(F.lit(1)).alias("claims"))
)
query(
    "fct4_average_items",
    f"SELECT id AS contractor_id, {YEAR_LABEL} AS financial_year,"
    " CAST(ITEMS AS DOUBLE) / months AS average FROM year_sums",
)(
    lambda s: fact.contractor_years(s.activity()).select(
        F.col("CONTRACTOR_ID").alias("contractor_id"),
        F.col("FINANCIAL_YEAR").alias("financial_year"),
        safe_ratio(F.col("ITEMS"), F.col("MONTHS_ACTIVE")).alias("average"),
    )
)
query(
    "fct5_bands",
    f"""SELECT id AS contractor_id, {YEAR_LABEL} AS financial_year,
    CASE WHEN ITEMS <= 2000 * months THEN '0 - 2000'
    WHEN ITEMS <= 4000 * months THEN '2001 - 4000'
    WHEN ITEMS <= 6000 * months THEN '4001 - 6000'
    WHEN ITEMS <= 8000 * months THEN '6001 - 8000'
    WHEN ITEMS <= 10000 * months THEN '8001 - 10000' ELSE '10000+' END AS band
    FROM year_sums""",
)(
    lambda s: fact.contractor_years(s.activity()).select(
        F.col("CONTRACTOR_ID").alias("contractor_id"),
        F.col("FINANCIAL_YEAR").alias("financial_year"),
        fact.volume_band(safe_ratio(F.col("ITEMS"), F.col("MONTHS_ACTIVE")), s.params).alias(
            "band"
        ),
    )
)
query(
    "fct6_year_end_state",
    """SELECT a.id AS contractor_id, CAST(a.y AS VARCHAR) || '/' || CAST(a.y + 1 AS VARCHAR)
    AS financial_year, arg_max(l.l_returnflag, row(l.l_shipdate, l.l_orderkey,
    l.l_linenumber, l.l_extendedprice, l.l_returnflag)) AS state
    FROM (SELECT DISTINCT id, y FROM claims) a
    JOIN lineitem l ON l.l_suppkey = a.id AND l.l_shipdate < make_date(a.y + 1, 4, 1)
    GROUP BY a.id, a.y""",
)(
    lambda s: lower(
        fact.attributes_at_year_end(
            s.attribute_history(),
            s.activity().select("CONTRACTOR_ID", "FINANCIAL_YEAR").distinct(),
            "STATE",
        )
    )
)


def _fact_with_history(s: Inputs):
    """The year fact with LPS status by the return flag of the last claim line of the year."""
    months = s.activity()
    flag = F.when(F.col("STATE") == "R", "Y").otherwise("N")
    history = s.attribute_history().withColumn("LPS_DISPENSER_HIST", flag).drop("STATE")
    held = facts.held_by_year(s.contractors(), history, months)
    return facts.year_fact(months, held, s.params)


query(
    "fct6_fact_with_history",
    """SELECT f.CONTRACTOR_ID AS contractor_id, f.FINANCIAL_YEAR AS financial_year,
    CASE WHEN h.state = 'R' THEN 'Y' ELSE 'N' END AS lps, f.CONTRACTOR_TYPE AS contractor_type,
    f.ITEMS AS items, f.NIC AS cost FROM year_fact f JOIN (SELECT a.id, a.y,
    arg_max(l.l_returnflag, row(l.l_shipdate, l.l_orderkey, l.l_linenumber, l.l_extendedprice,
    l.l_returnflag)) AS state FROM (SELECT DISTINCT id, y FROM claims) a
    JOIN lineitem l ON l.l_suppkey = a.id AND l.l_shipdate < make_date(a.y + 1, 4, 1)
    GROUP BY a.id, a.y) h ON h.id = f.CONTRACTOR_ID AND h.y = f.y""",
)(
    lambda s: _fact_with_history(s).selectExpr(
        "CONTRACTOR_ID AS contractor_id", "FINANCIAL_YEAR AS financial_year",
        "LPS_DISPENSER_HIST AS lps", "CONTRACTOR_TYPE AS contractor_type",
        "ITEMS AS items", "NIC AS cost",
    )
)
query(
    "fct7_owner_type",
    "SELECT CONTRACTOR_ID AS contractor_id, FINANCIAL_YEAR AS financial_year,"
    " CONTRACTOR_TYPE AS contractor_type FROM year_fact",
)(
    lambda s: s.year_fact_from(s.activity()).selectExpr(
        "CONTRACTOR_ID AS contractor_id",
        "FINANCIAL_YEAR AS financial_year",
        "CONTRACTOR_TYPE AS contractor_type",
    )
)


def _claims_by_year(s: Inputs):
    return s.claims().withColumn(
        "financial_year", financial_year_label(financial_year_start(F.col("CLAIM_DATE")))
    )


query(
    "fct8_service_use",
    f"""SELECT {YEAR_LABEL} AS financial_year, CAST(count(fee) AS BIGINT) AS services,
    count(DISTINCT id) FILTER (WHERE fee IS NOT NULL) AS providers
    FROM (SELECT *, CASE WHEN (p + 4 * n) % 9 = 0 THEN price END AS fee FROM claims)
    GROUP BY y""",
)(lambda s: fact.service_use(_claims_by_year(s), "NMS_FEES", ("financial_year",)))
query(
    "fct9_distinct_providers",
    f"SELECT {YEAR_LABEL} AS financial_year, count(DISTINCT id) AS providers FROM claims"
    " WHERE (p + 3 * n) % 8 = 0 GROUP BY y",
)(
    lambda s: fact.distinct_providers(
        _claims_by_year(s).where(F.col("FLU_ITEMS") > 0), "CONTRACTOR_ID", ("financial_year",)
    )
)

# -- sources ------------------------------------------------------------------

query(
    "src1_year_fact",
    "SELECT " + ", ".join(f"{c} AS {c.lower()}" for c in YEAR_FACT.fieldNames())
    + " FROM year_fact",
)(lambda s: lower(s.year_fact()))


def _refreshed(s: Inputs):
    """The year fact after three runs: without some claims, with all of them, and with nothing new."""
    folder = run_folder(s.spark, f"files/refresh-{uuid4().hex}")
    claims, late = s.claims(), F.col("CLAIM_DATE").between("2001-02-01", "2001-05-31")
    claims.where(~late).write.parquet(f"{folder}/claims")
    s.contractors().write.parquet(f"{folder}/contractors")
    built = Facts(s.spark, f"{folder}/facts", s.params)
    built.refresh(f"{folder}/claims", f"{folder}/contractors")
    claims.where(late).write.mode("append").parquet(f"{folder}/claims")
    for _ in range(2):
        built.refresh(f"{folder}/claims", f"{folder}/contractors")
    return lower(read_fact(s.spark, f"{folder}/facts/years", YEAR_FACT))


query("src1_refreshed", BODIES["src1_year_fact"])(_refreshed)


def _flu_file(s: Inputs):
    folder = run_folder(s.spark, "files/flu")
    file = s.flu_reference().withColumn("remark", F.lit("not read"))
    write_csv(file.select("remark", *s.flu_reference().columns[::-1]), folder)
    return lower(reference.read_flu(s.spark, folder))


query("src2_flu_file", "SELECT * FROM flu")(_flu_file)


def _history_file(s: Inputs):
    folder = run_folder(s.spark, "files/history")
    write_csv(
        s.appeals_history().selectExpr(
            "financial_year AS `Financial Year`",
            "locality AS `Locality`",
            "application_decision AS `Application Decision`",
            "total_decisions AS `Total Decisions`",
        ),
        folder,
    )
    return reference.read_appeals_history(s.spark, folder)


query("src3_appeals_history", "SELECT * FROM history")(_history_file)


def _history_rejects(s: Inputs):
    """Lines of a history in which one locality has words for numbers."""
    folder = run_folder(s.spark, "files/broken_history")
    number = F.when(F.col("locality") == "Controlled", F.lit("some")).otherwise(F.col("total_decisions").cast("string"))
    write_csv(s.appeals_history().withColumn("total_decisions", number), folder)
    return reference.checked_appeals_history(s.spark, folder).rejects.select("reason", "lines")


query(
    "src3_rejects",
    "SELECT 'total_decisions is no bigint' AS reason, count(*) AS lines FROM history WHERE locality = 'Controlled'",
)(_history_rejects)


def _current_file(s: Inputs):
    folder = run_folder(s.spark, "files/current")
    write_rows(
        s.appeals_current().selectExpr(
            "financial_year AS `Financial Year`",
            "locality AS `Locality`",
            "application_decision AS `Application decision`",
            "number AS `Number`",
        ),
        folder,
    )
    return reference.read_appeals_current(s.spark, folder)


query("src4_appeals_current", "SELECT * FROM current_rows")(_current_file)

_FEES = (
    "SELECT o_orderpriority AS fee_name, CAST(count(*) % 200 AS INTEGER) AS fee_value_pence,"
    " CAST(min(o_orderdate) AS DATE) AS fee_start_date,"
    " CAST(max(o_orderdate) AS DATE) AS fee_end_date"
    " FROM orders GROUP BY o_orderpriority, year(o_orderdate)"
)
query(
    "src5_fee_schedule",
    "SELECT fee_name, fee_value_pence, strftime(fee_start_date, '%d %b %Y') AS fee_start,"
    f" strftime(fee_end_date, '%d %b %Y') AS fee_end FROM ({_FEES})",
)(lambda s: s.fees())
query("fig19_fees", _FEES)(lambda s: figures.fee_display(s.fees()))
query("src6_latest_year", "SELECT max(FINANCIAL_YEAR) AS latest_year FROM year_fact")(
    lambda s: s.year_fact()
    .where(F.col("FINANCIAL_YEAR") == s.params.for_latest_year_of(s.year_fact()).latest_year)
    .select(F.col("FINANCIAL_YEAR").alias("latest_year"))
    .distinct()
)

# -- sinks --------------------------------------------------------------------


def _table_file(s: Inputs):
    folder = run_folder(s.spark, "files/table_06")
    table = tables.table(6, s.extracts(), s.params)
    write_csv(table, folder)
    return s.spark.read.csv(folder, header=True, schema=table.schema)


query("snk1_table_file", BODIES["tab06_advanced_services"])(_table_file)


def _extract_dump(s: Inputs):
    folder = run_folder(s.spark, "files/national_extract")
    national = extract(s.year_fact(), NATIONAL, s.params)
    write_rows(national, folder)
    return s.spark.read.csv(folder, header=True, schema=national.schema)


query("snk1_extract_dump", BODIES["ext1_national"])(_extract_dump)


def _publication(s: Inputs) -> Publication:
    return Publication(
        s.spark,
        s.year_fact(),
        s.month_fact(),
        s.flu_reference(),
        s.appeals_history(),
        s.appeals_current(),
        s.params,
        s.year_values(),
    )


def _published(s: Inputs):
    folder = run_folder(s.spark, "publication")
    _publication(s).publish(folder, with_figures=False)
    return published_values(s.spark, f"{Bundle(s.spark, folder).current()}/tables")


def _changed(s: Inputs):
    """Three tables as they were before the last year came in, and as they are; one of them is as it was."""
    folder, now = run_folder(s.spark, f"files/changed-{uuid4().hex}"), _publication(s)
    years = s.year_fact().where(F.col("FINANCIAL_YEAR") < s.params.latest_year)
    old = replace(now, year_fact=years, year_values=None).publish(folder, (3, 17, 20), False)
    new = now.publish(folder, (3, 17, 20), False)
    return changed_values(s.spark, old, new)


def _values_sql(n: int) -> str:
    """The values of a table, from the SQL that checks it."""
    body = next(sql for name, sql in BODIES.items() if name.startswith(f"tab{n:02d}_"))
    keys = ["financial_year", *_MORE_KEYS.get(n, ())]
    named = f"SELECT concat_ws('|', {', '.join(keys)}) AS row_key, * EXCLUDE ({', '.join(keys)}) FROM ({body})"
    doubles = f"SELECT row_key, CAST(COLUMNS(* EXCLUDE (row_key)) AS DOUBLE) FROM ({named})"
    return (
        f"SELECT CAST({n} AS INTEGER) AS position, row_key, column_name, value FROM"
        f" ({doubles}) UNPIVOT INCLUDE NULLS (value FOR column_name IN (COLUMNS(* EXCLUDE (row_key))))"
    )


_MORE_KEYS = {
    4: ("dispensing_volume_band",),
    20: ("locality", "application_decision"),
    **{n: (("region_code", "region_name"), ("icb_code", "icb_name"))[n % 2] for n in range(14, 20)},
}
query("snk2_publication", " UNION ALL ".join(_values_sql(n) for n in range(1, 21)))(_published)
query(
    "chk2_publications",
    "SELECT position, row_key, column_name, CAST(1 AS INTEGER) AS copy, CAST(NULL AS DOUBLE) AS old_value,"
    f" value AS new_value, false AS in_old, true AS in_new FROM ({_values_sql(3)} UNION ALL {_values_sql(17)})"
    " WHERE row_key LIKE '2001/2002%'",
)(_changed)


def _figure_file(s: Inputs):
    folder = run_folder(s.spark, "files/figure_04")
    figure = figures.figure_long(figures.BY_NUMBER[4], s.extracts(), s.params)
    write_csv(figure, folder)
    return s.spark.read.csv(folder, header=True, schema=figure.schema)


query("snk5_figure_file", BODIES["fig04_long"])(_figure_file)

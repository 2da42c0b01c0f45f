"""The sample data and the extracts, restated as SQL common table expressions.

``with_facts`` puts in front of a query those expressions it refers to.
"""

from __future__ import annotations

import re

from apothecary.schemas import MONEY, VOLUMES
from catalogue.measures_sql import MEASURES

MONEY_MEASURES = set(re.findall(r"AS DECIMAL\(28,2\)\) AS (\w+)", MEASURES))
NAMES = re.findall(r" AS (\w+),?$", MEASURES, flags=re.M)


def _hit(k: int) -> str:
    return f"(p + {k} * n) % {k + 5} = 0"


def _sums(keys: str) -> str:
    volumes = [
        f"CAST(count(*) FILTER (WHERE {_hit(k)}) AS BIGINT) AS {c}"
        for k, c in enumerate(VOLUMES[1:], start=2)
    ]
    money = [
        f"CAST(sum(price) FILTER (WHERE {_hit(k)}) AS DECIMAL(18,2)) AS {c}"
        for k, c in enumerate(MONEY[1:], start=2)
    ]
    return (
        f"SELECT {keys}, count(DISTINCT ym) AS months,"
        " CAST(sum(q) * (1 + (id * 7) % 97) AS BIGINT) AS ITEMS,"
        " CAST(sum(price) AS DECIMAL(18,2)) AS NIC, "
        + ", ".join(volumes + money)
        + f" FROM claims GROUP BY {keys}"
    )


def _kept(sums: str) -> str:
    return f"SELECT s.*, c.* EXCLUDE (id) FROM {sums} s JOIN contractors c USING (id)"


def _fact(kept: str, period: str, key: str) -> str:
    columns = ", ".join(f"k.{c}" for c in (*VOLUMES, *MONEY))
    return (
        f"SELECT k.id AS CONTRACTOR_ID, {period}, k.class AS APPLIANCE_DISPENSER_HIST,"
        " k.icb_code AS ICB_CODE, k.icb_name AS ICB_NAME, k.region_code AS REGION_CODE,"
        " k.region_name AS REGION_NAME, k.distance AS DIST_SELLING_DISPENSER_HIST,"
        " k.lps AS LPS_DISPENSER_HIST, k.start_text AS START_DATE_HIST,"
        " k.close_text AS CLOSE_DATE_HIST,"
        " CASE WHEN o.owned >= 6 THEN 'Multiple contractor' ELSE 'Independent' END"
        " AS CONTRACTOR_TYPE,"
        " CASE WHEN a.avg <= 2000 THEN '0 - 2000' WHEN a.avg <= 4000 THEN '2001 - 4000'"
        " WHEN a.avg <= 6000 THEN '4001 - 6000' WHEN a.avg <= 8000 THEN '6001 - 8000'"
        " WHEN a.avg <= 10000 THEN '8001 - 10000' ELSE '10000+' END AS MONTHLY_DISP_VOL_BAND,"
        f" a.avg AS AVG_MONTHLY_ITEMS, {columns}, k.opened, k.closed, k.y"
        f" FROM {kept} k"
        f" JOIN (SELECT {key}, owner, count(*) AS owned FROM {kept} GROUP BY {key}, owner) o"
        f" ON o.owner = k.owner AND o.{key} = k.{key},"
        " LATERAL (SELECT CAST(k.ITEMS AS DOUBLE) / k.months AS avg) a"
    )


def _prepared(fact: str, bound_year: str) -> str:
    return (
        "SELECT *, AUR_HOME + AUR_PREM AS AUR_ALL, NUM_AUR_HOME + NUM_AUR_PREM AS NUM_AUR_ALL,"
        f" make_date({bound_year}, 4, 1) AS first_day,"
        f" make_date({bound_year} + {1 if fact == 'year_fact' else 0}, 3, 31) AS last_day"
        f" FROM (SELECT * FROM {fact})"
    )


def median(x: str) -> str:
    """Exact median written out, so that the middle pair is averaged alike."""
    values = f"list({x} ORDER BY {x}) FILTER (WHERE {x} IS NOT NULL)"
    n = f"count({x})"
    return f"(({values})[({n} + 1) // 2] + ({values})[({n} + 2) // 2]) / 2"


def _extract(prepared: str, keys: str, consultations: str = "CPCS_FEES") -> str:
    dated = (
        MEASURES.replace("START_DATE_HIST >=", "opened >=")
        .replace("CLOSE_DATE_HIST <=", "closed <=")
        .replace("{MEDIAN}", median("AVG_MONTHLY_ITEMS"))
        .replace("{CONSULTATIONS}", f"count(*) FILTER (WHERE {consultations} > 0)")
    )
    key_columns = ", ".join(f"{k} AS {k.lower()}" for k in keys.split(", "))
    return f"SELECT {key_columns}, {dated.strip()} FROM {prepared} GROUP BY {keys}"


_NATIONAL = "FINANCIAL_YEAR, APPLIANCE_DISPENSER_HIST"
_YEARS = "CAST(k.y AS VARCHAR) || '/' || CAST(k.y + 1 AS VARCHAR) AS FINANCIAL_YEAR"
_FLU = ("num_flu_pharm", "flu_items_total", "flu_cost_total", "flu_fees_total")

# In order of dependence.
EXPRESSIONS = {
    "claims": (
        "SELECT l_suppkey AS id, year(l_shipdate - INTERVAL 3 MONTH) AS y,"
        " year(l_shipdate) * 100 + month(l_shipdate) AS ym, l_partkey AS p,"
        " l_linenumber AS n, l_shipdate AS shipped, l_orderkey AS orderkey,"
        " CAST(l_quantity AS BIGINT) AS q,"
        " CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem"
    ),
    "contractors": (
        "SELECT s_suppkey AS id,"
        " CASE WHEN s_suppkey % 3 = 0 THEN 'S' || s_suppkey ELSE 'G' || (s_suppkey % 5) END"
        " AS owner,"
        " CASE WHEN s_suppkey % 10 = 0 THEN 'Y' ELSE 'N' END AS class,"
        " CAST(n_nationkey AS VARCHAR) AS icb_code, n_name AS icb_name,"
        " CAST(r_regionkey AS VARCHAR) AS region_code, r_name AS region_name,"
        " CASE WHEN s_suppkey % 17 = 5 THEN 'Y' ELSE 'N' END AS distance,"
        " CASE WHEN s_suppkey % 19 = 7 THEN 'Y' ELSE 'N' END AS lps,"
        " make_date(1991 + s_suppkey % 9, 1 + s_suppkey % 12, 1 + s_suppkey % 28) AS opened,"
        " CASE WHEN s_suppkey % 6 = 0 THEN"
        " make_date(1997 + s_suppkey % 5, 1 + s_suppkey % 12, 1 + s_suppkey % 28) END AS closed,"
        " strftime(opened, '%d/%m/%Y') AS start_text,"
        " coalesce(strftime(closed, '%d/%m/%Y'), '31/12/9999') AS close_text"
        " FROM supplier JOIN nation ON s_nationkey = n_nationkey"
        " JOIN region ON n_regionkey = r_regionkey"
    ),
    "year_sums": _sums("id, y"),
    "month_sums": _sums("id, y, ym"),
    "year_kept": _kept("year_sums"),
    "month_kept": _kept("month_sums"),
    "year_fact": _fact("year_kept", _YEARS, "y"),
    "month_fact": _fact("month_kept", f"CAST(k.ym AS INTEGER) AS YEAR_MONTH, {_YEARS}", "ym"),
    "year_rows": _prepared("year_fact", "y"),
    "month_rows": _prepared("month_fact", "YEAR_MONTH // 100"),
    "national": _extract("year_rows", _NATIONAL),
    "monthly": _extract("month_rows", "YEAR_MONTH, APPLIANCE_DISPENSER_HIST", "CPCS_DRUGS"),
    "sub_national": _extract(
        "year_rows", _NATIONAL + ", ICB_CODE, ICB_NAME, REGION_CODE, REGION_NAME"
    ),
    "flu": (
        "SELECT financial_year, appliance_dispenser_hist, num_flu_pharm, flu_items_total,"
        " CAST(flu_cost_total AS DECIMAL(18,2)) AS flu_cost_total,"
        " CAST(flu_fees_total AS DECIMAL(18,2)) AS flu_fees_total"
        " FROM national"
    ),
    "with_flu": (
        "SELECT n.* EXCLUDE (" + ", ".join(_FLU) + "), "
        + ", ".join(f"n.{m} AS {m}_dwh" for m in _FLU)
        + ", "
        + ", ".join(
            f"CAST(f.{m} AS {'DECIMAL(28,2)' if m in MONEY_MEASURES else 'BIGINT'}) AS {m}_csv"
            for m in _FLU
        )
        + " FROM national n LEFT JOIN flu f ON"
        " n.financial_year IS NOT DISTINCT FROM f.financial_year AND"
        " n.appliance_dispenser_hist IS NOT DISTINCT FROM f.appliance_dispenser_hist"
    ),
    "decisions": (
        "SELECT year(o_orderdate - INTERVAL 3 MONTH) AS y,"
        " CAST(y AS VARCHAR) || '/' || CAST(y + 1 AS VARCHAR) AS financial_year,"
        " CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Controlled'"
        " ELSE 'Non-Controlled' END AS locality, o_orderstatus AS status FROM orders"
    ),
    "history_parts": (
        "SELECT financial_year, locality, CASE status WHEN 'F' THEN 'Application refused'"
        " WHEN 'O' THEN 'Application granted' WHEN 'P' THEN 'Remit back to NHSE' END"
        " AS application_decision, count(*) AS total_decisions"
        " FROM decisions WHERE y < 2001 GROUP BY ALL"
    ),
    "history": (
        "SELECT * FROM history_parts UNION ALL SELECT financial_year, 'Total',"
        " application_decision, CAST(sum(total_decisions) AS BIGINT) FROM history_parts"
        " GROUP BY financial_year, application_decision"
    ),
    "current_rows": (
        "SELECT financial_year, locality, CASE status WHEN 'F' THEN 'refused application'"
        " WHEN 'O' THEN 'granted application' ELSE 'remitted application' END"
        " AS application_decision, CAST(1 AS BIGINT) AS number"
        " FROM decisions WHERE y = 2001"
    ),
    "current_parts": (
        "SELECT financial_year, locality, CASE WHEN application_decision ="
        " 'refused application' THEN 'Application refused' ELSE 'Application granted' END"
        " AS application_decision, CAST(sum(number) AS BIGINT) AS total_decisions"
        " FROM current_rows GROUP BY ALL"
    ),
    "current_year": (
        "SELECT * FROM current_parts UNION ALL SELECT financial_year, 'Total',"
        " application_decision, CAST(sum(total_decisions) AS BIGINT) FROM current_parts"
        " GROUP BY financial_year, application_decision"
    ),
    "appeals": "SELECT * FROM history UNION ALL SELECT * FROM current_year",
}


def with_facts(body: str) -> str:
    """``body`` with the expressions it needs in front."""
    needed: set[str] = set()

    def look(text: str) -> None:
        for name, expression in EXPRESSIONS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                look(expression)

    look(body)
    ctes = [f"{n} AS MATERIALIZED ({e})" for n, e in EXPRESSIONS.items() if n in needed]
    if not ctes:
        return body
    body = body.strip()
    if body.startswith("WITH "):
        return "WITH " + ", ".join(ctes) + ", " + body[5:]
    return "WITH " + ", ".join(ctes) + " " + body


def strict(x: str, name: str) -> str:
    """A sum that one NULL makes NULL."""
    base = x.removesuffix("_csv")
    kind = "DECIMAL(28,2)" if base in MONEY_MEASURES else "BIGINT"
    return f"CAST(CASE WHEN count(*) = count({x}) THEN sum({x}) END AS {kind}) AS {name}"

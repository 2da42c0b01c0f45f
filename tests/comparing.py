"""Comparison of a query with its SQL over the same folder of tables."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return v.normalize() if v else decimal.Decimal(0)
    if isinstance(v, datetime.datetime):
        return v.date() if v.time() == datetime.time() else v
    return v


def _key(row):
    return [(v is None, type(v).__name__, str(v)) for v in row]


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    rows = [tuple(_plain(r[n]) for n in names) for r in df.collect()]
    return names, sorted(rows, key=_key)


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_plain(r[i]) for i in order) for r in result.fetchall()]
    return [columns[i] for i in order], sorted(rows, key=_key)


def difference(df, con, sql: str) -> str | None:
    """None when both sides are equal, else what differs first."""
    names, got = spark_rows(df)
    wanted_names, wanted = sql_rows(con, sql)
    if names != wanted_names:
        return f"columns {sorted(set(names) ^ set(wanted_names))}"
    if len(got) != len(wanted):
        return f"{len(got)} rows, expected {len(wanted)}"
    for a, b in zip(got, wanted):
        if a != b:
            at = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
            return f"{at[:4]}"
    return None

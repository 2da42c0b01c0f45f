"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from apothecary.plans.tables import Extracts, extracts_of
from apothecary.sources.sample import Sample
from catalogue.sql import with_facts

Build = Callable[["Inputs"], DataFrame]
QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}
# The SQL as written, without the expressions put in front.
BODIES: dict[str, str] = {}


class Inputs(Sample):
    """The sample data of one folder, with the extracts the plans ask for."""

    def extracts(self) -> Extracts:
        return extracts_of(self.year_fact(), self.flu_reference(), self.params)

    def monthly_extracts(self) -> Extracts:
        return extracts_of(self.month_fact(), None, self.params)


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query under ``name``, checked by ``sql`` over the same tables."""

    def add(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            BODIES[name] = sql
            ORACLES[name] = with_facts(sql)
        return build

    return add


def runnable(build: Build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: build(Inputs(spark, folder))

"""Facts kept up to date: only partitions that changed claims reach are written again.

Beside the facts lies a state: the claim files of the last run with the months each has
claims of, and a digest of contractors and their history. A run lists the files; months of
files that came, went or were rewritten are read again, from the whole folder but for those
months only, and replace their partitions. Years follow the months in them. Without a
state, or with other contractors or history, everything is built.

The state is written last and under a new number. A run that fails leaves the old one, so
the next run takes up the same months again; replacing a partition twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from apothecary.functions.scalars import month_key
from apothecary.operators.checks import SEEN, seen, watched
from apothecary.operators.digests import digest
from apothecary.params import BANDS, ReportParams
from apothecary.plans import facts
from apothecary.plans.extracts import median_values
from apothecary.schemas import ACTIVITY, ATTRIBUTE_HISTORY, CLAIMS, CLASS, CONTRACTORS, YEAR_FACT
from apothecary.sources.warehouse import read_fact

# Stands for claims without a date.
NO_MONTH = -1
YEAR, MONTH = ("FINANCIAL_YEAR",), ("FINANCIAL_YEAR", "YEAR_MONTH")
LISTED = {CLASS: ("Y", "N"), "CONTRACTOR_TYPE": ("Independent", "Multiple contractor"), "MONTHLY_DISP_VOL_BAND": BANDS}
FILES = "path string, length bigint, modified timestamp, months array<int>"
INPUTS = "inputs string"


@dataclass(frozen=True)
class Refreshed:
    """What a run did: whether it built all, and the months it read again."""

    whole: bool
    months: tuple[int, ...]


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """Path, length and time of the folder's Parquet files; their content is not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    return reader.load(folder).select(_plain("path"), "length", F.col("modificationTime").alias("modified"))


def _plain(path: str) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/").alias("path")


def _month() -> Column:
    return F.coalesce(month_key(F.col("CLAIM_DATE")), F.lit(NO_MONTH))


def _months_of(claims: DataFrame) -> DataFrame:
    """The months each file has claims of, from one column of the files."""
    seen = claims.select(_plain("_metadata.file_path"), _month().alias("month")).distinct()
    return seen.groupBy("path").agg(F.array_sort(F.collect_set("month")).alias("months"))


def _paths(files: DataFrame) -> list[str]:
    return [r["path"] for r in files.select("path").collect()]


def _in_months(months: Iterable[int]) -> Column:
    """Claims of some months, as ranges of dates that reach the scan."""
    found = F.lit(False)
    for m in months:
        if m == NO_MONTH:
            found = found | F.col("CLAIM_DATE").isNull()
        else:
            year, month = divmod(m, 100)
            first, last = date(year, month, 1), date(year + month // 12, month % 12 + 1, 1)
            found = found | (F.col("CLAIM_DATE") >= F.lit(first)) & (F.col("CLAIM_DATE") < F.lit(last))
    return found


class Facts:
    """The facts of one folder: ``sums``, ``months``, ``years``, ``values`` and the state of the last run."""

    def __init__(self, spark: SparkSession, folder: str, params: ReportParams = ReportParams()) -> None:
        self.spark, self.folder, self.params = spark, folder, params
        context = spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(folder).getFileSystem(context._jsc.hadoopConfiguration())

    # -- state --------------------------------------------------------------

    def _runs(self) -> list[int]:
        """Numbers of complete states."""
        state = self._path(f"{self.folder}/state")
        if not self._system.exists(state):
            return []
        numbers = [int(s.getPath().getName()) for s in self._system.listStatus(state)]
        return sorted(n for n in numbers if self._system.exists(self._path(f"{self.folder}/state/{n}/inputs/_SUCCESS")))

    def _keep(self, files: DataFrame, inputs: str) -> None:
        runs = self._runs()
        number = runs[-1] + 1 if runs else 0
        files.write.mode("overwrite").parquet(f"{self.folder}/state/{number}/files")
        self.spark.createDataFrame([(inputs,)], INPUTS).write.mode("overwrite").parquet(f"{self.folder}/state/{number}/inputs")

    # -- partitions ------------------------------------------------------------

    def checks(self, table: str) -> DataFrame:
        """Completeness and categories of what the last run wrote of a fact, counted as it was written."""
        return self.spark.read.schema(SEEN).parquet(f"{self.folder}/checks/{table}")

    def _replace(self, df: DataFrame, table: str, by: tuple[str, ...], listed: dict[str, Sequence[str]] | None = None) -> None:
        """The partitions ``df`` has rows of; others stay. With ``listed``, what passes is counted."""
        if listed is not None:
            df, observed = watched(df, listed)
        self._write(df, table, by)
        if listed is not None:
            seen(self.spark, observed).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/checks/{table}")

    def _write(self, df: DataFrame, table: str, by: tuple[str, ...]) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{self.folder}/{table}")

    def _drop_empty(self, months: Iterable[int], have: set[int]) -> None:
        """Partitions of those ``months`` that have no claims any more, and of years without months."""
        empty = sorted(set(months) - have)
        for m in empty:
            for table in ("sums", "months"):
                self._delete(f"{table}/{self._named('FINANCIAL_YEAR', self._year(m))}/{self._named('YEAR_MONTH', None if m == NO_MONTH else m)}")
        if empty:
            years = {r["FINANCIAL_YEAR"] for r in self._sums().select("FINANCIAL_YEAR").distinct().collect()}
            for year in {self._year(m) for m in empty} - years:
                for table in ("sums", "months", "years", "values"):
                    self._delete(f"{table}/{self._named('FINANCIAL_YEAR', year)}")

    def _delete(self, place: str) -> None:
        self._system.delete(self._path(f"{self.folder}/{place}"), True)

    @staticmethod
    def _named(column: str, value: object) -> str:
        """A partition's folder, in Spark's spelling."""
        return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else str(value).replace('/', '%2F')}"

    @staticmethod
    def _year(month: int) -> str | None:
        if month == NO_MONTH:
            return None
        start = month // 100 - (month % 100 < 4)
        return f"{start}/{start + 1}"

    def _sums(self) -> DataFrame:
        return read_fact(self.spark, f"{self.folder}/sums", ACTIVITY)

    # -- runs ----------------------------------------------------------------------

    def refresh(self, claims: str, contractors: str, history: str | None = None) -> Refreshed:
        """Bring the facts up to the claims in the folder ``claims``."""
        spark, runs = self.spark, self._runs()
        known = read_fact(spark, contractors, CONTRACTORS)
        changes = read_fact(spark, history, ATTRIBUTE_HISTORY) if history else None
        # What a fact depends on beside claims.
        inputs = repr((self.params, *[tuple(digest(df).first()) for df in (known, changes) if df is not None]))
        now = _files(spark, claims)
        lines = read_fact(spark, claims, CLAIMS)
        before = spark.read.parquet(f"{self.folder}/state/{runs[-1]}/files") if runs else None
        whole = before is None or spark.read.parquet(f"{self.folder}/state/{runs[-1]}/inputs").first()["inputs"] != inputs
        if whole:
            for table in ("sums", "months", "years", "values"):
                self._delete(table)
            months: list[int] | None = None
            files = now.join(_months_of(lines), "path", "left")
        else:
            same = ["path", "length", "modified"]
            gone = before.join(now, same, "left_anti")
            came = now.join(before, same, "left_anti")
            # No more paths than files that changed.
            paths = _paths(came)
            found = _months_of(read_fact(spark, paths, CLAIMS)) if paths else None
            came = came.join(found, "path", "left") if paths else came.withColumn("months", F.lit(None).cast("array<int>"))
            touched = gone.select("months").unionByName(came.select("months"))
            months = sorted(r["m"] for r in touched.select(F.explode("months").alias("m")).distinct().collect())
            files = before.join(now, same, "left_semi").unionByName(came.select(*before.columns))
            if not paths and gone.isEmpty():
                return Refreshed(False, ())
        self._build(lines, known, changes, months)
        self._keep(files.select("path", "length", "modified", "months"), inputs)
        return Refreshed(whole, tuple(months or ()))

    def _build(self, lines: DataFrame, known: DataFrame, changes: DataFrame | None, months: list[int] | None) -> None:
        """All months, or those named and the years they are in."""
        if months is None:
            self._replace(facts.month_sums(lines, known), "sums", MONTH)
        else:
            # Written apart first, which tells the months that are left.
            staged = f"{self.folder}/staged"
            facts.month_sums(lines.where(_in_months(months)), known).write.mode("overwrite").parquet(staged)
            changed = read_fact(self.spark, staged, ACTIVITY)
            have = {NO_MONTH if r[0] is None else r[0] for r in changed.select("YEAR_MONTH").distinct().collect()}
            self._replace(changed, "sums", MONTH)
            self._drop_empty(months, have)
            self._delete("staged")
        sums = self._sums()
        by_month = by_year = sums
        if months is not None:
            years = sorted({y for m in months if (y := self._year(m)) is not None})
            no_year = F.col("FINANCIAL_YEAR").isNull() if NO_MONTH in months else F.lit(False)
            by_year = sums.where(F.col("FINANCIAL_YEAR").isin(years) | no_year)
            by_month = by_year.where(F.coalesce("YEAR_MONTH", F.lit(NO_MONTH)).isin(months))
        held = known if changes is None else facts.held_by_year(known, changes, by_year)
        self._replace(facts.year_fact(by_year, held, self.params), "years", YEAR, LISTED)
        self._replace(facts.month_fact(by_month, held, self.params), "months", MONTH, LISTED)
        years_now = read_fact(self.spark, f"{self.folder}/years", YEAR_FACT)
        if months is not None:
            years_now = years_now.where(F.col("FINANCIAL_YEAR").isin(years) | no_year)
        self._replace(median_values(years_now), "values", YEAR)

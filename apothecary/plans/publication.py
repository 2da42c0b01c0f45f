"""A whole publication: every table and figure, written to one folder."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from apothecary.params import ReportParams
from apothecary.plans import figures, tables
from apothecary.plans.appeals import table_20
from apothecary.plans.extracts import MONTHLY, NATIONAL, SUB_NATIONAL, both_grains, extract
from apothecary.plans.flu import with_flu_reference
from apothecary.plans.measures import BY_NAME
from apothecary.plans.tables import TITLES, Extracts
from apothecary.schemas import GEOGRAPHY
from apothecary.sinks.bundle import Bundle, unequal
from apothecary.sinks.files import with_titles, write_csv, write_table
from apothecary.sources.reference import fee_schedule

ALL_TABLES = tuple(range(1, 21))
VALUES = "position int, row_key string, column_name string, value double"

# Notes printed below a table, by table number.
_MULTIPLE = "An owner with six or more pharmacies counts as a multiple contractor."
_ACTIVE = "Pharmacies are counted if they submitted a prescription at any time in the year."
_BLANK = "Cells are empty for years in which a service was not offered."
NOTES: dict[int, tuple[str, ...]] = {
    2: (_ACTIVE, _MULTIPLE),
    4: (_ACTIVE, "A band is the year's items divided by the months a pharmacy was active."),
    5: (_ACTIVE, _BLANK),
    6: (_BLANK,),
    9: (_BLANK,),
    14: (_ACTIVE, _MULTIPLE),
    15: (_ACTIVE, _MULTIPLE),
    20: ("Decisions not made in a year are shown as 0.",),
}

# The field dictionary: names are fixed, descriptions are ours.
FIELDS = (
    ("AUR", "Appliance use review: a review of how a patient uses an appliance."),
    ("Average monthly items per pharmacy",
     "Median over pharmacies of the year's items divided by months active."),
    ("Community Pharmacy Home Delivery Services",
     "Deliveries to patients at home during the pandemic."),
    ("Contractor Type", "Community pharmacy or appliance contractor."),
    ("Controlled / Non-controlled area", "Rural area by designation, or not."),
    ("Cost", "Basic price of the items dispensed, without fees or charges."),
    ("Covid-19 Lateral Flow Device Distribution Service",
     "Supply of rapid test kits through pharmacies."),
    ("COVID-19 vaccination enhanced service", "Pandemic vaccinations given by pharmacies."),
    ("CPCS", "Consultations for minor illness or urgent supply on referral."),
    ("DMS", "Help with medicines for patients discharged from hospital."),
    ("EPS", "Prescriptions sent to the dispenser electronically."),
    ("Fee", "Amount paid to a contractor for dispensing or for a service."),
    ("Financial Year", "April of the first year named to March of the second."),
    ("Hepatitis C testing service", "Tests for the virus offered by pharmacies."),
    ("Hypertension Case-Finding", "Blood pressure checks offered by pharmacies."),
    ("Integrated Care Board Name", "Name of the local board a contractor belongs to."),
    ("Integrated Care Board Code", "Code of the local board a contractor belongs to."),
    ("Item", "One product on one prescription form."),
    ("MUR", "Review of a patient's use of several medicines; since discontinued."),
    ("NHS England Region Name", "Name of the region a contractor belongs to."),
    ("NHS England Region Code", "Code of the region a contractor belongs to."),
    ("NMS", "Support for patients who start a new medicine."),
    ("PCS", "Supply of oral contraception by pharmacies."),
    ("Pharmacy First", "Advice and treatment for seven common conditions."),
    ("SAC", "Fitting of stoma appliances to the patient."),
    ("Seasonal influenza vaccination advanced service", "Flu vaccinations by pharmacies."),
    ("SCS", "Support to stop smoking after a stay in hospital."),
)


@dataclass(frozen=True)
class Kept:
    """Extracts by grain, and the frames Spark holds for them."""

    by_grain: dict[tuple[str, ...], DataFrame]
    held: tuple[DataFrame, ...]

    def __call__(self, grain: tuple[str, ...], measures: list[str]) -> DataFrame:
        return self.by_grain[grain]

    def release(self) -> None:
        for df in self.held:
            df.unpersist()


@dataclass(frozen=True)
class Publication:
    """The inputs of a run: facts, reference data and settings."""

    spark: SparkSession
    year_fact: DataFrame
    month_fact: DataFrame
    flu: DataFrame
    appeals_history: DataFrame
    appeals_current: DataFrame
    params: ReportParams
    # Counts written beside the year fact; without them they are made from it.
    year_values: DataFrame | None = None

    def extracts(self) -> Kept:
        """Full extracts, computed once and kept for all tables and figures.

        The year fact is read once for both of its grains; its median comes from
        the counts beside it. What is kept is a row per period, class and
        area, however large the facts.
        """
        both = both_grains(self.year_fact, self.params, self.year_values).persist()
        months = extract(self.month_fact, MONTHLY, self.params).persist()
        # Computed before several threads read them, so that none computes them again.
        for kept in (both, months):
            kept.write.format("noop").mode("overwrite").save()
        national = both.where("grain = 'national'").drop(
            "grain", *[k.lower() for k in GEOGRAPHY]
        )
        return Kept(
            {
                NATIONAL: with_flu_reference(national, self.flu, self.params),
                SUB_NATIONAL: both.where("grain = 'sub_national'").drop("grain"),
                MONTHLY: months,
            },
            (both, months),
        )

    def table(self, number: int, extracts: Extracts) -> DataFrame:
        if number == 20:
            return table_20(self.appeals_history, self.appeals_current)
        return tables.table(number, extracts, self.params)

    def publish(self, folder: str, numbers: tuple[int, ...] = ALL_TABLES, with_figures: bool = True) -> str:
        """Tables and figures as a new version of the bundle ``folder``; gives the version's folder.

        Readers get it, by ``Bundle.current``, when all of it is written. What was kept for it is let go again.
        """
        bundle = Bundle(self.spark, folder)
        staged = bundle.stage()
        extracts = self.extracts()
        try:
            self.publish_tables(f"{staged}/tables", extracts, numbers)
            if with_figures:
                self.publish_figures(f"{staged}/figures", extracts)
        finally:
            extracts.release()
        bundle.commit(staged)
        return staged

    def publish_tables(
        self, folder: str, extracts: Extracts, numbers: tuple[int, ...] = ALL_TABLES
    ) -> None:
        """Each table as Parquet and CSV, with field dictionary and contents.

        The CSV is written from the Parquet file, so that no table is computed
        twice. Tables are small and independent; some are written at a time.
        """

        def publish(n: int) -> None:
            path = f"{folder}/table_{n:02d}"
            frame = self.table(n, extracts)
            write_table(with_titles(frame, column_titles(frame.columns)), f"{path}/parquet")
            write_csv(self.spark.read.parquet(f"{path}/parquet"), f"{path}/csv")

        _several_at_a_time(publish, numbers)
        write_csv(field_dictionary(self.spark), f"{folder}/fields")
        write_csv(contents(self.spark), f"{folder}/contents")

    def publish_figures(self, folder: str, extracts: Extracts) -> None:
        """The long and the wide data of each figure as CSV."""

        def publish(spec: figures.FigureSpec) -> None:
            long = figures.figure_long(spec, extracts, self.params)
            wide = figures.figure_wide(spec, extracts, self.params)
            write_csv(long, f"{folder}/{spec.name}/long")
            write_csv(wide, f"{folder}/{spec.name}/wide")

        _several_at_a_time(publish, figures.SPECS)
        write_csv(figures.fee_display(fee_schedule(self.spark)), f"{folder}/figure_19")


def _several_at_a_time(work, items) -> None:
    with ThreadPoolExecutor(max_workers=8) as pool:
        list(pool.map(work, items))


def column_titles(columns: list[str]) -> dict[str, str]:
    """Titles of measure columns, said by their rules."""
    out = {}
    for c in columns:
        measure = BY_NAME.get(c.removesuffix("_csv"))
        out[c] = measure.title if measure else c.replace("_", " ").capitalize()
    return out


def field_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(FIELDS), "field string, description string")


def contents(spark: SparkSession) -> DataFrame:
    """The list of sheets: the field dictionary, then tables with title and notes."""
    rows = [(0, "Metadata", "")] + [
        (n, f"Table {n}: {TITLES[n]}", " ".join(NOTES.get(n, ()))) for n in ALL_TABLES
    ]
    return spark.createDataFrame(rows, "position int, title string, notes string")


def published_values(spark: SparkSession, folder: str, numbers: Sequence[int] = ALL_TABLES) -> DataFrame:
    """Every value of the written tables: position, row_key, column_name, value.

    A row is named by its text columns, in order, with a bar between them.
    """
    values = None
    for n in numbers:
        table = spark.read.parquet(f"{folder}/table_{n:02d}/parquet")
        texts = [c for c, kind in table.dtypes if kind == "string"]
        measured = [F.col(c).cast("double").alias(c) for c in table.columns if c not in texts]
        rows = table.select(F.lit(n).alias("position"), F.concat_ws("|", *texts).alias("row_key"), *measured)
        long = rows.unpivot(["position", "row_key"], None, "column_name", "value")
        values = long if values is None else values.unionAll(long)
    return values


def changed_values(spark: SparkSession, old: str, new: str) -> DataFrame:
    """Every value of the tables that differs between two versions of a bundle.

    The manifests tell which tables differ at all; the others are not read. A value
    that one version doesn't have is NULL there, with ``in_old`` or ``in_new`` false. Rows of
    one name are matched in order of their values.
    """
    bundle = Bundle(spark, old)
    names = [r["name"] for r in unequal(bundle.manifest(old), bundle.manifest(new)).where("name LIKE 'tables/table%'").collect()]
    numbers = sorted(int(n.rsplit("_", 1)[1]) for n in names)
    sides = []
    for version, side in ((old, "old"), (new, "new")):
        have = {r["name"] for r in bundle.manifest(version).select("name").collect()}
        there = [n for n in numbers if f"tables/table_{n:02d}" in have]
        values = published_values(spark, f"{version}/tables", there) if there else spark.createDataFrame([], VALUES)
        same = Window.partitionBy("position", "row_key", "column_name").orderBy("value")
        sides.append(values.select(
            "position", "row_key", "column_name", F.row_number().over(same).alias("copy"), F.col("value").alias(f"{side}_value"), F.lit(True).alias(f"in_{side}")))
    both = sides[0].join(sides[1], ["position", "row_key", "column_name", "copy"], "full_outer")
    flags = [F.coalesce(f"in_{side}", F.lit(False)).alias(f"in_{side}") for side in ("old", "new")]
    found = both.select("position", "row_key", "column_name", "copy", "old_value", "new_value", *flags)
    return found.where(~F.col("old_value").eqNullSafe(F.col("new_value")) | ~F.col("in_old") | ~F.col("in_new"))

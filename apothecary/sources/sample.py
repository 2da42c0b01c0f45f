"""The given star-schema tables, read as dispensing data.

A line item is a claim line, a supplier a contractor, nations and regions are
the two geographies, orders are appeal decisions. The rules are fixed so that
an SQL query over the same tables can restate them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apothecary.functions.scalars import financial_year_label, financial_year_start, month_key
from apothecary.operators import fact
from apothecary.params import DECISIONS, GRANTED, LOCALITIES, REFUSED, ReportParams
from apothecary.plans.appeals import KEYS, with_total_rows
from apothecary.schemas import (
    ACTIVITY,
    CLASS,
    CONTRACTORS,
    MONEY,
    MONTH_FACT,
    VOLUMES,
    YEAR_FACT,
    YEAR_VALUES,
    require,
)
from apothecary.session import configure, input_version, written_once

# Claim lines added up in one task; each may become a fact row of 1.3 KB.
LINES_A_TASK = 200_000
FACT_TABLES = ("lineitem", "supplier", "nation", "region")
SAMPLE_PARAMS = ReportParams(
    latest_year="2001/2002",
    pandemic_excluded_years=(
        "1994/1995", "1995/1996", "1996/1997", "1997/1998", "1998/1999",
    ),
    consultation_excluded_years=("1994/1995", "1995/1996", "1996/1997", "1997/1998"),
    smoking_years=("2000/2001", "2001/2002"),
    contraception_after_month=200103,
)


@dataclass(frozen=True)
class Sample:
    """Dispensing inputs derived from one folder of tables."""

    spark: SparkSession
    folder: str
    params: ReportParams = field(default=SAMPLE_PARAMS)

    def __post_init__(self) -> None:
        configure(self.spark)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- claims and contractors ------------------------------------------

    def _version(self) -> str:
        """Names the input that the written facts stem from."""
        return input_version(self.spark, self.folder, FACT_TABLES)

    def claims(self, dealt: bool = False) -> DataFrame:
        """One row per claim line, with what it adds to every fact column.

        Amounts are whole pence. ``dealt`` lines are shuffled by contractor and month
        while they are a few numbers wide, to as many tasks as their count asks for: what
        a task adds up then does not depend on how large a piece of a file it is given, and
        the sums of sixty columns need no shuffle any more.
        """
        lines = self.table("lineitem").selectExpr(
            "l_suppkey AS CONTRACTOR_ID",
            "to_date(l_shipdate) AS CLAIM_DATE",
            "l_partkey AS part",
            "l_linenumber AS line",
            "cast(l_quantity AS bigint) AS quantity",
            "cast(cast(l_extendedprice AS decimal(18,2)) * 100 AS bigint) AS pence",
        )
        if dealt:
            tasks = max(1, -(-lines.count() // LINES_A_TASK))
            lines = lines.repartition(tasks, "CONTRACTOR_ID", month_key(F.col("CLAIM_DATE")))

        def hit(k: int) -> str:
            return f"(part + {k} * line) % {k + 5} = 0"

        return lines.selectExpr(
            "CONTRACTOR_ID",
            "CLAIM_DATE",
            "quantity * (1 + (CONTRACTOR_ID * 7) % 97) AS ITEMS",
            *[
                f"cast({hit(k)} AS bigint) AS {name}"
                for k, name in enumerate(VOLUMES[1:], start=2)
            ],
            "pence AS NIC",
            *[
                f"CASE WHEN {hit(k)} THEN pence END AS {name}"
                for k, name in enumerate(MONEY[1:], start=2)
            ],
        )

    def contractors(self) -> DataFrame:
        """Contractors with attributes, written once so that their size is known."""
        return written_once(
            self.spark, "contractors", self.folder, self._contractors, CONTRACTORS,
            version=self._version(),
        )

    def _contractors(self) -> DataFrame:
        key = F.col("s_suppkey")
        month = (1 + key % 12).cast("int")
        day = (1 + key % 28).cast("int")
        opened = F.make_date((1991 + key % 9).cast("int"), month, day)
        closed = F.when(key % 6 == 0, F.make_date((1997 + key % 5).cast("int"), month, day))
        yes_no = lambda condition: F.when(condition, "Y").otherwise("N")
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                key.alias("CONTRACTOR_ID"),
                F.when(key % 3 == 0, F.concat(F.lit("S"), key.cast("string")))
                .otherwise(F.concat(F.lit("G"), (key % 5).cast("string")))
                .alias("OWNER_ID"),
                yes_no(key % 10 == 0).alias(CLASS),
                F.col("n_nationkey").cast("string").alias("ICB_CODE"),
                F.col("n_name").alias("ICB_NAME"),
                F.col("r_regionkey").cast("string").alias("REGION_CODE"),
                F.col("r_name").alias("REGION_NAME"),
                yes_no(key % 17 == 5).alias("DIST_SELLING_DISPENSER_HIST"),
                yes_no(key % 19 == 7).alias("LPS_DISPENSER_HIST"),
                F.date_format(opened, "dd/MM/yyyy").alias("START_DATE_HIST"),
                F.coalesce(F.date_format(closed, "dd/MM/yyyy"), F.lit("31/12/9999")).alias(
                    "CLOSE_DATE_HIST"
                ),
            )
        )

    # -- facts ------------------------------------------------------------

    def activity(self) -> DataFrame:
        """Contractor months, written once: claims are scanned a single time."""
        return written_once(
            self.spark,
            "contractor_months",
            self.folder,
            lambda: fact.contractor_months(self.claims(dealt=True)),
            ACTIVITY,
            "FINANCIAL_YEAR",
            version=self._version(),
            sized=False,
        )

    def _fact(self, activity: DataFrame, period: tuple[str, ...]) -> DataFrame:
        return fact.contractor_fact(activity, self.contractors(), period, self.params)

    def year_fact_from(self, activity: DataFrame) -> DataFrame:
        return require(self._fact(fact.contractor_years(activity), fact.YEAR), YEAR_FACT)

    def month_fact(self) -> DataFrame:
        """Contractor months with attributes, written once like the years."""
        return written_once(
            self.spark,
            "contractor_month_rows",
            self.folder,
            lambda: require(self._fact(self.activity(), fact.MONTH), MONTH_FACT),
            MONTH_FACT,
            "FINANCIAL_YEAR",
            self.params,
            self._version(),
            sized=False,
        )

    def year_fact(self) -> DataFrame:
        """Contractor years, written once as a table partitioned by year."""
        return written_once(
            self.spark,
            "contractor_years",
            self.folder,
            lambda: self.year_fact_from(self.activity()),
            YEAR_FACT,
            "FINANCIAL_YEAR",
            self.params,
            self._version(),
            sized=False,
        )

    def year_values(self) -> DataFrame:
        """Counts of the median's values, written once beside the years."""
        from apothecary.plans.extracts import median_values

        return written_once(
            self.spark,
            "contractor_year_values",
            self.folder,
            lambda: require(median_values(self.year_fact()), YEAR_VALUES),
            YEAR_VALUES,
            "FINANCIAL_YEAR",
            self.params,
            self._version(),
            sized=False,
        )

    # -- reference data -----------------------------------------------------

    def flu_reference(self) -> DataFrame:
        """Flu measures by year and class."""
        from apothecary.plans.extracts import NATIONAL, extract

        names = ("num_flu_pharm", "flu_items_total", "flu_cost_total", "flu_fees_total")
        flu = extract(self.year_fact(), NATIONAL, self.params, names)
        return flu.select(
            F.col("financial_year").alias("FINANCIAL_YEAR"),
            F.col(CLASS.lower()).alias(CLASS),
            "num_flu_pharm",
            "flu_items_total",
            F.col("flu_cost_total").cast("decimal(18,2)").alias("flu_cost_total"),
            F.col("flu_fees_total").cast("decimal(18,2)").alias("flu_fees_total"),
        )

    def _decisions(self) -> DataFrame:
        start = financial_year_start(F.to_date("o_orderdate"))
        urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        return self.table("orders").select(
            start.alias("start"),
            financial_year_label(start).alias("financial_year"),
            F.when(urgent, LOCALITIES[0]).otherwise(LOCALITIES[1]).alias("locality"),
            F.col("o_orderstatus").alias("status"),
        )

    def appeals_history(self) -> DataFrame:
        """Published decisions of earlier years, Total rows included."""
        status = F.col("status")
        decision = (
            F.when(status == "F", REFUSED).when(status == "O", GRANTED).when(
                status == "P", DECISIONS[-1]
            )
        )
        earlier = self._decisions().where(
            F.col("financial_year") < self.params.latest_year
        ).withColumn("application_decision", decision)
        parts = earlier.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("decisions"))
        return with_total_rows(parts, "decisions")

    def appeals_current(self) -> DataFrame:
        """Undigested decisions of the latest year."""
        return (
            self._decisions()
            .where(F.col("financial_year") == self.params.latest_year)
            .select(
                "financial_year",
                "locality",
                F.when(F.col("status") == "F", "refused application")
                .when(F.col("status") == "O", "granted application")
                .otherwise("remitted application")
                .alias("application_decision"),
                F.lit(1).cast("bigint").alias("number"),
            )
        )

    def fees(self) -> DataFrame:
        """A fee schedule with date text, one fee per order priority and year."""
        return (
            self.table("orders")
            .groupBy(
                F.col("o_orderpriority").alias("fee_name"), F.year("o_orderdate").alias("year")
            )
            .agg(
                (F.count(F.lit(1)) % 200).cast("int").alias("fee_value_pence"),
                F.date_format(F.min("o_orderdate"), "dd MMM yyyy").alias("fee_start"),
                F.date_format(F.max("o_orderdate"), "dd MMM yyyy").alias("fee_end"),
            )
            .drop("year")
        )

    def attribute_history(self) -> DataFrame:
        """Changes of a contractor attribute, one per claim line."""
        return self.table("lineitem").select(
            F.col("l_suppkey").alias("CONTRACTOR_ID"),
            F.to_date("l_shipdate").alias("EFFECTIVE_DATE"),
            F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag").alias(
                "SEQUENCE"
            ),
            F.col("l_returnflag").alias("STATE"),
        )

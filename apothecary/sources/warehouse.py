"""Facts read from where they are kept: a partitioned table or a database."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

from apothecary.schemas import require


def read_fact(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """A fact kept as Parquet, one folder or some files, with the declared schema."""
    return spark.read.schema(schema).parquet(*([path] if isinstance(path, str) else path))


@dataclass(frozen=True)
class JdbcTable:
    """A database table read in parallel slices of a numeric column.

    ``properties`` hold driver and credentials. Filters and column choices of
    a query are pushed into the database. Slices run from the smallest to the
    largest value the table has, asked for first unless given.
    """

    url: str
    table: str
    slice_column: str = "CONTRACTOR_ID"
    lower: int | None = None
    upper: int | None = None
    slices: int = 64
    fetch_size: int = 10_000
    properties: dict[str, str] = field(default_factory=dict)

    def connection(self) -> dict[str, str]:
        return {"url": self.url, "fetchsize": str(self.fetch_size), **self.properties}

    def bounds_query(self) -> str:
        c = self.slice_column
        return f"SELECT min({c}) AS low, max({c}) AS high FROM {self.table}"

    def sliced(self, low: int | None, high: int | None) -> dict[str, str]:
        """Options of a read in slices; of a plain one for a table without rows."""
        options = self.connection() | {"dbtable": self.table}
        if low is None or high is None:
            return options
        # The upper bound belongs to the last slice, which is open anyway.
        return options | {
            "partitionColumn": self.slice_column,
            "lowerBound": str(low),
            "upperBound": str(max(high, low + 1)),
            "numPartitions": str(max(1, min(self.slices, high - low + 1))),
        }

    def bounds(self, spark: SparkSession) -> tuple[int | None, int | None]:
        if self.lower is not None and self.upper is not None:
            return self.lower, self.upper
        row = spark.read.format("jdbc").options(**self.connection(), query=self.bounds_query()).load().first()
        return tuple(None if v is None else int(v) for v in (row["low"], row["high"]))

    def reader(self, spark: SparkSession) -> DataFrameReader:
        return spark.read.format("jdbc").options(**self.sliced(*self.bounds(spark)))

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        return require(self.reader(spark).load(), schema)

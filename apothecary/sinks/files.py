"""Tables and figures as files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_titles(df: DataFrame, titles: dict[str, str]) -> DataFrame:
    """Column titles kept in the schema, from where Parquet files carry them."""
    return df.select(
        *[F.col(c).alias(c, metadata={"title": titles.get(c, c)}) for c in df.columns]
    )


def write_csv(df: DataFrame, path: str) -> None:
    """A summary table or figure as one CSV file.

    Only for report output: a few rows per year and area. Extract and fact
    dumps go through ``write_rows``.
    """
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_rows(df: DataFrame, path: str) -> None:
    """Rows of any number as CSV, written by all tasks."""
    df.write.mode("overwrite").csv(path, header=True)


def write_table(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").parquet(path)

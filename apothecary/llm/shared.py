"""Tables written for one job in the folder that driver and executors share."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from apothecary.session import run_folder


# Rows of an Arrow batch. Texts are long, and a batch is held in the JVM and in Python.
BATCH_ROWS = "1000"


def small_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches to ``BATCH_ROWS``, also for later queries."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def stored(df: DataFrame, name: str, instead: DataFrame | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    This cuts the lineage: a lost executor costs tasks that read the table,
    not the work behind it. Each call writes a folder of its own. Shuffle files
    of earlier steps go when the driver collects its garbage, so it does that first.
    ``instead`` is an earlier result that nothing reads once this one is written, as in
    rounds of one table; its folder is deleted then.
    """
    spark = df.sparkSession
    small_batches(spark)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    path = f"{run_folder(spark, 'llm')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    if instead is not None:
        _delete(spark, instead.stored_at)
    return out


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Delete what ``stored`` wrote in this application. No earlier result may be read after it."""
    _delete(spark, run_folder(spark, "llm"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")

"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from threading import RLock as Lock
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from apothecary.sources.warehouse import read_fact

_written: dict[tuple[str, ...], str] = {}
_writing = Lock()


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings the queries rely on, set in the caller's session; cluster
    sizing is left alone. Dates of claims are read in UTC, and skewed joins are
    left to adaptive execution, so these two are set whatever they were.

    Fact rows carry more than sixty summed columns. Generated methods above
    8000 bytecodes are never compiled by the JVM, so such stages run faster in
    several smaller methods: half the time for the month sums.

    A shuffle file holds such rows at a tenth of what they take in a task that adds up,
    joins or sorts them: partitions that adaptive execution puts together by size of file
    are kept to some 60,000 fact rows, at 1.3 KB each.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    # Quantile sketches are small; some hundred groups of them may stay hashed.
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "1024")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else the warehouse.

    Both are places the driver and all executors see.
    """
    named = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", ""
    )
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def run_folder(spark: SparkSession, name: str) -> str:
    """A folder inside the shared one, private to this application."""
    return f"{shared_folder(spark)}/apothecary/{spark.sparkContext.applicationId}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of its own in the shared folder: later plans read it, none repeats the work."""
    path = f"{run_folder(df.sparkSession, 'steps')}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def input_version(spark: SparkSession, folder: str, tables: Sequence[str]) -> str:
    """Sizes and times of the files of some tables: other text once any of them changes."""
    context = spark.sparkContext
    found = []
    for table in tables:
        path = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/{table}.parquet")
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        if files.exists(path):
            for s in files.listStatus(path):
                found.append(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}")
    return ",".join(sorted(found))


def written_once(
    spark: SparkSession,
    name: str,
    source: str,
    build: Callable[[], DataFrame],
    schema: T.StructType,
    partition: str | None = None,
    settings: object = None,
    version: str = "",
    sized: bool = True,
) -> DataFrame:
    """``build()`` written as a table, once per application, settings and input version.

    ``sized`` lets adaptive execution size the files, at the price of a shuffle: a year
    with many rows is split over several, small ones are not shredded. Without it the
    last shuffle of ``build()`` makes the files. Two threads that ask for the
    same table wait for one to write it; each table has a path of its own.
    """
    key = (spark.sparkContext.applicationId, source, name, repr(settings), version)
    with _writing:
        if key not in _written:
            path = f"{run_folder(spark, 'facts')}/{name}-{uuid4().hex}"
            by = [partition] if partition else []
            rows = build()
            rows = rows.hint("rebalance", *by) if sized else rows
            rows.write.partitionBy(*by).parquet(path)
            _written[key] = path
    return read_fact(spark, _written[key], schema)


def forget_written(spark: SparkSession) -> None:
    """Delete the tables that this application wrote; nothing may read them any more."""
    application = spark.sparkContext.applicationId
    with _writing:
        for key in [k for k in _written if k[0] == application]:
            del _written[key]
        for name in ("facts", "steps"):
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark, name))
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

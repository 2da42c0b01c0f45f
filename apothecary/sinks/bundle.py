"""A publication as a bundle of files that readers see whole or not at all.

A bundle's folder has ``versions``, each with a number, the files of one run, and a
``manifest``: rows and digests of every file. The manifest is written when all files are
there, and Spark marks it complete as its last act; the version readers get is the highest
with a complete manifest. So a run that fails, or is still going on, leaves the earlier
version as it was, and no file of a version is ever written over. Nothing is renamed, which
object stores could not do at once.
"""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apothecary.operators.digests import digest

MANIFEST = "name string, rows bigint, digest_1 decimal(38,0), digest_2 decimal(38,0)"


class Bundle:
    """The versions of one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        context = spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(folder).getFileSystem(context._jsc.hadoopConfiguration())

    def _names(self) -> list[str]:
        top = self._path(f"{self.folder}/versions")
        if not self._system.exists(top):
            return []
        return sorted(s.getPath().getName() for s in self._system.listStatus(top))

    def _complete(self) -> list[str]:
        done = [n for n in self._names() if self._system.exists(self._path(f"{self.folder}/versions/{n}/manifest/_SUCCESS"))]
        return [f"{self.folder}/versions/{n}" for n in done]

    def stage(self) -> str:
        """The folder of a new version; it counts for nobody before ``commit``."""
        number = max((int(n.split("-")[0]) for n in self._names()), default=0) + 1
        return f"{self.folder}/versions/{number:08d}-{uuid4().hex[:8]}"

    def commit(self, staged: str, keep: int = 2) -> None:
        """Make ``staged`` the version readers see; versions before the last ``keep`` go."""
        self.listed(staged).coalesce(1).write.parquet(f"{staged}/manifest")
        for old in self._complete()[:-keep]:
            self._system.delete(self._path(old), True)

    def current(self) -> str | None:
        """The folder of the last complete version."""
        return next(iter(reversed(self._complete())), None)

    def listed(self, version: str) -> DataFrame:
        """Name, rows and digests of the tables and figures that a version has now."""
        found = []
        tables, figures = (self._path(f"{version}/{kind}") for kind in ("tables", "figures"))
        for folder, kind in ((tables, "parquet"), (figures, "csv")):
            for path, name in self._written(folder, kind):
                read = self.spark.read.parquet(path) if kind == "parquet" else self.spark.read.text(path)
                found.append(digest(read).select(F.lit(name).alias("name"), "rows", "digest_1", "digest_2"))
        return reduce(DataFrame.unionAll, found) if found else self.spark.createDataFrame([], MANIFEST)

    def _written(self, top, kind: str) -> list[tuple[str, str]]:
        """Folders Spark wrote below ``top``: of tables the Parquet ones, of figures all."""
        if not self._system.exists(top):
            return []
        out = []
        for place in sorted(str(s.getPath().toString()) for s in self._system.listStatus(top)):
            name = f"{top.getName()}/{place.rsplit('/', 1)[1]}"
            inner = [f"{place}/{part}" for part in (("parquet",) if kind == "parquet" else ("long", "wide"))]
            there = [p for p in inner if self._system.exists(self._path(p))]
            if there:
                out += [(p, name if kind == "parquet" else f"{name}/{p.rsplit('/', 1)[1]}") for p in there]
            elif kind == "csv":
                out.append((place, name))
        return out

    def manifest(self, version: str) -> DataFrame:
        return self.spark.read.schema(MANIFEST).parquet(f"{version}/manifest")

    def damaged(self, version: str) -> DataFrame:
        """Names whose files are not what the manifest says."""
        return unequal(self.manifest(version), self.listed(version))


def unequal(one: DataFrame, other: DataFrame) -> DataFrame:
    """Names of two manifests that are not in both with the same rows and digests."""
    columns = [c for c in one.columns if c != "name"]
    renamed = other.select(F.col("name").alias("_name"), *[F.col(c).alias(f"_{c}") for c in columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    both = one.join(renamed, F.col("name") == F.col("_name"), "full_outer")
    missing = F.col("name").isNull() | F.col("_name").isNull()
    return both.where(missing | ~same).select(F.coalesce("name", "_name").alias("name"))

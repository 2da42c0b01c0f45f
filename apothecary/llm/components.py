"""Connected components of links, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apothecary.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) for each id of ``links`` (a, b): the smallest id it is linked with, by any path.

    Each round, every id hands the smallest id among itself and its neighbours to
    all of them (large star), then keeps only the link to its smallest (small star).
    Long chains shrink by a constant factor a round. A popular id is a key of
    aggregates only, whose sums are taken before the shuffle too.
    """
    edges = stored(_tidy(links.select("a", "b")), "links")
    while True:
        large = _star(_both(edges), larger_only=True)
        small = stored(_tidy(_star(_down(large), larger_only=False)), "links")
        if edges.exceptAll(small).isEmpty() and small.exceptAll(edges).isEmpty():
            break
        edges = small
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component"))
    ).distinct()


def _tidy(links: DataFrame) -> DataFrame:
    """Links from the larger to the smaller id, each once."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select("b", "a"))


def _down(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Link the neighbours of each id with the smallest of them and itself."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
    joined = edges.join(least, F.col("a") == F.col("c"))
    if larger_only:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("c").alias("a"), F.col("m").alias("b")))

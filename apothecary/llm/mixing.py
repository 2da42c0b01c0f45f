"""Mixing of sources to target weights by Pareto order sampling.

How often a document is wanted falls with its length, so that a source's words come
from many documents: by the fourth root of its length class (sizes between two powers
of two), times a level of its source, at most three times. The level is the one at which
wanted words add up to the target. The whole part of what is wanted is a certain number
of copies. For the fraction f that remains, which differs from document to document,
documents are ranked by their random odds divided by their inclusion odds, u / (1 - u)
over f / (1 - f), and the first in that order get one copy more. The sample has a fixed
size in words: it ends before the document that would pass the source's remaining words.
Where this
leaves over a hundredth of the target (in sources of few documents), the order goes on
with the documents that still fit, a few times; the last place goes to the document
whose size fits best what is then left, if one brings the total nearer.

u comes from a hash of doc_id, size and the seed, so reruns agree. Targets: sources
in code point order, the null one last, weigh 1, 2, 3 and so on again; they share all
words, targets stop at three times the source's words and the excess is shared again
by weight. A null text has size 0, is never wanted and takes nothing; without words
every target is 0. Rows alike in everything are different documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from apothecary.llm.order import running_sum
from apothecary.llm.shared import stored

MOST_COPIES = 3
NEAR = 0.01
FILL_ROUNDS = 6
LENGTH_POWER = -0.25
WEIGHTS = (1, 2, 3)
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(docs: DataFrame) -> DataFrame:
    """Source, source_size and target of each source of ``docs`` (source, size)."""
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    ranked = running_sum(sizes.withColumn("one", F.lit(1)), order, "one", "place")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    cap = (MOST_COPIES * F.col("source_size")).cast("double")
    sources = stored(ranked.select("source", "source_size", weight.cast("double").alias("weight"), cap.alias("cap")), "sources")
    level = share_level(sources)
    return sources.select("source", "source_size", F.least("cap", level * F.col("weight")).alias("target"))


def share_level(sources: DataFrame) -> float:
    """Words for a weight of 1 once no target is above its cap.

    A source capped in one round stays capped, as the level only rises; each round
    is one aggregate over the sources.
    """
    level, capped = 0.0, -1
    while True:
        over = F.col("cap") < level * F.col("weight")
        row = sources.agg(
            F.sum("source_size").alias("words"),
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)).alias("fixed"),
            F.sum(F.when(~over, F.col("weight"))).alias("open"),
            F.count(F.when(over, 1)).alias("capped"),
        ).first()
        if not row["words"] or not row["open"] or row["capped"] == capped:
            return level
        level, capped = (row["words"] - row["fixed"]) / row["open"], row["capped"]


def _length_class(size: F.Column) -> F.Column:
    """0 for 1 word, 1 for 2 and 3, 2 for 4 to 7, and so on."""
    return (F.length(F.bin(size)) - 1).cast("int")


def wanted_copies(docs: DataFrame) -> DataFrame:
    """(source, class, wanted): copies wanted of the documents of a length class, from ``docs`` (source, size, target).

    Shorter classes reach the limit of copies first, so a class is at the limit if the
    level that the rest of the target gives to it and all longer ones would put it above.
    The windows see one row for a length class of a source.
    """
    weight = F.pow(F.lit(2.0), LENGTH_POWER * F.col("class"))
    words = (
        docs.where("size > 0").groupBy("source", _length_class(F.col("size")).alias("class"))
        .agg(F.sum("size").alias("words"), F.max("target").alias("target")).withColumn("weight", weight)
    )
    by_class = Window.partitionBy("source").orderBy("class")
    shorter = F.coalesce(F.sum("words").over(by_class.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(F.col("weight") * F.col("words")).over(by_class.rowsBetween(0, Window.unboundedFollowing))
    levels = words.withColumn("level", (F.col("target") - MOST_COPIES * shorter) / rest)
    open_level = F.min(F.when(F.col("level") * F.col("weight") < MOST_COPIES, F.struct("class", "level"))).over(Window.partitionBy("source"))
    wanted = F.coalesce(F.least(F.lit(float(MOST_COPIES)), open_level["level"] * F.col("weight")), F.lit(float(MOST_COPIES)))
    return levels.select("source", "class", F.round(wanted, 9).alias("wanted"), "words", "target")


def sampled(docs: DataFrame, seed: int = 11) -> DataFrame:
    """``docs`` (doc_id, source, size, source_size, target) with ``copies`` of each document.

    ``target`` is in words and holds for the document's source.
    """
    classes = wanted_copies(docs)
    certain = Window.partitionBy("source")
    left = F.col("target") - F.sum(F.floor("wanted") * F.col("words")).over(certain)
    classes = classes.select(F.col("source").alias("s"), F.col("class").alias("c"), "wanted", left.alias("left"))
    same = F.col("source").eqNullSafe(F.col("s")) & (_length_class(F.col("size")) == F.col("c"))
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", "size", F.lit(seed)), 11) + 0.5) / float(1 << 53)
    rows = (
        docs.join(classes, same & (F.col("size") > 0), "left").drop("s", "c")
        .withColumn("wanted", F.coalesce("wanted", F.lit(0.0)))
        .withColumn("whole", F.floor("wanted"))
        .withColumn("fraction", F.col("wanted") - F.col("whole"))
        .withColumn("rank", F.when(F.col("fraction") > 0, (u / (1 - u)) / (F.col("fraction") / (1 - F.col("fraction")))))
    )
    able = (F.col("fraction") > 0) & (F.col("size") > 0)
    order = [F.col("rank"), F.col("doc_id"), F.col("size")]
    # ``before`` tells apart the documents of a source that have words, also those alike in everything.
    ordered = running_sum(rows, order, "size", "before", ["source"])
    state = stored(ordered.withColumn("extra", able & (F.col("before") + F.col("size") <= F.col("left"))), "ordered")
    for _ in range(FILL_ROUNDS):
        more = _more(state, able, order)
        if more is None:
            break
        state = stored(_with(state, more), "ordered")
    gap = F.col("gap")
    last = (
        _left_over(state, able)
        .where(F.abs(gap - F.col("size")) < gap)
        .groupBy("source")
        .agg(F.min(F.struct(F.abs(gap - F.col("size")).alias("off"), "before")).alias("last"))
        .select(F.col("source").alias("s"), F.col("last.before").alias("b"))
    )
    copies = (F.col("whole") + F.col("extra").cast("int")).cast("int")
    return _with(state, last).withColumn("copies", copies).select(*docs.columns, "copies")


def _left_over(state: DataFrame, able: F.Column) -> DataFrame:
    """Documents not taken again yet, with the ``gap`` of words their source still wants."""
    gaps = state.groupBy("source").agg(
        (F.max("left") - F.coalesce(F.sum(F.when(F.col("extra"), F.col("size"))), F.lit(0))).alias("gap")
    )
    rest = state.where(able & ~F.col("extra"))
    return rest.join(gaps.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")


def _more(state: DataFrame, able: F.Column, order: list[F.Column]) -> DataFrame | None:
    """The next documents in order that fit, in sources whose gap is not small yet."""
    rest = _left_over(state, able).where((F.col("gap") > NEAR * F.col("target")) & (F.col("size") <= F.col("gap")))
    rest = rest.select("source", "before", "rank", "doc_id", "size", "gap")
    if rest.isEmpty():
        return None
    again = running_sum(rest, [*order, F.col("before")], "size", "again", ["source"])
    return again.where(F.col("again") + F.col("size") <= F.col("gap")).select(F.col("source").alias("s"), F.col("before").alias("b"))


def _with(state: DataFrame, more: DataFrame) -> DataFrame:
    able = (F.col("fraction") > 0) & (F.col("size") > 0)
    same = able & F.col("source").eqNullSafe(F.col("s")) & (F.col("before") == F.col("b"))
    return state.join(more, same, "left").withColumn("extra", F.col("extra") | F.col("b").isNotNull()).drop("s", "b")


def mixed_sources(docs: DataFrame, *also: str) -> DataFrame:
    """Each document of ``docs`` (doc_id, source, text) with the words the mix takes of it; ``also`` names columns to keep."""
    sized = stored(docs.select("doc_id", "source", *also, word_count().alias("size")), "sizes")
    targets = source_targets(sized).withColumnRenamed("source", "s")
    rows = sized.join(targets, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    return sampled(rows).withColumn("taken", F.col("copies") * F.col("size")).select(
        "doc_id", *also, "source", "size", "source_size", "target", "copies", "taken"
    )

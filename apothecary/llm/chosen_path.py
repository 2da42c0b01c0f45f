"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles; two are linked if 100 times the size of
the intersection is at least ``percent`` times that of the union. Words are lower-cased
in A-Z only; a text with fewer words than a shingle has is one shingle, one without
words has none and is linked with nothing.

Equal sets form a class, and classes are joined by their smallest doc_id. Each class
has ``TOKENS`` minwise tokens. At a node of a tree, one or two of these are selected
by the node alone, 1 / similarity on average, and each sends a class to the child
named by its token's value: linked classes stay together at a child with constant
probability, others part. Nodes of a few classes are leaves and compared exhaustively;
larger ones branch again, up to ``depth`` times. Trees repeat this with other selections of
the same tokens, so they are not independent: a pair at the threshold is missed with a
chance of about 1e-11 if a leaf comes after one branching, and of about 3e-5 (0.85) or 1e-4
(0.8) if it has to go to full depth in every tree.

What is left at the end of a path is a large group of near copies. Such a node is cut
into blocks. The first trees compare each block within itself and with the node's
smallest class, which joins most groups into one component; the later trees drop every
node of a single component. In the nodes that remain, the largest component is compared
with the rest block by block, and blocks of the rest with each other,
skipping pairs whose component is the same. In a leaf, pairs that share too few tokens
(below the threshold by six standard deviations) are skipped; all others are decided on
the full shingle sets, the likeliest first, until nothing new can be connected.

A row without doc_id is linked with nothing: its component is null and it is kept.
Rows of one doc_id are one document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apothecary.llm.components import components
from apothecary.llm.shared import stored
from apothecary.llm.textvec import Words, mixed, sliced

TOKENS = 48
_SEEDS = np.random.default_rng(7).integers(1, 1 << 63, (2, TOKENS), dtype=np.uint64) | np.uint64(1)


@dataclass(frozen=True)
class NearSettings:
    words: int = 3
    percent: int = 85
    trees: int = 12
    first_trees: int = 2
    leaf: int = 64
    block: int = 256
    depth: int = 3

    @property
    def least_shared(self) -> int:
        """Shared tokens below which a pair is not looked at."""
        s = self.percent / 100
        return int(TOKENS * s - 6 * (TOKENS * s * (1 - s)) ** 0.5)


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of each distinct shingle, in order."""
    hashes, doc, _ = Words(texts, lower=True).runs(k, short=True)
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return doc[new], hashes[new]


def _features(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text"):
                doc, hashes = shingles(part.column("text"), k)
                counts = np.bincount(doc, minlength=len(part))
                have = np.flatnonzero(counts)
                begin = (np.cumsum(counts) - counts)[have]
                signs = np.zeros((2, len(part)), np.uint64)
                tokens = np.zeros((len(part), TOKENS), np.int32)
                if len(have):
                    signs[0, have] = np.add.reduceat(hashes, begin)
                    signs[1, have] = np.add.reduceat(mixed(hashes), begin)
                    for t in range(TOKENS):
                        least = np.minimum.reduceat((hashes ^ _SEEDS[0, t]) * _SEEDS[1, t], begin)
                        tokens[have, t] = (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(counts.astype(np.int64)), pa.array(signs[0].view(np.int64)), pa.array(signs[1].view(np.int64)),
                        pa.FixedSizeListArray.from_arrays(pa.array(tokens.reshape(-1)), TOKENS).cast(pa.list_(pa.int32())),
                    ],
                    ["doc_id", "n_shingles", "sign", "check", "tokens"],
                )

    return run


def _child(key: F.Column, at: F.Column) -> F.Column:
    return F.xxhash64(key, at, F.element_at("tokens", at + 1))


def _children(rows: DataFrame, key: F.Column, settings: NearSettings) -> DataFrame:
    """``rows`` with a row for each child of the node ``key``."""
    one = F.pmod(key, F.lit(TOKENS)).cast("int")
    other = F.pmod(F.xxhash64(key), F.lit(TOKENS)).cast("int")
    # One token always, a second one so often that 1 / similarity are selected on average.
    second = F.pmod(F.xxhash64(key, F.lit(1)), F.lit(settings.percent)) < 100 - settings.percent
    chosen = F.when(second & (one != other), F.array(_child(key, one), _child(key, other))).otherwise(F.array(_child(key, one)))
    return rows.withColumn("key", F.explode(chosen))


def _leaves(classes: DataFrame, settings: NearSettings) -> DataFrame:
    """(tree, key, rep, n): the classes of each leaf and its size, from two on."""
    trees = F.explode(F.sequence(F.lit(0), F.lit(settings.trees - 1))).alias("tree")
    rows = classes.select("rep", "tokens", trees)
    rows = _children(rows, F.xxhash64(F.lit("tree"), F.col("tree")), settings).select("tree", "key", "rep")
    leaves = []
    for level in range(settings.depth):
        rows = stored(rows, "nodes")
        sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        rows = stored(rows.join(sizes, "key"), "nodes")
        wide = rows.where(F.col("n") > settings.leaf)
        if level == settings.depth - 1 or wide.isEmpty():
            leaves.append(rows)
            break
        leaves.append(rows.where(F.col("n") <= settings.leaf))
        rows = _children(wide.join(classes.select("rep", "tokens"), "rep"), F.col("key"), settings).select("tree", "key", "rep")
    return reduce(DataFrame.unionByName, (x.select("tree", "key", "rep", "n") for x in leaves))


def _shared(tokens: np.ndarray, n: np.ndarray, part: np.ndarray, percent: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of different part that can be linked, and their numbers of shared tokens."""
    left, right, shared = [], [], []
    for i in range(len(n) - 1):
        same = (tokens[i + 1:] == tokens[i]).sum(1)
        fits = (same >= least) & (100 * np.minimum(n[i], n[i + 1:]) >= percent * np.maximum(n[i], n[i + 1:])) & (part[i + 1:] != part[i])
        at = np.flatnonzero(fits)
        left.append(np.full(len(at), i))
        right.append(at + i + 1)
        shared.append(same[at])
    if not left:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(left), np.concatenate(right), np.concatenate(shared)


def _tokens(table: pa.Table) -> np.ndarray:
    return table.column("tokens").combine_chunks().flatten().to_numpy().reshape(-1, TOKENS)


def _hopeful(settings: NearSettings):
    """Rows of a leaf that have a partner by their tokens."""

    def run(table: pa.Table) -> pa.Table:
        n, rep = table.column("n_shingles").to_numpy(), table.column("rep").to_numpy()
        left, right, _ = _shared(_tokens(table), n, rep, settings.percent, settings.least_shared)
        return table.select(["tree", "key", "rep", "n"]).take(pa.array(np.union1d(left, right)))

    return run


def _verified(settings: NearSettings):
    """Links of a block that join its components, decided on full sets."""

    def run(table: pa.Table) -> pa.Table:
        n, rep, part = (table.column(c).to_numpy() for c in ("n_shingles", "rep", "part"))
        left, right, shared = _shared(_tokens(table), n, part, settings.percent, settings.least_shared)
        found: list[tuple[int, int]] = []
        if len(left):
            text = table.column("text").combine_chunks()
            used = np.unique(np.concatenate([left, right]))
            doc, hashes = shingles(text.take(pa.array(used)), settings.words)
            bounds = np.searchsorted(doc, np.arange(len(used) + 1))
            sets = {int(r): hashes[a:b] for r, a, b in zip(used, bounds, bounds[1:])}
            root = {int(p): int(p) for p in part}

            def top(p: int) -> int:
                while root[p] != p:
                    root[p] = p = root[root[p]]
                return p

            for i in np.argsort(-shared, kind="stable"):
                a, b = int(left[i]), int(right[i])
                x, y = top(int(part[a])), top(int(part[b]))
                if x == y:
                    continue
                both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if 100 * both >= settings.percent * (len(sets[a]) + len(sets[b]) - both):
                    root[x] = y
                    found.append((int(rep[a]), int(rep[b])))
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _block(settings: NearSettings) -> F.Column:
    """Number of the block of a row in a node of n rows; 0 if the node is no larger than a block."""
    return F.pmod(F.xxhash64("rep"), F.ceil(F.col("n") / settings.block)).cast("int")


def _between(placed: DataFrame, settings: NearSettings) -> DataFrame:
    """Blocks (key, i, j, rep, part) in which any two rows of a node meet whose part differs.

    Rows of a node's largest part need not meet each other. They and the rest are cut into
    blocks of their own, and each block of the one meets each of the other: while the rest
    is no more than a block, a row of the largest part is in one block, however large
    the node is. Only blocks of the rest also meet each other (``j`` from 0 on).
    """
    sizes = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("rows"))
    nodes = sizes.groupBy("key").agg(F.max(F.struct("rows", "part")).alias("main"), F.sum("rows").alias("all"))

    def blocks(rows: str) -> F.Column:
        return F.greatest(F.ceil(F.expr(rows) / settings.block), F.lit(1)).cast("int")

    nodes = nodes.select("key", F.col("main.part").alias("main"), blocks("main.rows").alias("mains"), blocks("all - main.rows").alias("rests"))
    rows = placed.join(nodes, "key").withColumn("is_main", F.col("part") == F.col("main"))
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("rests"))).cast("int")
    others = F.when(F.col("is_main"), F.col("rests")).otherwise(F.col("mains"))
    rows = rows.withColumn("own", own)
    crossed = rows.withColumn("other", F.explode(F.sequence(F.lit(0), others - 1))).select(
        "key", "rep", "part",
        F.when(F.col("is_main"), F.col("own")).otherwise(F.col("other")).alias("i"),
        (-1 - F.when(F.col("is_main"), F.col("other")).otherwise(F.col("own"))).alias("j"),
    )
    rest = rows.where(~F.col("is_main") & (F.col("rests") > 1)).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("rests") - 1)))
    rest = rest.where("own <> other").select("key", "rep", "part", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    return crossed.unionByName(rest)


def _links(blocks: DataFrame, classes: DataFrame, texts: DataFrame, settings: NearSettings) -> DataFrame:
    """Links found in ``blocks`` (key, i, j, rep, part)."""
    rows = blocks.join(classes.select("rep", "n_shingles", "tokens"), "rep").join(texts, "rep")
    return rows.groupBy("key", "i", "j").applyInArrow(_verified(settings), "a long, b long")


def near_duplicates(docs: DataFrame, settings: NearSettings = NearSettings()) -> DataFrame:
    """Per document of ``docs`` (doc_id, text): n_shingles, component_id and kept."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kinds = "doc_id long, n_shingles long, sign long, check long, tokens array<int>"
    features = stored(rows.mapInArrow(_features(settings.words), kinds), "features")
    same = ["sign", "check", "n_shingles"]
    known = features.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stored(known.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.first("tokens").alias("tokens")), "classes")

    leaves = _leaves(classes, settings).join(classes.select("rep", "n_shingles", "tokens"), "rep")
    small = leaves.where(F.col("n") <= settings.block).groupBy("key").applyInArrow(_hopeful(settings), "tree int, key long, rep long, n long")
    large = leaves.where(F.col("n") > settings.block).select("tree", "key", "rep", "n")
    nodes = stored(small.unionByName(large), "leaves")
    wanted = nodes.select("rep").distinct()
    texts = stored(rows.join(wanted, F.col("doc_id") == F.col("rep")).select("rep", "text"), "texts")

    early = nodes.where(F.col("tree") < settings.first_trees).withColumn("i", _block(settings)).withColumn("j", F.col("i"))
    # The smallest class of a node is compared with every block.
    split = early.where(F.col("n") > settings.block)
    leaders = split.groupBy("key").agg(F.min("rep").alias("rep"), F.first("n").alias("n"))
    every = F.explode(F.sequence(F.lit(0), (F.ceil(F.col("n") / settings.block) - 1).cast("int")))
    leaders = leaders.select("key", "rep", every.alias("i")).withColumn("j", F.col("i"))
    blocks = early.select("key", "rep", "i", "j").unionByName(leaders.select("key", "rep", "i", "j")).distinct()
    links = stored(_links(blocks.withColumn("part", F.col("rep")), classes, texts, settings), "first_links")

    parts = stored(components(links), "parts")
    labelled = stored(
        nodes.where((F.col("tree") >= settings.first_trees) | (F.col("n") > settings.block))
        .join(parts, F.col("rep") == F.col("id"), "left")
        .select("key", "rep", "n", F.coalesce("component", "rep").alias("part")),
        "labelled",
    )
    open_nodes = labelled.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("key")
    blocks = _between(labelled.join(open_nodes, "key").select("key", "rep", "part"), settings)
    more = stored(_links(blocks, classes, texts, settings), "more_links")
    final = components(links.unionByName(more))

    named = features.drop("tokens").join(classes.select(*same, "rep"), same, "left")
    return named.join(final, F.col("rep") == F.col("id"), "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


# The same rule in SQL, by an inverted index of shingles.
ORACLE = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 3 THEN array_to_string(words, ' ') ELSE array_to_string(words[i:i + 2], ' ') END AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM split WHERE len(words) > 0)
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), reach(id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.id, l.b FROM reach r JOIN link l ON l.a = r.other
), least AS (
  SELECT id, min(other) AS component_id FROM reach GROUP BY id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN size USING (doc_id) JOIN least ON id = doc_id
"""

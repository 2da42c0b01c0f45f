"""Approximate nearest neighbours by NN-descent and greedy graph search.

Nearness is the inner product. Equal vectors are one node, named by their smallest
id, so copies cost nothing and crowd nothing out. Nodes get one component more that
makes their lengths equal; neighbours by angle are then neighbours by inner product.
The components as they are given steer graph and search, in double precision, so near
copies are told apart; nothing is rounded or scaled.

The graph: nodes meet first in small buckets of random hyperplanes; large buckets are
cut at random. Then, round by round, the neighbours of a node, and some of those whose
neighbour it is, are brought together by joins and introduced to each other; a node
keeps the ``degree`` best it has met. Rounds end when few lists still change; as a change
makes a list better, they do end.

The search: a query starts from the neighbours of its own node, and from the best for
it among the longest nodes of each band of lengths, as the largest products may lie with
long nodes that are nobody's neighbours. Each round joins the
neighbours of the best nodes not yet expanded and keeps the best ``beam``, until every
node of every beam is expanded. The end is exact: scores in double precision, copies of a
node by their ids, ties to the smaller.

Rows with a null id, a null, empty or zero vector, or null or non-finite components take
no part. An inner product needs equally many components, so vectors of each number of
components are searched among their own. Rows of one id and vector are one row; of several vectors of an id the smallest counts.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apothecary.llm.shared import stored


@dataclass(frozen=True)
class GraphSettings:
    degree: int = 32
    reverse: int = 24
    trees: int = 3
    bucket: int = 128
    still: float = 0.03
    introduced: int = 10
    beam: int = 160
    width: int = 40
    seed: int = 5
    entries: int = 64
    bands: int = 40


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec): rows that take part, one for each id."""
    v = F.col(vector)
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = df.where(F.col(key).isNotNull() & v.isNotNull() & fine)
    return rows.groupBy(F.col(key).cast("long").alias("id")).agg(F.min(v).alias("vec"))


def _codes(kind: str, seed: int, trees: int, bits: int):
    """Bytes of each vector's components, and its bucket in each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch.column("vec"))
            if planes is None:
                planes = np.random.default_rng(seed).standard_normal((trees, max(bits, 1), x.shape[1]))
            signs = np.stack([(x @ p.T > 0) @ (1 << np.arange(max(bits, 1))) for p in planes], 1) if bits else np.zeros((len(x), trees), np.int64)
            code = x.astype(kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(list(signs.astype(np.int64)), pa.list_(pa.int64()))],
                ["id", "code", "buckets"],
            )

    return run


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().astype(float).reshape(len(column), -1)


def _components(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1)


def _nearness(x: np.ndarray, longest: float) -> np.ndarray:
    """Less half the squared distance of each two nodes, with the component that makes lengths equal.

    It orders as their angle does, and keeps its digits where that component is much the largest.
    """
    x = x.astype(float)
    square = (x * x).sum(1)
    rest = np.sqrt(np.maximum(0, longest * longest - square))
    both = rest[:, None] + rest
    apart = np.divide(square[:, None] - square, both, out=np.zeros_like(both), where=both > 0)
    sims = x @ x.T - (square[:, None] + square) / 2 - apart * apart / 2
    np.fill_diagonal(sims, -np.inf)
    return sims


def _listed(node: list, other: list, near: list) -> pa.Table:
    return pa.table({
        "id": pa.array(node, pa.int64()), "nbrs": pa.array(other, pa.list_(pa.int64())), "sims": pa.array(near, pa.list_(pa.float64())),
    })


_LISTS = "id long, nbrs array<long>, sims array<double>"


def _acquainted(degree: int, longest: float, kind: str):
    """The best of each node among the nodes of its bucket."""

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        sims = _nearness(_components(table.column("code"), kind), longest)
        keep = min(degree, len(ids) - 1)
        if keep < 1:
            return _listed([], [], [])
        best = np.argpartition(-sims, keep - 1, 1)[:, :keep]
        return _listed(ids, list(ids[best]), list(np.take_along_axis(sims, best, 1)))

    return run


def _introduced(most: int, longest: float, kind: str):
    """For each node around a common one, those around it that are nearer than the worst it has."""

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("center").to_numpy(), kind="stable")
        center = table.column("center").to_numpy()[order]
        ids = table.column("id").to_numpy()[order]
        worst = table.column("worst").to_numpy()[order]
        x = _components(table.column("code"), kind)[order]
        node, other, near = [], [], []
        bounds = np.flatnonzero(np.append(True, center[1:] != center[:-1])).tolist() + [len(center)]
        for a, b in zip(bounds, bounds[1:]):
            own = ids[a:b]
            sims = _nearness(x[a:b], longest)
            better = sims > worst[a:b, None]
            for i in np.flatnonzero(better.any(1)):
                at = np.flatnonzero(better[i])
                if len(at) > most:
                    at = at[np.argpartition(-sims[i, at], most)[:most]]
                node.append(own[i])
                other.append(own[at])
                near.append(sims[i, at])
        return _listed(node, other, near)

    return run


def _best(degree: int):
    """One list for each node of all its lists; ``changed`` counts what is new in it."""

    def run(table: pa.Table) -> pa.Table:
        sizes = table.column("nbrs").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        ids = np.repeat(table.column("id").to_numpy(), sizes)
        old = np.repeat(table.column("old").to_numpy(zero_copy_only=False), sizes)
        nbrs = table.column("nbrs").combine_chunks().flatten().to_numpy()
        sims = table.column("sims").combine_chunks().flatten().to_numpy()
        order = np.lexsort((~old, nbrs, ids))
        ids, nbrs, sims, old = ids[order], nbrs[order], sims[order], old[order]
        new = np.append(True, (ids[1:] != ids[:-1]) | (nbrs[1:] != nbrs[:-1]))[:len(ids)]
        ids, nbrs, sims, old = ids[new], nbrs[new], sims[new], old[new]
        order = np.lexsort((nbrs, -sims, ids))
        ids, nbrs, sims, old = ids[order], nbrs[order], sims[order], old[order]
        begin = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])[:len(ids)])
        rank = np.arange(len(ids)) - np.repeat(begin, np.diff(np.append(begin, len(ids))))
        keep = rank < degree
        ids, nbrs, sims, old = ids[keep], nbrs[keep], sims[keep], old[keep]
        begin = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])[:len(ids)])
        ends = np.append(begin[1:], len(ids))
        changed = np.add.reduceat(~old, begin) if len(begin) else np.zeros(0, int)
        out = _listed(ids[begin], [nbrs[a:b] for a, b in zip(begin, ends)], [sims[a:b] for a, b in zip(begin, ends)])
        return out.append_column("changed", pa.array(changed.astype(np.int64)))

    return run


def _sharded(df: DataFrame, key: str, shards: int) -> DataFrame:
    return df.withColumn("shard", F.pmod(F.xxhash64(F.col(key), F.lit(3)), F.lit(shards)))


def _merged(lists: DataFrame, degree: int, shards: int) -> DataFrame:
    return _sharded(lists, "id", shards).groupBy("shard").applyInArrow(_best(degree), _LISTS + ", changed long")


def neighbour_graph(nodes: DataFrame, settings: GraphSettings, count: int, longest: float, kind: str) -> DataFrame:
    """(id, nbrs, sims) of the nodes (id, code, buckets)."""
    shards = max(1, count // 2000)
    placed = nodes.select("id", "code", F.posexplode("buckets").alias("tree", "bucket"))
    sizes = placed.groupBy("tree", "bucket").agg(F.ceil(F.count("*") / settings.bucket).alias("parts"))
    dealt = placed.join(sizes, ["tree", "bucket"]).withColumn("part", F.pmod(F.xxhash64("id", "tree"), F.col("parts")))
    met = dealt.groupBy("tree", "bucket", "part").applyInArrow(_acquainted(settings.degree, longest, kind), _LISTS)
    graph = stored(_merged(met.withColumn("old", F.lit(False)), settings.degree, shards), "graph")
    codes = nodes.select("id", "code")
    for turn in itertools.count():
        ahead = graph.select(F.col("id").alias("center"), F.explode("nbrs").alias("id"))
        pairs = ahead.unionByName(_reverse(graph, settings.reverse, turn).select(F.col("id").alias("center"), F.col("by").alias("id"))).distinct()
        # A list that is not full takes any newcomer.
        worst = F.when(F.size("sims") < settings.degree, F.lit(float("-inf"))).otherwise(F.array_min("sims"))
        known = codes.join(graph.select("id", worst.alias("worst")), "id", "left").withColumn("worst", F.coalesce("worst", F.lit(float("-inf"))))
        around = _sharded(pairs.join(known, "id"), "center", shards)
        news = around.groupBy("shard").applyInArrow(_introduced(settings.introduced, longest, kind), _LISTS)
        lists = news.withColumn("old", F.lit(False)).unionByName(graph.select("id", "nbrs", "sims", F.lit(True).alias("old")))
        graph = stored(_merged(lists, settings.degree, shards), "graph", graph)
        if (graph.agg(F.sum("changed")).first()[0] or 0) <= settings.still * settings.degree * count:
            return graph.select("id", "nbrs", "sims")


def _reverse(graph: DataFrame, most: int, turn: int) -> DataFrame:
    """(id, by): some of the nodes that have ``id`` as a neighbour, chosen by hash."""
    pairs = graph.select(F.explode("nbrs").alias("id"), F.col("id").alias("by"))
    order = Window.partitionBy("id").orderBy(F.xxhash64("by", F.lit(turn)), "by")
    return pairs.withColumn("at", F.row_number().over(order)).where(F.col("at") <= most).drop("at")


def _stepped(beam: int, width: int, kind: str):
    """Beams with the newcomers scored, and what each expands next."""

    def run(table: pa.Table) -> pa.Table:
        start = table.filter(pc.is_valid(table.column("own")))
        come = table.filter(pc.is_null(table.column("own")))
        q = come.column("query").to_numpy()
        node = come.column("node").to_numpy()
        x = _components(come.column("code"), kind) if len(come) else np.zeros((0, 1))
        order = np.argsort(q, kind="stable")
        q, node, x = q[order], node[order], x[order]
        out = []
        for query, own, beams, sims, done in zip(*(start.column(c).to_pylist() for c in ("query", "own", "nodes", "sims", "done"))):
            a, b = np.searchsorted(q, [query, query + 1])
            mine = np.array(beams, np.int64)
            ids, first = np.unique(np.concatenate([mine, node[a:b]]), return_index=True)
            vector = np.frombuffer(own, kind).astype(float)
            score = np.concatenate([np.array(sims, float), x[a:b].astype(float) @ vector if b > a else np.zeros(0)])[first]
            was = np.concatenate([np.array(done, bool), np.zeros(b - a, bool)])[first]
            best = np.lexsort((ids, -score))[:beam]
            ids, score, was = ids[best], score[best], was[best]
            following = np.flatnonzero(~was)[:width]
            was[following] = True
            out.append((query, own, ids, score, was, ids[following]))
        columns = list(zip(*out)) or [()] * 6
        kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.bool_()), pa.list_(pa.int64()))
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["query", "own", "nodes", "sims", "done", "expand"])

    return run


def _length() -> F.Column:
    return F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def _longest(named: DataFrame, longest: float, settings: GraphSettings) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of the longest nodes of each band; a band is half an octave, the last has the rest."""
    band = F.least(F.floor(2 * F.log2(F.lit(longest) / F.col("length"))), F.lit(settings.bands - 1))
    order = Window.partitionBy("band").orderBy(F.desc("length"), "id")
    rows = (
        named.withColumn("length", _length()).withColumn("band", band).withColumn("at", F.row_number().over(order))
        .where(F.col("at") <= settings.entries).select("id", "vec").collect()
    )
    return np.array([r["id"] for r in rows], np.int64), np.array([r["vec"] for r in rows], float)


def _entered(ids: np.ndarray, x: np.ndarray, settings: GraphSettings, kind: str):
    """A first beam of each query from the nodes ``ids`` with vectors ``x``; its best are expanded with the query's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                own = part.column("code").to_pylist()
                score = np.stack([np.frombuffer(o, kind) for o in own]).astype(float) @ x.T
                best = [np.lexsort((ids, -s))[:settings.beam] for s in score]
                node = part.column("node").to_pylist()
                lists = (
                    [ids[b] for b in best], [s[b] for s, b in zip(score, best)], [np.arange(len(b)) < settings.width for b in best],
                    [np.unique(np.append(ids[b[:settings.width]], n)) for n, b in zip(node, best)],
                )
                kinds = (pa.int64(), pa.float64(), pa.bool_(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("query"), pa.array(own, pa.binary()), *(pa.array(v, pa.list_(k)) for v, k in zip(lists, kinds))],
                    ["query", "own", "nodes", "sims", "done", "expand"],
                )

    return run


_BEAM = "query long, own binary, nodes array<long>, sims array<double>, done array<boolean>, expand array<long>"


def searched(queries: DataFrame, nodes: DataFrame, graph: DataFrame, settings: GraphSettings, count: int, kind: str, entries: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(query, node): the nodes in each query's last beam, for queries (query, node, code) at a node."""
    around = _reverse(graph, settings.reverse, -1).groupBy("id").agg(F.collect_list("by").alias("by"))
    ways = stored(
        graph.join(around, "id", "left").select("id", F.array_union("nbrs", F.coalesce("by", F.array().cast("array<long>"))).alias("ways")), "ways"
    )
    codes = nodes.select(F.col("id").alias("node"), "code")
    beams = queries.select("query", "node", "code").mapInArrow(_entered(*entries, settings, kind), _BEAM)
    shards = max(1, count // 500)
    # All queries begin at the entries, so these go to the queries: at most entries * bands rows.
    entry = F.col("id").isin(entries[0].tolist())
    for step in itertools.count():
        front = beams.select("query", F.explode("expand").alias("id"))
        if step and front.isEmpty():
            break
        if step == 0:
            met = front.where(~entry).join(ways, "id").unionByName(front.where(entry).join(F.broadcast(ways.where(entry)), "id"))
            met = met.select("query", F.explode(F.array_union("ways", F.array("id"))).alias("node")).distinct()
        else:
            met = front.join(ways, "id").select("query", F.explode("ways").alias("node")).distinct()
        come = met.join(codes, "node").select("query", "node", "code")
        both = beams.drop("expand").unionByName(come, allowMissingColumns=True)
        stepped = _sharded(both, "query", shards).groupBy("shard").applyInArrow(_stepped(settings.beam, settings.width, kind), _BEAM)
        beams = stored(stepped, "beams", beams if step else None)
    return beams.select("query", F.explode("nodes").alias("node"))


def nearest(
    df: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding", asks: F.Column | None = None,
    settings: GraphSettings = GraphSettings(),
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product for each row that ``asks``.

    ``asks`` is a condition on ``id``; by default every row asks. A row is no answer to itself.
    """
    rows = stored(usable(df, key, vector), "rows")
    n = F.size("vec")
    lengths = [r["n"] for r in rows.groupBy(n.alias("n")).count().where("count > 1").orderBy("n").collect()]
    if not lengths:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, [_nearest(rows.where(n == size), k, asks, settings) for size in lengths])


def _nearest(rows: DataFrame, k: int, asks: F.Column | None, settings: GraphSettings) -> DataFrame:
    """``nearest`` among two or more rows (id, vec) of equally many components."""
    classes = stored(rows.groupBy("vec").agg(F.min("id").alias("node"), F.count("*").alias("copies")), "classes")
    row = classes.agg(F.max(_length()).alias("longest"), F.count("*").alias("n")).first()
    count = row["n"]
    kind = "<f4" if classes.schema["vec"].dataType == T.ArrayType(T.FloatType()) else "<f8"
    bits = max(0, int(np.ceil(np.log2(count / settings.bucket))))
    named = classes.select(F.col("node").alias("id"), "vec")
    nodes = stored(named.mapInArrow(_codes(kind, settings.seed, settings.trees, bits), "id long, code binary, buckets array<long>"), "nodes")
    graph = stored(neighbour_graph(nodes, settings, count, row["longest"], kind), "graph")

    own = rows.join(classes.select("vec", "node"), "vec").select("id", "node")
    asking = own.where(asks) if asks is not None else own
    # Queries at one node share one search.
    starts = asking.select("node").distinct().join(nodes.select(F.col("id").alias("node"), "code"), "node").select(F.col("node").alias("query"), "node", "code")
    entries = _longest(named, row["longest"], settings)
    found = stored(searched(starts, nodes, graph, settings, count, kind, entries), "found")
    vectors = classes.select("node", "vec")
    exact = (
        found.join(vectors.select(F.col("node").alias("query"), F.col("vec").alias("q")), "query").join(vectors, "node")
        .select("query", "node", F.aggregate(F.zip_with("q", "vec", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, x: s + x).alias("score"))
    )
    # Of a node only its smallest ids can be among the answers, one more than k for the query itself.
    first = Window.partitionBy("node").orderBy("id")
    members = own.withColumn("at", F.row_number().over(first)).where(F.col("at") <= k + 1).select("node", F.col("id").alias("vec_id"))
    by_node = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    answers = stored(
        exact.join(members, "node").withColumn("at", F.row_number().over(by_node)).where(F.col("at") <= k + 1).select("query", "vec_id", "score"), "answers"
    )
    by_row = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asking.select(F.col("id").alias("query_id"), F.col("node").alias("query"))
        .join(answers, "query").where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(by_row)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

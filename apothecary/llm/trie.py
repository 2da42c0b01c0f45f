"""Prefix trie of conversations, rolled up by centroid decomposition.

Conversations are rebuilt first: the head of a conversation comes from the first one of its
five, the rest is its own. A node is a distinct sequence of first turns. Its name is its depth
and two 64-bit numbers, the exclusive ors of two hashes of (depth, role, text digest) over
the sequence; so a prefix is a running aggregate, taken in blocks of ``BLOCK`` turns, and no
conversation has to lie in one task. 128 bits of hash are taken for equality. Texts stay
where they are read; only digests and lengths move.

What a node's subtree holds is summed over the forest of parent edges. A component of it is
weighed by the turns its conversations have in it, which a plain aggregate gives for each
node. The deepest node with at least half of that weight is its centroid: the part above and
each part below have at most half. The component's total under the centroid is added to all
nodes on the way from it to the top, the centroid is finished, and the parts go on by
themselves. Components over ``piece`` of weight are split by Spark joins, all of one level at
once, so levels are as many as the logarithm of turns over ``piece``; smaller ones are decomposed
inside tasks, each bounded by ``piece`` nodes. Whether a node lies under a centroid is asked of
the path of one of its conversations, never of a walk.

Defined results: rows with null conv_id belong to no conversation; null roles and texts are
empty; null turns come first; rows of one turn are ordered by role, then by SHA-256 of the
text, and repeated rows are turns of their own. The first of five is ``c - c % 5`` with the
remainder as SQL has it, which takes the sign of c. Other columns are not read. An empty table
has no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from apothecary.llm.order import partitions, running_sum
from apothecary.llm.shared import small_batches, stored

#: Turns of a running aggregate inside one task, and rows of a batch.
BLOCK = 4096
#: Weight up to which a component is decomposed inside a task.
PIECE = 1 << 16
NODE = ["depth", "n1", "n2"]
TOP = ["top_depth", "t1", "t2"]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, role, digest, bytes): the rows in order, ``place`` from 0."""
    text = F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.sha2(text.cast("binary"), 256).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"), F.lit(1).alias("one"),
        # Rows alike may come in any order, but not all in one task.
        F.monotonically_increasing_id().alias("copy"))
    order = [F.col(c) for c in ("turn", "role", "digest", "copy")]
    return running_sum(rows, order, "one", "place", ["conv_id"]).select("conv_id", "place", "role", "digest", "bytes")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt turns, (conv, depth, role, digest, bytes, rest), and (conv, size) of each conversation.

    ``rest`` is the number of turns after this one.
    """
    head = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(9)).cast("long")
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("own"))
    convs = sizes.select(F.col("conv_id").alias("conv"), "own").withColumn("head", head).withColumn("first", F.expr("conv - conv % 5"))
    firsts = sizes.select(F.col("conv_id").alias("first"), F.col("own").alias("there"))
    taken = F.least("head", F.coalesce("there", F.lit(0)))
    size = taken + F.greatest(F.col("own") - F.col("head"), F.lit(0))
    convs = stored(convs.join(firsts, "first", "left").select("conv", "first", "head", taken.alias("taken"), size.alias("size")), "convs")
    heads = rows.where("conv_id % 5 = 0 AND place < 9").withColumnRenamed("conv_id", "first").join(convs, "first").where("place < taken")
    heads = heads.withColumn("depth", F.col("place") + 1)
    tails = rows.withColumnRenamed("conv_id", "conv").join(convs, "conv").where("place >= head")
    tails = tails.withColumn("depth", F.expr("place - head + taken + 1"))
    columns = ["conv", F.col("depth").cast("long").alias("depth"), "role", "digest", "bytes", (F.col("size") - F.col("depth")).alias("rest")]
    return heads.select(*columns).unionByName(tails.select(*columns)), convs.select("conv", "size")


def paths(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv, depth, n1, n2, p1, p2, bytes, rest): the node each turn reaches and the one before it."""
    own = [F.xxhash64(F.lit(n), "depth", "role", "digest").alias(f"x{n}") for n in (1, 2)]
    keyed = rows.select("conv", "depth", F.expr(f"depth div {block}").alias("block"), *own, "bytes", "rest")
    inside = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = keyed.select("*", F.bit_xor("x1").over(inside).alias("y1"), F.bit_xor("x2").over(inside).alias("y2"))
    # Only conversations over one block long need what their earlier blocks come to.
    long = keyed.where("block > 0").select("conv").distinct()
    sums = keyed.join(long, "conv", "left_semi").groupBy("conv", "block").agg(F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("conv", "block", F.bit_xor("s1").over(earlier).alias("b1"), F.bit_xor("s2").over(earlier).alias("b2"))
    full = reached.join(before.where("block > 0"), ["conv", "block"], "left")
    for n in "12":
        full = full.withColumn(f"n{n}", F.col(f"y{n}").bitwiseXOR(F.coalesce(f"b{n}", F.lit(0))))
        full = full.withColumn(f"p{n}", F.col(f"n{n}").bitwiseXOR(F.col(f"x{n}")))
    return stored(full.select("conv", *NODE, "p1", "p2", "bytes", "rest"), "paths")


def nodes(path: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes with their smallest member, members, children, weight and own value."""
    weight = F.sum(F.col("rest") + 1).alias("weight")
    found = path.groupBy(*NODE).agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), weight)
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.sum(F.col("size") + 1).alias("weight")).where("n_convs > 0")
    found = found.unionByName(root.select("*", *[zero.alias(c) for c in (*NODE, "bytes", "p1", "p2")]))
    children = found.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(F.count("*").alias("n_children"))
    full = found.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero))
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    return stored(full.withColumn("leaves", leaf).withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes")), "nodes")


# -- centroid decomposition --------------------------------------------------


def rolled_up(found: DataFrame, path: DataFrame, piece: int = PIECE) -> DataFrame:
    """(depth, n1, n2, n_leaves, saved_tokens): sums over each node's subtree."""
    zero = F.lit(0).cast("long")
    # Written, as a join on columns that are known to be 0 would become a nested loop.
    forest = stored(found.select(*NODE, "p1", "p2", "conv", "weight", "leaves", "saved", *[zero.alias(c) for c in (*TOP, "more_leaves", "more_saved")]), "forest")
    done, small = [], []
    while True:
        whole = forest.groupBy(*TOP).agg(F.max("weight").alias("whole"))
        # Tasks take the small ones, however many.
        forest = stored(forest.join(whole, TOP), "forest")
        small.append(forest.where(F.col("whole") <= piece).drop("whole"))
        large = forest.where(F.col("whole") > piece)
        if large.isEmpty():
            break
        finished, forest = _split(large, path)
        done.append(finished)
    inside = small[0]
    for more in small[1:]:
        inside = inside.unionByName(more)
    dealt = inside.repartition(partitions(inside), *TOP).sortWithinPartitions(*TOP, "depth")
    out = dealt.mapInArrow(_decomposed, "depth bigint, n1 bigint, n2 bigint, n_leaves bigint, saved_tokens bigint")
    for finished in done:
        out = out.unionByName(finished)
    return out


def _split(large: DataFrame, path: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One level: the centroids with their sums, and the components left when they are taken out."""
    half = large.where("2 * weight >= whole")
    centroid = half.groupBy(*TOP).agg(F.min(F.struct("weight", F.col("depth").alias("d"), F.col("n1").alias("c1"), F.col("n2").alias("c2"), F.col("conv").alias("c_conv"))).alias("c"))
    centroid = stored(centroid.select(*TOP, F.col("c.weight").alias("c_weight"), "c.d", "c.c1", "c.c2", "c.c_conv"), "centroids")
    member = large.join(centroid, TOP)
    # The turn after the centroid, of a conversation that a node below it has, tells both nodes.
    step = path.select(F.col("conv").alias("s_conv"), F.col("depth").alias("s_depth"), F.col("n1").alias("a1"), F.col("n2").alias("a2"), F.col("p1").alias("b1"), F.col("p2").alias("b2"))
    below = (F.col("depth") > F.col("d")) & (F.col("conv") == F.col("s_conv")) & (F.col("s_depth") == F.col("d") + 1) & (F.col("b1") == F.col("c1")) & (F.col("b2") == F.col("c2"))
    placed = stored(member.join(step, below, "left").drop("s_conv", "s_depth", "b1", "b2"), "placed")
    is_centroid = (F.col("depth") == F.col("d")) & (F.col("n1") == F.col("c1")) & (F.col("n2") == F.col("c2"))
    under = F.col("a1").isNotNull()
    total = placed.where(is_centroid | under).groupBy(*TOP).agg(F.sum("leaves").alias("t_leaves"), F.sum("saved").alias("t_saved"))
    total = stored(centroid.join(total, TOP), "totals")
    finished = placed.where(is_centroid).join(total.select(*TOP, "t_leaves", "t_saved"), TOP).select(
        *NODE, (F.col("t_leaves") + F.col("more_leaves")).alias("n_leaves"), (F.col("t_saved") + F.col("more_saved")).alias("saved_tokens"))
    # From the centroid's parent to the top: the path of one of its conversations.
    gives = total.select(F.col("top_depth").alias("from_depth"), "d", F.col("c_conv").alias("s_conv"), "c_weight", "t_leaves", "t_saved")
    way = path.select(F.col("conv").alias("s_conv"), *NODE).join(gives, "s_conv").where("depth >= from_depth AND depth < d")
    zero = F.lit(0).cast("long")
    root = gives.where("from_depth = 0 AND d > 0").select(*[zero.alias(c) for c in NODE], "c_weight", "t_leaves", "t_saved")
    way = way.select(*NODE, "c_weight", "t_leaves", "t_saved").unionByName(root)
    rest = placed.where(~is_centroid).drop("c_weight").join(way, NODE, "left")
    gain = [F.coalesce(c, zero) for c in ("c_weight", "t_leaves", "t_saved")]
    tops = [F.when(under, new).otherwise(F.col(old)).alias(old) for old, new in zip(TOP, (F.col("d") + 1, F.col("a1"), F.col("a2")))]
    left = rest.select(
        *NODE, "p1", "p2", "conv", (F.col("weight") - gain[0]).alias("weight"), "leaves", "saved", *tops,
        (F.col("more_leaves") + gain[1]).alias("more_leaves"), (F.col("more_saved") + gain[2]).alias("more_saved"))
    return stored(finished, "finished"), left


def subtree_sums(parent: list[int], weight: list[int], leaves: list[int], saved: list[int]) -> tuple[list[int], list[int]]:
    """Sums under each node of one tree, parents before children and -1 above the top, by centroids."""
    out_leaves, out_saved = [0] * len(parent), [0] * len(parent)
    more_leaves, more_saved = [0] * len(parent), [0] * len(parent)
    parent, weight = list(parent), list(weight)
    parts = [list(range(len(parent)))]
    while parts:
        part = parts.pop()
        top, half = part[0], weight[part[0]]
        centroid = min((u for u in part if 2 * weight[u] >= half), key=lambda u: (weight[u], -u))
        under: dict[int, list[int]] = {}
        above, below = [], {}
        total_leaves, total_saved = leaves[centroid], saved[centroid]
        for u in part:
            if u == centroid:
                continue
            at = u if parent[u] == centroid else below.get(parent[u])
            if at is None:
                above.append(u)
            else:
                below[u] = at
                under.setdefault(at, []).append(u)
                total_leaves += leaves[u]
                total_saved += saved[u]
        out_leaves[centroid] = total_leaves + more_leaves[centroid]
        out_saved[centroid] = total_saved + more_saved[centroid]
        u, taken = centroid, weight[centroid]
        while u != top:
            u = parent[u]
            more_leaves[u] += total_leaves
            more_saved[u] += total_saved
            weight[u] -= taken
        parts += under.values()
        if above:
            parts.append(above)
    return out_leaves, out_saved


_SUMS = pa.schema([(c, pa.int64()) for c in (*NODE, "n_leaves", "saved_tokens")])


def _decomposed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components in order, nodes from the top down; sums of each node."""
    columns = [*TOP, *NODE, "p1", "p2", "weight", "leaves", "saved", "more_leaves", "more_saved"]

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[batch.column(c).to_pylist() for c in columns])

    out: list[tuple] = []
    for _, group in groupby(rows(), key=lambda r: r[:3]):
        part = list(group)
        place = {r[3:6]: n for n, r in enumerate(part)}
        parent = [place.get((r[3] - 1, r[6], r[7]), -1) if n else -1 for n, r in enumerate(part)]
        sums = subtree_sums(parent, [r[8] for r in part], [r[9] for r in part], [r[10] for r in part])
        out += [(*r[3:6], a + r[11], b + r[12]) for r, a, b in zip(part, *sums)]
        if len(out) >= BLOCK:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_SUMS)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_SUMS)


# -- ends ----------------------------------------------------------------------


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists in order, as one digest for each node; a list of any length is read as a stream."""
    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")])

    def table(done: list[tuple]) -> pa.RecordBatch:
        *names, digests = zip(*done)
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in names], pa.array(digests)], [*NODE, "ends"])

    done: list[tuple] = []
    for name, lists in groupby(rows(), key=lambda r: r[:3]):
        digest = hashlib.sha256()
        for n, row in enumerate(lists):
            digest.update(("," * (n > 0) + row[3]).encode())
        done.append((*name, digest.hexdigest()))
        if len(done) >= BLOCK:
            yield table(done)
            done = []
    if done:
        yield table(done)


def ends(path: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, n1, n2, ends): the digest of the conversations that end at a node, in order.

    Ids are distinct, so at most 4,096 share all but their last twelve bits and are put together first.
    """
    zero = F.lit(0).cast("long")
    at = path.where("rest = 0").select(*NODE, "conv").unionByName(convs.where("size = 0").select(*[zero.alias(c) for c in NODE], "conv"))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    near = at.groupBy(*NODE, F.shiftright("conv", 12).alias("range")).agg(ids.alias("ids"))
    dealt = near.repartition(partitions(near), *NODE).sortWithinPartitions(*NODE, "range")
    return dealt.mapInArrow(_digests, "depth bigint, n1 bigint, n2 bigint, ends string")


def trie(conversations: DataFrame, piece: int = PIECE, block: int = BLOCK) -> DataFrame:
    """All nodes of the trie of the rebuilt conversations."""
    small_batches(conversations.sparkSession)
    rows, convs = rebuilt(turns(conversations))
    path = paths(rows, block)
    found = nodes(path, convs)
    parents = found.select((F.col("depth") + 1).alias("depth"), F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv").alias("parent_conv_id"))
    sums = rolled_up(found, path, piece)
    none = hashlib.sha256(b"").hexdigest()
    full = found.join(sums, NODE).join(ends(path, convs), NODE, "left").join(parents, ["depth", "p1", "p2"], "left")
    return full.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(none)).alias("ends_sha256"))


# CRC-32 of a text of ASCII, a byte and its eight bits at a time; the last step complements it.
_CRC_SQL = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(c::VARCHAR, ''), lambda x: [ord(x), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a::BIGINT, x::BIGINT) ELSE xor(a::BIGINT >> 1, 3988292384 * (a::BIGINT & 1)) END), 4294967295)"""
ORACLE = f"""
WITH turns AS MATERIALIZED (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS MATERIALIZED (SELECT c, c - c % 5 AS first, {_CRC_SQL} % 9 AS h FROM (SELECT DISTINCT c FROM turns)),
rebuilt AS (
  SELECT v.c, place, role, text FROM convs v JOIN turns t ON t.c = v.first AND place < h
  UNION ALL SELECT v.c, place, role, text FROM convs v JOIN turns t ON t.c = v.c AND place >= h),
numbered AS (SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY place) AS depth FROM rebuilt),
prefix AS MATERIALIZED (
  SELECT c, depth, strlen(text) AS bytes, sha256(string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY c ORDER BY depth)) AS node FROM numbered
  UNION ALL SELECT c, 0, 0, '' FROM convs),
nodes AS MATERIALIZED (SELECT depth, node, min(c) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM prefix GROUP BY ALL),
up AS MATERIALIZED (
  SELECT n.depth AS d, n.node AS w, (n.n_convs - 1) * n.bytes AS saved, p.depth, p.node FROM nodes n JOIN prefix p ON p.c = n.conv_id AND p.depth <= n.depth),
children AS (SELECT depth, node, count(*) AS n FROM up WHERE d = depth + 1 GROUP BY ALL),
sums AS (
  SELECT up.depth, up.node, count(*) FILTER (k.n IS NULL) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM up LEFT JOIN children k ON k.depth = up.d AND k.node = up.w GROUP BY ALL),
ends AS (
  SELECT depth, node, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
  FROM prefix WHERE (c, depth) IN (SELECT (c, max(depth)) FROM prefix GROUP BY c) GROUP BY ALL),
parents AS (SELECT u.d AS depth, u.w AS node, n.conv_id FROM up u JOIN nodes n ON n.depth = u.depth AND n.node = u.node WHERE u.d = u.depth + 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0)::BIGINT AS n_children, s.n_leaves, s.saved_tokens,
  sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN sums s USING (depth, node) LEFT JOIN children k USING (depth, node)
  LEFT JOIN ends e USING (depth, node) LEFT JOIN parents p USING (depth, node)
"""

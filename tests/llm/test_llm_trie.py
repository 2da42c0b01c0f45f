"""Prefix trie of conversations against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from apothecary.llm import trie
from apothecary.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(r[2], r[4]) for r in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        out[c] = tuple(own.get(first, [])[:h] + turns[h:])
    return out


def expected(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        below = [totals[k] for k in children[node]]
        totals[node] = (sum(a for a, _ in below) or 1, own + sum(b for _, b in below))
    out = []
    for node, ids in members.items():
        ending = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(node))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children[node]), *totals[node],
                    hashlib.sha256(ending.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def got(df):
    assert df.columns == list(NAMES)
    return sorted([tuple(r) for r in df.collect()], key=lambda r: r[:2])


def random_rows(rng, convs, longest, texts):
    return [(c, rng.choice([None, t, t, t, t]), rng.choice(["user", "assistant", None, ""]), rng.choice([None, *(f"t{n} é" for n in range(texts))]))
            for c in convs for t in range(rng.randrange(1, longest))]


@pytest.mark.parametrize("piece,block", [(trie.PIECE, trie.BLOCK), (40, 4), (4, 3)])
def test_random_conversations(spark, piece, block):
    rng = random.Random(piece)
    rows = random_rows(rng, [*range(60), -3, -5, 10**12, 10**12 + 3, 201, 202], 14, 2)
    rows += [(c, t, "user", "same") for c in range(300, 420) for t in range(9)]
    rows += rows[::17] * 2 + [(None, 1, "user", "x")] * 3
    rng.shuffle(rows)
    assert got(trie.trie(spark.createDataFrame(rows, SCHEMA), piece, block)) == expected(rows)


def test_long_and_wide(spark):
    rng = random.Random(9)
    rows = [(0, t, "user", f"{t % 7}") for t in range(900)] + [(5, t, "user", f"{t % 7}") for t in range(600)]
    rows += [(c, t, "user", f"{c}") for c in range(1000, 1900) for t in range(2)]
    rng.shuffle(rows)
    assert got(trie.trie(spark.createDataFrame(rows, SCHEMA), 200, 64)) == expected(rows)


def test_sums_by_centroids():
    rng = random.Random(4)
    for n in (1, 2, 3, 10, 400):
        for reach in (1, 3, n):
            parent = [-1, *[max(0, u - rng.randrange(1, reach + 1)) for u in range(1, n)]]
            leaves, saved, weight = [rng.randrange(3) for _ in parent], [rng.randrange(100) for _ in parent], [rng.randrange(1, 5) for _ in parent]
            plain = [list(leaves), list(saved), list(weight)]
            for u in range(n - 1, 0, -1):
                for sums in plain:
                    sums[parent[u]] += sums[u]
            assert list(trie.subtree_sums(parent, plain[2], leaves, saved)) == plain[:2]


def test_odd_tables(spark):
    turnless = next(c for c in range(1, 999) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(turnless, 0, "user", "gone")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("conv", "depth", "place", "n1", "role2", "block", "weight", "one"):
        df = df.withColumn(name, df["turn"])
    assert got(trie.trie(df)) == expected(rows) and len(expected(rows)) == 1
    assert trie.trie(df.limit(0)).count() == 0
    assert trie.trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).count() == 0
    rows = [(5, 1, "user", "x" * 300_000), (5, 2, None, None), (10, 1, "user", "x" * 300_000)]
    assert got(trie.trie(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_query_by_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op13_prefix_trie"](spark, folder)) == expected(rows)

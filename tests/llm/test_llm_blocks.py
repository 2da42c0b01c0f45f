"""Blocks in which the rows of large groups of near copies meet."""

from collections import defaultdict

from apothecary.llm import chosen_path


def _met(spark, size: int, loose: int):
    """Blocks of a node of one component of ``size`` rows and ``loose`` rows in twos, beside a small node."""
    parts = [0] * size + [1 + i // 2 for i in range(loose)]
    rows = [(5, rep, part) for rep, part in enumerate(parts)] + [(6, 1, 0), (6, size, 1), (6, size + 2, 2)]
    placed = spark.createDataFrame(rows, "key long, rep long, part long")
    blocks = defaultdict(list)
    for r in chosen_path._between(placed, chosen_path.NearSettings(block=16)).collect():
        blocks[r["key"], r["i"], r["j"]].append((r["rep"], r["part"]))
    met = {(k, a, b) for (k, _, _), rows in blocks.items() for a, x in rows for b, y in rows if a < b and x != y}
    wanted = {(k, a, b) for k, a, x in rows for l, b, y in rows if k == l and a < b and x != y}
    return met, wanted, sum(map(len, blocks.values()))


def test_rows_of_different_components_meet_and_large_components_are_not_multiplied(spark):
    met, wanted, few = _met(spark, 400, 16)
    assert met == wanted
    met, wanted, many = _met(spark, 1600, 16)
    assert met == wanted
    # Before, every row went to all blocks of the node: 16 times as many for 4 times the rows.
    assert many < 4.5 * few
    met, wanted, _ = _met(spark, 20, 100)
    assert met == wanted

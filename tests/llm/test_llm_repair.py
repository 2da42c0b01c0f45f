"""Conversation repair against plain Python."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from apothecary.llm import repair
from apothecary.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
WORDY = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
ROLE = {"u": "user", "a": "assistant"}


def least_edits(rows):
    """The least (cost, edits) by state, row after row; ``rows``: (initial, must go, truncated)."""
    def with_inserts(best):
        for _ in range(3):
            for state, (cost, edits) in list(best.items()):
                offer(best, NEXT[state], cost + 3, edits + "I")
        return best

    def offer(best, state, cost, edits):
        if state not in best or (cost, edits) < best[state]:
            best[state] = (cost, edits)

    best = {"": (0, "")}
    for initial, gone, truncated in rows:
        after = {}
        for state, (cost, edits) in with_inserts(best).items():
            offer(after, state, cost + 4, edits + "D")
            if not gone:
                more = 3 if truncated else 0
                offer(after, NEXT[state], cost + 3 + more, edits + "R")
                if initial == "s" and state == "" or initial in "ua" and NEXT[state] == initial:
                    offer(after, initial, cost + more, edits + "K")
        best = after
    best = with_inserts(best)
    return min(best[s] for s in ("", "a") if s in best)


def damage(rows):
    """Rows (turn, role, text) of one conversation after damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        role = "user" if way == 4 else role
        out += [(turn, role, text)] * (0 if way == 0 else 2 if way == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))


def expected(rows):
    rows = damage(rows)
    seen, faults = set(), []
    for _, role, text in rows:
        words = WORDY.findall(text)
        faults.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") or not a or not b for a, b in zip(initials, initials[1:]))
    cost, audit = least_edits([(i or "-", f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults)])
    lines, state, left = [], "", iter(rows)
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            lines.append(ROLE[state] + ":")
            continue
        _, role, text = next(left)
        if edit == "K":
            state = role[0]
            lines.append(f"{role}:{text}")
        elif edit == "R":
            state = NEXT[state]
            lines.append(f"{ROLE[state]}:{text}")
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def check(spark, rows, df=None, size=repair.BLOCK):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    found = (repair.repaired(spark.createDataFrame(rows, SCHEMA), size) if df is None else df).collect()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = {r["conv_id"]: tuple(r[n] for n in names) for r in found}
    assert len(found) == len(groups) and set(got) == set(groups)
    for conv, group in groups.items():
        assert got[conv] == expected(group), conv


def random_rows(rng, conv, n, turns=None):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "ui"]
    texts = ["Yes.", "No!", "Why?", "cut", "", " \t", None, "One. two", "Done. \n", "é?", "日本"]
    return [(conv, rng.choice([None, rng.randrange(turns or n + 2)]) if rng.random() < 0.1 else i, rng.choice(roles[:rng.choice([4, 9])]),
             rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.randrange(9 * n)}{rng.choice(['.', '.', ''])}") for i in range(n)]


def test_edits_are_the_least_of_all():
    kinds = ["s", "u", "a", "o", "S", "U", "A", "O", "x"]
    for n in range(5):
        for codes in itertools.product(kinds, repeat=n) if n < 4 else random.Random(1).choices(list(itertools.product(kinds, repeat=4)), k=400):
            rows = [(c.lower() if c.lower() in "sua" else "-", c == "x", c.isupper()) for c in codes]
            cost, steps = repair.solved(tuple((c, 1) for c in codes), repair.NOTHING, repair.END)
            assert (cost, "".join(e for e, _ in steps)) == least_edits(rows)


def test_tables_of_parts_add_up():
    rng = random.Random(2)
    for _ in range(60):
        codes = rng.choices("suaoSUAOx", weights=[1, 9, 9, 1, 1, 3, 3, 1, 4], k=rng.randrange(2, 300))
        elements = [(c, rng.randrange(1, 4) if c == "x" else 1) for c in codes]
        cuts = sorted({0, len(elements), *(rng.randrange(len(elements)) for _ in range(5))})
        parts = [elements[a:b] for a, b in zip(cuts, cuts[1:])]
        tables = [repair.summed([repair.table_of(*e) for e in p]) for p in parts]
        after = repair.crossings([*tables, repair.table_of("$", 1)], repair.NOTHING, repair.ASSISTANT)[:-1]
        states = [repair.NOTHING, *after[:-1], repair.END]
        solved = [repair.solved(tuple(p), a, b) for p, a, b in zip(parts, states, states[1:])]
        whole = [(c.lower() if c.lower() in "sua" else "-", c == "x", c.isupper()) for c, n in elements for _ in range(n)]
        assert (sum(c for c, _ in solved), "".join(e for _, s in solved for e, _ in s)) == least_edits(whole)


def test_random_conversations(spark):
    rng = random.Random(3)
    rows = [r for conv in range(150) for r in random_rows(rng, conv, rng.randrange(1, 14))]
    rows += [r for r in rows if rng.random() < 0.05] * 2
    rows += random_rows(rng, None, 12) + random_rows(rng, -7, 5)
    rng.shuffle(rows)
    check(spark, rows)


@pytest.mark.parametrize("block", [3, 64])
def test_a_conversation_over_many_blocks(spark, block):
    rng = random.Random(block)
    rows = random_rows(rng, 1, 700) + random_rows(rng, 2, 5) + [(3, 4, "user", "again.")] * 500 + random_rows(rng, 3, 40)
    rows += [(4, 8, "user", "Hi.")] * 20 + [(4, 9, "tool", "cut")] * 3
    check(spark, rows, size=block)


def test_odd_tables(spark):
    dropped = next(t for t in range(100) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    rows = [(5, dropped, "user", "Hi."), (6, None, None, None), (None, None, "user", "x" * 200_000 + "."), (8, 1, "system", "Be brief.")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("part", "block", "digest", "times", "kind", "sort", "lines", "audit"):
        df = df.withColumn(name, df["turn"])
    check(spark, rows, repair.repaired(df))
    row = repair.repaired(df).where("conv_id = 5").first()
    assert row["audit"] == "" and row["cost"] == 0 and row["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert repair.repaired(df.limit(0)).count() == 0


def test_query_by_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows, QUERIES["op11_conversation_repair"](spark, folder))

"""Repair of damaged conversations: the cheapest edits that give turns in legal order.

Legal role initials are ``(s?(ua)+)?``. Edits are Keep (0), Rerole to user or assistant (3),
Delete (4, and the only edit of blank and duplicate rows) and Insert of an empty turn (3);
a truncated row that stays costs 3 more. Of the cheapest edit strings the ASCII-least is
taken.

A prefix of a conversation matters only by what was last written: nothing, s, u or a. So a
row, or any run of rows, is a 4 x 4 table from state before to state after: the cost, and the
place of its least edit string among those from the same state before. Edits that insert
nothing after their last row never are prefixes of each other, so places can be compared
piece by piece, and tables can be merged. ``crossings`` is Hirschberg's divide and conquer
over any list of such tables: a forward vector of four costs and places and a backward
vector of four costs meet in the middle, the audit-least optimal state there is kept, and
both halves are solved on their own. No table of all rows by states is held.

Spark puts the rows in order by a range shuffle, so one conversation may spread over many
tasks, and cuts what a task has of it into blocks of at most ``BLOCK`` rows. Blocks of
conversations that have several are summed up to tables, and the same routine finds the
states between blocks; then every block is solved by itself. Only the last step sees a
conversation in one task, as a stream: its digest is defined over its whole text in order.
An audit must fit a string of Spark, so it has less than 2^31 edits, and at most half a
million blocks meet in one task.

Defined results: nulls in role and text count as one space, in ``conv_id`` and ``turn`` also
where the damage is chosen; rows with null conv_id are one conversation; null turns come
first. Rows of one turn are ordered by role, then by SHA-256 of the text. Repeated rows are
rows like others; they are counted, not carried. Roles other than s, u or a by their first
character can't be kept. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apothecary.llm.order import partitions
from apothecary.llm.shared import small_batches, stored

BLOCK = 4096
STATES = range(4)
NOTHING, SYSTEM, USER, ASSISTANT = STATES
#: The end of a conversation, as a state after its last row.
END = 4
NEVER = 1 << 60
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
FOLLOWS = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LINE = {USER: "user", ASSISTANT: "assistant"}

# -- tables of costs and places ----------------------------------------------


@lru_cache(maxsize=None)
def _edits(code: str) -> tuple:
    """Of a kind of row, for each pair of states: (cost, edits) or None, the least of its edit strings.

    ``code``: the initial, or o for others, in capitals if truncated; x for rows to delete;
    $ for the end.
    """
    found: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(before: int, after: int, cost: int, edits: str) -> None:
        found[before, after] = min(found.get((before, after), (NEVER, "")), (cost, edits))

    for before in STATES:
        at = before
        for inserted in range(3):
            cost, edits = INSERT * inserted, "I" * inserted
            if code == "$":
                if at in (NOTHING, ASSISTANT):
                    offer(before, ASSISTANT, cost, edits)
            else:
                offer(before, at, cost + DELETE, edits + "D")
                if code != "x":
                    stays = cost + (TRUNCATED if code.isupper() else 0)
                    offer(before, FOLLOWS[at], stays + REROLE, edits + "R")
                    kept = {"s": SYSTEM if at == NOTHING else None, "u": USER, "a": ASSISTANT}.get(code.lower())
                    if kept == SYSTEM or (kept is not None and FOLLOWS[at] == kept):
                        offer(before, kept, stays + KEEP, edits + "K")
            at = FOLLOWS[at]
    return tuple(tuple(found.get((a, b)) for b in STATES) for a in STATES)


def _places(keys: list) -> tuple[int, ...]:
    order = sorted((k, b) for b, k in enumerate(keys) if k is not None)
    places = [0] * len(keys)
    for n, (_, b) in enumerate(order):
        places[b] = n
    return tuple(places)


@lru_cache(maxsize=1 << 16)
def table_of(code: str, times: int) -> tuple:
    """((cost, place) by state after) by state before, of ``times`` rows alike; only x comes more than once."""
    rows = []
    for before in STATES:
        edits = _edits(code)[before]
        places = _places([e and e[1] for e in edits])
        more = DELETE * (times - 1)
        rows.append(tuple((e[0] + more, p) if e else (NEVER, 0) for e, p in zip(edits, places)))
    return tuple(rows)


def forward(vector: list, table: tuple) -> list:
    """The least (cost, place) to each state after the rows of ``table``, from that before them."""
    best = []
    for after in STATES:
        least = None
        for before in STATES:
            cost, place = vector[before]
            more, then = table[before][after]
            if cost < NEVER and more < NEVER and (least is None or (cost + more, place, then) < least):
                least = (cost + more, place, then)
        best.append(least)
    places = _places([b and b[1:] for b in best])
    return [(b[0], p) if b else (NEVER, 0) for b, p in zip(best, places)]


def backward(table: tuple, vector: list) -> list:
    """The least cost from each state before the rows of ``table``, given the costs after them."""
    return [min(min(more + vector[after] for after, (more, _) in enumerate(table[before])), NEVER) for before in STATES]


def summed(tables: list) -> tuple:
    """One table for all."""
    return tuple(tuple(_from(state, tables)) for state in STATES)


def _from(state: int, tables: list) -> list:
    vector = [(0 if s == state else NEVER, 0) for s in STATES]
    for table in tables:
        vector = forward(vector, table)
    return vector


def crossings(tables: list, before: int, after: int) -> list[int]:
    """The state after each table on the audit-least of the cheapest ways from ``before`` to ``after``."""
    states = [after] * len(tables)
    parts = [(0, len(tables), before, after)]
    while parts:
        low, high, first, last = parts.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        left = _from(first, tables[low:middle])
        right = [0 if s == last else NEVER for s in STATES]
        for table in reversed(tables[middle:high]):
            right = backward(table, right)
        state = min((left[s][0] + right[s], left[s][1], s) for s in STATES)[2]
        states[middle - 1] = state
        parts += [(low, middle, first, state), (middle, high, state, last)]
    return states


def elements_of(kinds: str, times: list[int]) -> list[tuple[str, int]]:
    """Rows as (code, times): of rows alike the first may stay, the others are duplicates; dropped ones are none."""
    out: list[tuple[str, int]] = []
    for code, n in zip(kinds, times):
        if code == "x" and n:
            out.append(("x", n))
        elif n:
            out.append((code, 1))
            if n > 1:
                out.append(("x", n - 1))
    return out


def solved(elements: tuple, before: int, after: int) -> tuple[int, tuple[tuple[str, int], ...]]:
    """Cost, and of each element its edits and the state after it; with ``END`` also the inserts at the end."""
    return (_short if len(elements) <= SHORT else _solved)(elements, before, after)


def _solved(elements: tuple, before: int, after: int) -> tuple[int, tuple[tuple[str, int], ...]]:
    if after == END:
        elements, after = (*elements, ("$", 1)), ASSISTANT
    tables = [table_of(*e) for e in elements]
    cost, out, state = 0, [], before
    for (code, times), table, then in zip(elements, tables, crossings(tables, before, after)):
        cost += table[state][then][0]
        edits = _edits(code)[state][then][1]
        out.append(("D" * (times - 1) + edits if code == "x" else edits, then))
        state = then
    return cost, tuple(out)


#: Elements up to which results are remembered; many conversations are alike in them.
SHORT = 64
_short = lru_cache(maxsize=1 << 14)(_solved)


# -- rows, damage and faults ---------------------------------------------------

_WORDY = r"[^\x20\x09-\x0D]"


def _damage() -> Column:
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    return F.pmod(F.crc32(place), F.lit(20))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, times): each row with its damage; a dropped one comes 0 times."""
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), _damage().alias("way"))
    way = F.col("way")
    text = F.when(way == 1, "").when(way == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(way == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(way == 0, 0).when(way == 3, 2).otherwise(1).alias("times"))


def _digest() -> Column:
    return F.sha2(F.col("text").cast("binary"), 256).alias("digest")


def faulty(rows: DataFrame) -> DataFrame:
    """Rows alike as one, (conv_id, turn, role, digest, times, kind): the kind as a code of ``_edits``, b for blank."""
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\f\r")), -1, 1)
    initial = F.substring("role", 1, 1)
    own = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    kind = F.when(~F.col("text").rlike(_WORDY), "b").when(last.isin(".", "!", "?"), own).otherwise(F.upper(own))
    by = ["conv_id", "turn", "role", "digest"]
    alike = rows.select("conv_id", "turn", "role", _digest(), "times", kind.alias("kind")).groupBy(*by).agg(
        F.sum("times").alias("times"), F.first("kind").alias("kind"))
    alike = stored(alike, "faults")
    # The turn in which a conversation has a text first; a key of its own for each, however often it's said.
    first = alike.where("times > 0").groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("at"))
    first = first.select(F.col("conv_id").alias("f_conv"), F.col("at.turn").alias("f_turn"), F.col("role").alias("f_role"), F.col("digest").alias("f_digest"))
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(by, ("f_conv", "f_turn", "f_role", "f_digest"))]
    marked = alike.join(first, same[0] & same[1] & same[2] & same[3], "left")
    return marked.select(*by, "times", F.when((F.col("kind") != "b") & F.col("f_role").isNull(), "x").otherwise(F.col("kind")).alias("kind"))


# -- blocks ----------------------------------------------------------------------

_KEYS = "conv_id bigint, turns array<bigint>, roles array<string>, digests array<string>, times array<bigint>, kinds string"
BLOCKS = f"{_KEYS}, part int, block bigint"


def _table(columns: dict, fields: list[pa.Field]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in fields], schema=pa.schema(fields))


_BLOCK_FIELDS = [
    pa.field("conv_id", pa.int64()), pa.field("turns", pa.list_(pa.int64())), pa.field("roles", pa.list_(pa.string())),
    pa.field("digests", pa.list_(pa.string())), pa.field("times", pa.list_(pa.int64())), pa.field("kinds", pa.string()),
    pa.field("part", pa.int32()), pa.field("block", pa.int64()),
]


def _in_blocks(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in order, as blocks of one conversation each, of ``size`` rows at most."""
    names = [f.name for f in _BLOCK_FIELDS]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "digest", "times", "kind", "part")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        number = 0
        for conv, group in groupby(rows(batches), key=lambda r: r[0]):
            while block := list(islice(group, size)):
                _, turns, roles, digests, times, kinds, parts = zip(*block)
                yield conv, turns, roles, digests, times, "".join(kinds), parts[0], number
                number += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for block in cut(batches):
            out.append(block)
            held += len(block[1])
            if held >= size:
                yield _table(dict(zip(names, zip(*out))), _BLOCK_FIELDS)
                out, held = [], 0
        if out:
            yield _table(dict(zip(names, zip(*out))), _BLOCK_FIELDS)

    return run


def blocks(faults: DataFrame, size: int = BLOCK) -> DataFrame:
    """Blocks in order of ``part`` and ``block``, dropped rows among them."""
    by = ["conv_id", "turn", "role", "digest"]
    ranged = faults.repartitionByRange(partitions(faults), *by).withColumn("part", F.spark_partition_id())
    return stored(ranged.sortWithinPartitions(*by).mapInArrow(_in_blocks(size), BLOCKS), "blocks")


def _code(kinds: str) -> str:
    return kinds.replace("b", "x")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tables = [summed([table_of(*e) for e in elements_of(_code(k), n)]) for k, n in zip(batch.column("kinds").to_pylist(), batch.column("times").to_pylist())]
        flat = [[x for row in t for pair in row for x in pair] for t in tables]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), batch.column("block"), pa.array(flat, pa.list_(pa.int64()))], ["conv_id", "part", "block", "costs"])


def _between(group: pa.Table) -> pa.Table:
    """States before and after each block of a conversation."""
    group = group.sort_by([("part", "ascending"), ("block", "ascending")])
    tables = [tuple(tuple((c[8 * a + 2 * b], c[8 * a + 2 * b + 1]) for b in STATES) for a in STATES) for c in group.column("costs").to_pylist()]
    after = crossings([*tables, table_of("$", 1)], NOTHING, ASSISTANT)[:-1]
    return pa.table({
        "s_part": group.column("part"), "s_block": group.column("block"),
        "before": pa.array([NOTHING, *after[:-1]], pa.int32()), "after": pa.array([*after[:-1], END], pa.int32())})


def bounded(cut: DataFrame) -> DataFrame:
    """Blocks with the states ``before`` and ``after`` them; a block alone goes from nothing to the end."""
    many = cut.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv_id").alias("m_conv"))
    several = cut.join(many, F.col("conv_id").eqNullSafe(F.col("m_conv")), "left_semi").select("conv_id", "part", "block", "kinds", "times")
    sums = several.mapInArrow(_sums, "conv_id bigint, part int, block bigint, costs array<bigint>")
    states = stored(sums.groupBy("conv_id").applyInArrow(_between, "s_part int, s_block bigint, before int, after int"), "states")
    joined = cut.join(states, (F.col("part") == F.col("s_part")) & (F.col("block") == F.col("s_block")), "left")
    return joined.select(*cut.columns, F.coalesce("before", F.lit(NOTHING)).alias("before"), F.coalesce("after", F.lit(END)).alias("after"))


# -- edits, and the repaired text --------------------------------------------------

_MARKS = ["blank", "duplicate", "truncated", "illegal", "cost"]
#: Of a block: counts, its edits, its first and last turn and initial, distinct turns, inserts at the end.
_EDIT_FIELDS = [
    pa.field("conv_id", pa.int64()), pa.field("turn", pa.int64()), pa.field("role", pa.string()), pa.field("digest", pa.string()), pa.field("sort", pa.int32()),
    pa.field("lines", pa.string()), pa.field("as_role", pa.string()),
    pa.field("audit", pa.string()), pa.field("counts", pa.list_(pa.int64())), pa.field("ends", pa.string()), pa.field("turns", pa.list_(pa.int64())),
]
EDITS = ("conv_id bigint, turn bigint, role string, digest string, sort int, lines string, as_role string, audit string,"
         " counts array<bigint>, ends string, turns array<bigint>")
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def _lines(edits: str, state: int) -> tuple[list[str], int]:
    """Roles of the turns inserted by ``edits`` from ``state``, and the state after them."""
    out = []
    for _ in range(edits.count("I")):
        state = FOLLOWS[state]
        out.append(LINE[state])
    return out, state


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.name for f in _EDIT_FIELDS]
    columns = ["conv_id", "turns", "roles", "digests", "times", "kinds", "before", "after"]
    for batch in batches:
        out: list[tuple] = []
        for conv, turns, roles, digests, times, kinds, before, after in zip(*[batch.column(c).to_pylist() for c in columns]):
            elements = tuple(elements_of(_code(kinds), times))
            cost, steps = solved(elements, before, after)
            first, start, state, at = (turns[0], roles[0], digests[0]), len(out), before, 0
            out.append(())
            rows = [r for r in zip(turns, roles, digests, times, kinds) if r[3]]
            for turn, role, digest, n, kind in rows:
                edits, then = steps[at]
                inserted, state = _lines(edits, state)
                kept = {"K": role, "R": LINE.get(then)}.get(edits[-1])
                at += 1
                if kind not in "bx" and n > 1:
                    more, _ = _lines(steps[at][0], then)
                    then = steps[at][1]
                    at += 1
                else:
                    more = []
                state = then
                if inserted or kept is not None:
                    out.append((conv, turn, role, digest, 1, "\n".join(f"{r}:" for r in inserted), kept, None, None, None, None))
                if more:
                    out.append((conv, turn, role, digest, 3, "\n".join(f"{r}:" for r in more), None, None, None, None, None))
            last, _ = _lines(steps[-1][0], state) if after == END else ([], state)
            initials = [r[1][:1] for r in rows]
            pairs = sum((a, b) not in _LEGAL for a, b in zip(initials, initials[1:])) + sum(r[3] - 1 for r in rows)
            known = [r[0] for r in rows if r[0] is not None]
            counts = [
                sum(r[3] for r in rows if r[4] == "b"),
                sum(r[3] if r[4] == "x" else r[3] - 1 for r in rows if r[4] != "b"),
                sum(r[4].isupper() for r in rows), pairs, cost]
            distinct = sum(a != b for a, b in zip(known, known[1:])) + 1
            out[start] = (
                conv, *first, 0, "\n".join(f"{r}:" for r in last), None, "".join(e for e, _ in steps), counts,
                initials[0] + "\n" + initials[-1] if rows else None, [known[0], known[-1], distinct] if known else None)
        yield _table(dict(zip(names, zip(*out))) if out else {n: [] for n in names}, _EDIT_FIELDS)


_RESULT_FIELDS = [
    pa.field("conv_id", pa.int64()), *[pa.field(n, pa.int64()) for n in ("gaps", *_MARKS)], pa.field("audit", pa.string()), pa.field("repaired_sha256", pa.string()),
]
RESULT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


class _Conversation:
    """What has been read of one conversation."""

    def __init__(self) -> None:
        self.counts, self.audit, self.text, self.any = [0] * len(_MARKS), [], hashlib.sha256(), False
        self.initial = self.turns = None
        self.final, self.open = "", None

    def line(self, text: str) -> None:
        if text is not None:
            self.text.update(("\n" + text if self.any else text).encode())
            self.any = True

    def block(self, audit: str, counts: list[int], ends: str | None, turns: list[int] | None, last: str) -> None:
        self.counts = [a + b for a, b in zip(self.counts, counts)]
        self.audit.append(audit)
        self.final = last or self.final
        if ends is not None:
            first, final = ends.split("\n")
            if self.initial is not None and (self.initial, first) not in _LEGAL:
                self.counts[3] += 1
            self.initial = final
        if turns is not None:
            if self.turns is None:
                self.turns = list(turns)
            else:
                self.turns = [self.turns[0], turns[1], self.turns[2] + turns[2] - (self.turns[1] == turns[0])]

    def result(self) -> tuple:
        if self.final:
            self.line(self.final)
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        return gaps, *self.counts, "".join(self.audit), self.text.hexdigest()


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks, edits and texts in order, as one row for each conversation. Texts are read as a stream."""
    names = [f.name for f in _RESULT_FIELDS]
    columns = ["conv_id", "turn", "role", "digest", "sort", "lines", "as_role", "audit", "counts", "ends", "turns", "text"]
    current, told, done = None, _Conversation(), []
    for batch in batches:
        for conv, turn, role, digest, sort, lines, as_role, audit, counts, ends, turns, text in zip(*[batch.column(c).to_pylist() for c in columns]):
            if current is None or conv != current[0]:
                if current is not None:
                    done.append((*current, *told.result()))
                current, told = (conv,), _Conversation()
            if sort == 0:
                told.block(audit, counts, ends, turns, lines)
            elif sort == 2:
                # Of rows alike only the first may stay.
                if told.open and told.open[:3] == (turn, role, digest):
                    told.line(f"{told.open[3]}:{text}")
                    told.open = None
            else:
                if lines:
                    told.line(lines)
                told.open = (turn, role, digest, as_role) if as_role is not None else None
        if len(done) >= BLOCK:
            yield _table(dict(zip(names, zip(*done))), _RESULT_FIELDS)
            done = []
    if current is not None:
        done.append((*current, *told.result()))
    if done:
        yield _table(dict(zip(names, zip(*done))), _RESULT_FIELDS)


def edits(conversations: DataFrame, size: int = BLOCK) -> DataFrame:
    """The edits of each row that stays or has turns inserted before it (``sort`` 1 and 3), and of each block (0)."""
    small_batches(conversations.sparkSession)
    return bounded(blocks(faulty(damaged(conversations)), size)).mapInArrow(_edited, EDITS)


def repaired(conversations: DataFrame, size: int = BLOCK) -> DataFrame:
    """Faults, cost, edits and digest of the repaired text of every conversation; ``size``: rows of a block."""
    texts = damaged(conversations).where("times > 0").select(
        "conv_id", "turn", "role", _digest(), F.lit(2).alias("sort"), "text")
    both = edits(conversations, size).unionByName(texts, allowMissingColumns=True)
    both = both.repartition(partitions(both), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest", "sort")
    return both.mapInArrow(_told, RESULT)

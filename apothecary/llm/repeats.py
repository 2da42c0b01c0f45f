"""Substring deduplication by repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document. A window repeats if the
same words also start earlier: in a document of smaller doc_id, or earlier in its
own. Every word that a repeating window covers is removed.

1. Each window has an anchor: among its runs of ``ANCHOR`` words the one with the
   smallest hash. Equal windows have equal anchors, and neighbours mostly share
   theirs, so an eighth of the positions tells which windows may recur at all. Of
   equal texts only the first counts here; its copies are proposed whole.
2. Windows with a recurring anchor are hashed whole. Those whose hash occurs twice
   are recurring passages; the first occurrence of each is known from the hash.
3. Of the first occurrences, tiles of ``TILE`` words, one in each window, are compiled
   into Aho-Corasick automata over words, sharded so that each stays small. The other
   occurrences are streamed through the automaton of their shard; a tile it finds is
   extended word by word to all that the two passages have in common. Shards of common
   passages are salted: more tasks have the automaton, each sees fewer occurrences.

Null and empty texts and texts of fewer words have no window. A null doc_id comes
after all others. Rows of equal doc_id and text are one document twice: neither
makes the other repeat. Hashes of 96 bits only propose; what is removed is always
confirmed word for word.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apothecary.llm.order import partitions
from apothecary.llm.shared import stored
from apothecary.llm.textvec import Words, sliced, word_runs

WINDOW = 20
ANCHOR = 6
TILE, STRIDE = 11, 10
PIECE_WINDOWS = 4_000
SHARD_WINDOWS = 20_000
STREAM_WORDS = 400_000


def anchored(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, first word, anchor place and anchor value of each window."""
    values, _, _ = word_runs(hashes, words.bounds, ANCHOR)
    counts = words.counts()
    windows = np.maximum(counts - WINDOW + 1, 0)
    anchors = np.maximum(counts - ANCHOR + 1, 0)
    doc = np.repeat(np.arange(len(counts)), windows)
    local = np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows)
    width = WINDOW - ANCHOR + 1
    best, size = np.arange(len(values)), 1
    while 2 * size <= width:
        best = _better(values, best, size)
        size *= 2
    if size < width:
        best = _better(values, best, width - size)
    place = best[(np.cumsum(anchors) - anchors)[doc] + local]
    return doc, words.bounds[:-1][doc] + local, place, values[place]


def _better(values: np.ndarray, best: np.ndarray, shift: int) -> np.ndarray:
    """At each place the smaller of the bests here and ``shift`` later, the earlier of equals."""
    left, right = best[:len(best) - shift], best[shift:]
    out = best.copy()
    out[:len(left)] = np.where(values[left] <= values[right], left, right)
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in sliced(batch, "text"):
            words = Words(part.column("text"))
            doc, _, place, value = anchored(words, words.hashes())
            if not len(doc):
                continue
            new = np.ones(len(doc), bool)
            new[1:] = place[1:] != place[:-1]
            doc, value = doc[new], value[new]
            order = np.lexsort((value, doc))
            doc, value = doc[order], value[order]
            first = np.ones(len(doc), bool)
            first[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
            at = np.flatnonzero(first)
            twice = np.diff(np.append(at, len(doc))) > 1
            rows = part.column("content").take(pa.array(doc[at]))
            yield pa.RecordBatch.from_arrays([_signed(value[at]), rows, pa.array(twice)], ["anchor", "content", "twice"])


_SEGMENT = "row long, place long, start int, windows int, group long, own boolean, text string"


def _emit_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of texts: maximal runs of windows whose anchors recur; with ``group``, all of a text that has copies."""
    for batch in batches:
        for part in sliced(batch, "text"):
            words = Words(part.column("text"))
            doc, first, _, value = anchored(words, words.hashes())
            if not len(doc):
                continue
            lists = part.column("anchors").fill_null([])
            known = lists.flatten().to_numpy().view(np.uint64)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            keep = np.zeros(len(doc), bool)
            ends, bounds = np.cumsum(sizes), np.searchsorted(doc, np.arange(len(part) + 1))
            for i in np.flatnonzero((np.diff(bounds) > 0) & (sizes > 0)):
                here = slice(bounds[i], bounds[i + 1])
                keep[here] = np.isin(value[here], known[ends[i] - sizes[i]:ends[i]])
            at = np.flatnonzero(keep)
            new = np.append(True, (doc[at[1:]] != doc[at[:-1]]) | (at[1:] != at[:-1] + 1))[:len(at)]
            begins = at[new]
            stops = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1] if len(at) else at
            # A text with copies, in pieces of whole windows.
            copied = part.column("group").is_valid().to_numpy(zero_copy_only=False)
            of_doc = np.flatnonzero(copied & (np.diff(bounds) > 0))
            more = [np.arange(bounds[i], bounds[i + 1], PIECE_WINDOWS) for i in of_doc]
            more_ends = [np.minimum(m + PIECE_WINDOWS, bounds[i + 1]) - 1 for m, i in zip(more, of_doc)]
            whole = np.concatenate([np.zeros(len(begins), bool), *(np.ones(len(m), bool) for m in more)])
            begins, stops = np.concatenate([begins, *more]), np.concatenate([stops, *more_ends])
            if not len(begins):
                continue
            left, right = words.start[first[begins]], words.end[first[stops] + WINDOW - 1]
            data = words.data.tobytes()
            texts = [data[a:b].decode() for a, b in zip(left.tolist(), right.tolist())]
            of = pa.array(doc[begins])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("row").take(of),
                    part.column("place").take(of),
                    pa.array(first[begins] - words.bounds[:-1][doc[begins]], pa.int32()),
                    pa.array(stops - begins + 1, pa.int32()),
                    pc.if_else(pa.array(whole), part.column("group").take(of), pa.scalar(None, pa.int64())),
                    part.column("own").take(of),
                    pa.array(texts, pa.string()),
                ],
                ["row", "place", "start", "windows", "group", "own", "text"],
            )


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order with ``at``, a number that grows by the windows before."""
    at = TaskContext.get().partitionId() << 40
    for batch in batches:
        counts = batch.column("windows").to_numpy().astype(np.int64)
        ends = at + np.cumsum(counts)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends - counts)], [*batch.schema.names, "at"])
        at = int(ends[-1]) if len(ends) else at


def _emit_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in sliced(batch, "text"):
            words = Words(part.column("text"))
            value, doc, first = word_runs(words.hashes(), words.bounds, WINDOW)
            check, _, _ = word_runs(words.hashes(1), words.bounds, WINDOW, 1)
            offset = first - words.bounds[:-1][doc]
            yield pa.RecordBatch.from_arrays(
                [_signed(value), pa.array(check.astype(np.uint32).view(np.int32)), pa.array(part.column("at").to_numpy()[doc] + offset), pa.array(offset, pa.int32())],
                ["value", "check", "at", "offset"],
            )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages cut from segments, as texts; ``cuts`` has those of one segment."""
    for batch in batches:
        for part in sliced(batch, "text"):
            words = Words(part.column("text"))
            data = words.data.tobytes()
            lists = part.column("cuts")
            of = np.repeat(np.arange(len(part)), lists.value_lengths().to_numpy(zero_copy_only=False))
            cuts = lists.flatten()
            offset, count = cuts.field("offset").to_numpy(), cuts.field("windows").to_numpy()
            at = words.bounds[:-1][of] + offset
            left, right = words.start[at], words.end[at + count + WINDOW - 2]
            texts = [data[a:b].decode() for a, b in zip(left.tolist(), right.tolist())]
            start = part.column("start").to_numpy()[of] + offset
            yield pa.RecordBatch.from_arrays(
                [part.column("row").take(pa.array(of)), pa.array(start, pa.int32()), *(cuts.field(c) for c in ("windows", "piece", "own")), pa.array(texts, pa.string())],
                ["row", "start", "windows", "piece", "own", "text"],
            )


def _located(passages: pa.Table) -> pa.Table:
    """Runs of windows of the other passages that an automaton of the own ones' windows finds."""
    own = passages.column("own")
    patterns, stream = passages.filter(own), passages.filter(pc.invert(own))
    found: list[tuple[int, int, int]] = []
    letters: dict[str, str] = {}

    def coded(text: str) -> str:
        # Code points from 1 on, without the surrogates; a shard has far fewer words.
        out = []
        for word in _split(text):
            letter = letters.get(word)
            if letter is None:
                n = len(letters) + 1
                letter = letters[word] = chr(n if n < 0xD800 else n + 0x800)
            out.append(letter)
        return "".join(out)

    # A window holds one tile at least: TILE words from a multiple of STRIDE on.
    phrases = [coded(text) for text in patterns.column("text").to_pylist()]
    tiles: dict[str, list[tuple[int, int]]] = {}
    for p, phrase in enumerate(phrases):
        for at in range(0, len(phrase) - TILE + 1, STRIDE):
            tiles.setdefault(phrase[at:at + TILE], []).append((p, at))
    automaton = ahocorasick.Automaton()
    for tile, places in tiles.items():
        automaton.add_word(tile, places)
    automaton.make_automaton()
    if len(automaton):
        known = letters.get
        for row, start, text in zip(*(stream.column(c).to_pylist() for c in ("row", "start", "text"))):
            code = "".join([known(w, "\0") for w in _split(text)])
            found += [(row, start + a, n) for a, n in _windows_in(code, automaton, phrases)]
    columns = list(zip(*found)) or [(), (), ()]
    return pa.table({"row": pa.array(columns[0], pa.int64()), "start": pa.array(columns[1], pa.int32()), "windows": pa.array(columns[2], pa.int32())})


def _windows_in(code: str, automaton: ahocorasick.Automaton, phrases: list[str]) -> list[tuple[int, int]]:
    """Runs of windows of ``code`` that some phrase has: first window and number of windows."""
    # How far a phrase has been compared at a shift against the text.
    done: dict[tuple[int, int], int] = {}
    spans = []
    for end, places in automaton.iter(code):
        begin = end - TILE + 1
        for p, at in places:
            key = (p, begin - at)
            if done.get(key, -1) >= end:
                continue
            phrase = phrases[p]
            left = _common(phrase[:at][::-1], code[:begin][::-1])
            right = _common(phrase[at + TILE:], code[end + 1:])
            done[key] = end + right
            if left + TILE + right >= WINDOW:
                spans.append((begin - left, end + right - WINDOW + 2))
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][0] + out[-1][1]:
            first, n = out[-1]
            out[-1] = (first, max(n, b - first))
        else:
            out.append((a, b - a))
    return out


def _common(a: str, b: str) -> int:
    """Length of the common beginning, by halving steps over whole comparisons."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


_OTHER_SPACES = str.maketrans({c: " " for c in "\t\n\v\f\r"})


def _split(text: str) -> list[str]:
    return [w for w in text.translate(_OTHER_SPACES).split(" ") if w]


def keyed(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row``: a hash of id and text, which names a document; ``place``: its order."""
    return df.select(
        F.xxhash64(doc_id, text).alias("row"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1)).alias("place"),
        F.xxhash64(text).alias("content"),
        F.col(text).alias("text"),
    )


def repeated_runs(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, start, windows): runs of consecutive windows that also start earlier."""
    docs = keyed(df, doc_id, text).where("text IS NOT NULL")
    anchors = stored(docs.mapInArrow(_emit_anchors, "anchor long, content long, twice boolean"), "anchors")
    # An anchor recurs if two texts have it, or one has it twice.
    sides = anchors.groupBy("anchor").agg(F.min("content").alias("low"), F.max("content").alias("high"), F.max("twice").alias("twice"))
    recurring = sides.where("low <> high OR twice").select("anchor")
    wanted = anchors.join(recurring, "anchor").groupBy("content").agg(F.collect_set("anchor").alias("anchors"))

    names = stored(docs.select("content", "place", "row").distinct(), "names")
    first = names.groupBy("content").agg(F.min(F.struct("place", "row")).alias("first"), F.count("*").alias("n"))
    first = first.select("content", F.col("first.row").alias("first_row"), "n")
    copied = names.join(first, "content").where("n > 1").select("row", F.col("content").alias("group"), (F.col("row") == F.col("first_row")).alias("own"))
    parts = wanted.join(first, "content").select(F.col("first_row").alias("row"), "anchors").join(copied, "row", "full")
    found = docs.select("row", "place", "text").join(stored(parts, "parts"), "row").mapInArrow(_emit_segments, _SEGMENT)
    # Rows of one id and text have the same segments.
    found = stored(found, "segments")
    recurs = found.where("group IS NULL").dropDuplicates(["row", "start"]).select("row", "place", "start", "windows", "text")
    order = ["place", "row", "start"]
    ordered = recurs.repartitionByRange(partitions(df), *order).sortWithinPartitions(*order)
    segments = stored(ordered.mapInArrow(_numbered, "row long, place long, start int, windows int, text string, at long"), "ordered")
    windows = segments.select("at", "text").mapInArrow(_emit_windows, "value long, check int, at long, offset int")
    earliest = windows.groupBy("value", "check").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    both = windows.join(stored(earliest, "earliest"), ["value", "check"])
    piece = F.floor(F.col("first") / PIECE_WINDOWS).alias("piece")
    marks = both.select((F.col("at") - F.col("offset")).alias("at"), "offset", (F.col("at") == F.col("first")).alias("own"), piece)
    passages = segments.join(stored(_runs(marks), "cuts"), "at").mapInArrow(_cut, _PASSAGE)
    whole = found.where("group IS NOT NULL").dropDuplicates(["row", "start"])
    # Pieces of a text and of its copies begin at the same words.
    whole = whole.select("row", "start", "windows", F.xxhash64("group", "start").alias("piece"), "own", "text")
    return _confirmed(stored(passages.unionByName(whole), "passages"))


_PASSAGE = "row long, start int, windows int, piece long, own boolean, text string"


def _confirmed(passages: DataFrame) -> DataFrame:
    """Runs of windows that the automata find, of the passages that are no first occurrences."""
    total = passages.where("own").agg(F.sum("windows")).first()[0] or 0
    shards = max(1, -(-total // SHARD_WINDOWS))
    sharded = passages.withColumn("shard", F.pmod("piece", F.lit(shards)))
    words = F.sum(F.when(~F.col("own"), F.col("windows") + WINDOW - 1))
    salts = stored(sharded.groupBy("shard").agg(F.greatest(F.lit(1), F.ceil(words / STREAM_WORDS)).cast("int").alias("salts")), "salts")
    # Patterns go to every salt of their shard, an occurrence to one.
    every = F.sequence(F.lit(0), F.col("salts") - 1)
    one = F.array(F.pmod(F.xxhash64("row", "start"), F.col("salts")).cast("int"))
    dealt = sharded.join(salts, "shard").select("shard", F.explode(F.when(F.col("own"), every).otherwise(one)).alias("salt"), "own", "row", "start", "text")
    return dealt.groupBy("shard", "salt").applyInArrow(_located, "row long, start int, windows int")


def _runs(marks: DataFrame) -> DataFrame:
    """Per segment the runs of consecutive windows of one piece: (offset, windows, piece, own)."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("marks")
            doc = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy(zero_copy_only=False))
            flat = lists.flatten()
            own = flat.field("own").to_numpy(zero_copy_only=False)
            offset, piece = flat.field("offset").to_numpy(), flat.field("piece").to_numpy()
            order = np.lexsort((offset, piece, own, doc))
            doc, own, offset, piece = doc[order], own[order], offset[order], piece[order]
            same = (doc[1:] == doc[:-1]) & (own[1:] == own[:-1]) & (piece[1:] == piece[:-1]) & (offset[1:] == offset[:-1] + 1)
            begins = np.flatnonzero(np.append(True, ~same)[:len(doc)])
            counts = np.diff(np.append(begins, len(doc)))
            struct = pa.StructArray.from_arrays(
                [pa.array(offset[begins], pa.int32()), pa.array(counts, pa.int32()), pa.array(piece[begins]), pa.array(own[begins], pa.bool_())],
                ["offset", "windows", "piece", "own"],
            )
            offsets = np.searchsorted(doc[begins], np.arange(len(batch) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("at"), pa.ListArray.from_arrays(pa.array(offsets), struct)], ["at", "cuts"])

    lists = marks.groupBy("at").agg(F.collect_list(F.struct("offset", "own", "piece")).alias("marks"))
    return lists.mapInArrow(runs, "at long, cuts array<struct<offset:int,windows:int,piece:long,own:boolean>>")


def without_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``n_removed`` and ``kept``, the words kept joined by one space.

    Columns of these names are replaced.
    """
    df = df.drop("n_words", "n_removed", "kept")
    names = df.columns
    runs = stored(repeated_runs(df, doc_id, text), "runs")
    marks = runs.groupBy(F.col("row").alias("_row")).agg(F.collect_list(F.struct("start", "windows")).alias("_marks"))
    rows = df.withColumn("_key", F.xxhash64(doc_id, text)).join(marks, F.col("_key") == F.col("_row"), "left").drop("_key", "_row")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, text):
                words = Words(part.column(text))
                lists = part.column("_marks")
                sizes = lists.fill_null([]).value_lengths().to_numpy(zero_copy_only=False)
                marks = lists.flatten()
                begin = words.bounds[:-1][np.repeat(np.arange(len(part)), sizes)] + marks.field("start").to_numpy()
                # Each run covers its windows' words: +1 where it begins, -1 after it ends.
                change = np.bincount(begin, minlength=len(words.start) + 1)
                change -= np.bincount(begin + marks.field("windows").to_numpy() + WINDOW - 1, minlength=len(change))
                keep = np.cumsum(change)[:-1] == 0
                data = words.data.tobytes()
                spans = list(zip(words.start.tolist(), words.end.tolist()))
                kept, removed = [], []
                for a, b in zip(words.bounds, words.bounds[1:]):
                    own = keep[a:b]
                    kept.append(b" ".join([data[x:y] for x, y in (spans[a:b] if own.all() else [spans[i] for i in a + np.flatnonzero(own)])]).decode())
                    removed.append(int(b - a - own.sum()))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(words.counts()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                    [*names, "n_words", "n_removed", "kept"],
                )

    added = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    return rows.mapInArrow(remove, T.StructType([*df.schema.fields, *added.fields]))


def digest(docs: DataFrame) -> DataFrame:
    """Per document: counts of words and removed words, and SHA-256 of what is kept."""
    kept = without_repeats(docs.select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


# The same rule in SQL: a window by its words, its first occurrence, the words that others cover.
ORACLE = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i AS start, array_to_string(words[i:i + 19], ' ') AS phrase
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM split WHERE len(words) >= 20)
), repeats AS (
  SELECT doc_id, start FROM windows
  QUALIFY row_number() OVER (PARTITION BY phrase ORDER BY doc_id, start) > 1
), covered AS (
  SELECT DISTINCT doc_id, start + k AS place FROM repeats, range(20) AS r(k)
), spread AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM split
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
  FROM spread ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""

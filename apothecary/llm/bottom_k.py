"""Document fingerprints: bottom-k sketches of shingle hashes.

A shingle is a run of twelve bytes that begins at a character; a shorter text is
one shingle, an empty or null text has none. A sketch is the k smallest of the
distinct shingles' hashes in ascending order. The k smallest of two sketches'
union are the sketch of both texts together; how many of them lie in both
estimates the resemblance, exactly while the union has at most k shingles. Two
empty sketches are alike (1), an empty and another are not (0).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apothecary.llm.bpe import with_column
from apothecary.llm.order import partitions
from apothecary.llm.textvec import byte_sums, flat, sliced, span_hashes

K = 128
SHINGLE = 12
BITS = 48
_TOP = np.uint64(64 - BITS)


def _smallest(doc: np.ndarray, hashes: np.ndarray, n: int, k: int) -> list[np.ndarray]:
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    doc, hashes = doc[first], hashes[first]
    bounds = np.searchsorted(doc, np.arange(n + 1))
    return [hashes[a:min(a + k, b)] for a, b in zip(bounds, bounds[1:])]


def sketches(texts: pa.Array, k: int = K) -> list[np.ndarray]:
    """The bottom-k sketch of each text."""
    data, offsets = flat(texts)
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    counts = np.where(sizes > 0, np.maximum(sizes - SHINGLE + 1, 1), 0)
    doc = np.repeat(np.arange(n), counts)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[:-1][doc]
    whole = (data[start] & 0xC0) != 0x80
    doc, start = doc[whole], start[whole]
    end = np.minimum(start + SHINGLE, offsets[1:][doc])
    hashes = span_hashes(byte_sums(data), start, end) >> _TOP
    # Far more hashes than asked for: those below a bound hold the smallest k, or else all are looked at.
    limit = np.minimum(1.0, 3.0 * k / np.maximum(np.bincount(doc, minlength=n), 1))
    low = hashes < (limit * 2.0**BITS).astype(np.uint64)[doc]
    out = _smallest(doc[low], hashes[low], n, k)
    short = [i for i in range(n) if len(out[i]) < k and limit[i] < 1]
    if short:
        bounds = np.searchsorted(doc, np.arange(n + 1))
        for i in short:
            out[i] = np.unique(hashes[bounds[i]:bounds[i + 1]])[:k]
    return out


def merged(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity of the shingle sets."""
    union = merged(a, b, k)
    if not len(union):
        return 1.0
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, both, assume_unique=True).sum() / len(union))


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[k - 1]) + 1) / 2.0**BITS)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    own = distinct_shingles(a, k)
    return min(1.0, resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k) / own) if own else 1.0


def packed(sketch: np.ndarray) -> str:
    """A sketch as text: six bytes a hash, big-endian, in base64."""
    return base64.b64encode(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def unpacked(text: str) -> np.ndarray:
    six = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, BITS // 8)
    return np.pad(six, ((0, 0), (2, 0))).reshape(-1).view(">u8").astype(np.uint64)


def fingerprinted(df: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``df`` with the packed sketch of each text in a column ``name``, in place of one of that name."""
    df = df.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, text):
                found = [packed(s) for s in sketches(part.column(text))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string())], [*part.schema.names, name])

    return df.mapInArrow(run, with_column(df, name, T.StringType()))


def merged_by(df: DataFrame, key: str, name: str = "fingerprint", k: int = K) -> DataFrame:
    """One fingerprint a key: that of all its texts together, for instance of the parts of one.

    Hashes are made distinct and cut to a key's k smallest before and after the
    shuffle, so a key with many rows does not meet in one task.
    """
    raw = F.hex(F.unbase64(name))
    size = 2 * (BITS // 8)
    places = F.when(F.length(raw) > 0, F.sequence(F.lit(0), (F.length(raw) / size - 1).cast("int"))).otherwise(F.array())
    hashes = df.select(key, F.explode(F.transform(places, lambda i: F.substring(raw, i * size + 1, size))).alias("h")).distinct()
    smallest = hashes.withColumn("at", F.row_number().over(Window.partitionBy(key).orderBy("h"))).where(F.col("at") <= k)
    text = F.base64(F.unhex(F.array_join(F.array_sort(F.collect_list("h")), "")))
    found = smallest.groupBy(key).agg(F.regexp_replace(text, "\\s", "").alias(name))
    keys = df.select(F.col(key).alias("_key")).distinct()
    return keys.join(found, F.col("_key").eqNullSafe(F.col(key)), "left").select(F.col("_key").alias(key), F.coalesce(name, F.lit("")).alias(name))


def _heads(docs: DataFrame) -> np.ndarray:
    """The largest doc_id of each of some ranges of doc_id, ascending: one number a partition."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    ranged = ids.repartitionByRange(partitions(docs), "doc_id")
    rows = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.max("doc_id").alias("head")).collect()
    return np.array(sorted({r["head"] for r in rows}), np.int64)


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text) for every row, in descending order of doc_id; after the last comes the first.

    Texts are shuffled once, by range of doc_id. The first documents of a range also
    go to the range before it. Rows of equal doc_id are ordered by text; null ids come last.
    """
    heads = _heads(docs)
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").fill_null(0).to_numpy()
            # Ranges count from the largest ids; null ids are in the last.
            last = max(len(heads) - 1, 0)
            at = np.where(known, last - np.searchsorted(heads, ids), last)
            first = known & np.isin(ids, heads)
            before = np.where(at == 0, last, at - 1)
            for part, where, guard in ((batch, at, False), (batch.filter(pa.array(first)), before[first], True)):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(where, pa.int32()), pa.array(np.full(len(where), guard))], ["doc_id", "text", "part", "guard"]
                )

    dealt = columns.mapInArrow(deal, "doc_id long, text string, part int, guard boolean")
    placed = dealt.repartitionById(partitions(docs), "part").sortWithinPartitions("part", "guard", F.desc_nulls_last("doc_id"), "text")

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for small in sliced(batch, "text"):
                rows = small if held is None else pa.concat_batches([held, small])
                # The last row waits for the next slice.
                held = rows.slice(len(rows) - 1)
                yield from _paired(rows)
        if held is not None:
            yield from _paired(pa.concat_batches([held, held.slice(0, 0)]), alone=True)

    return placed.mapInArrow(pair, "doc_id long, text string, next_text string")


def _paired(rows: pa.RecordBatch, alone: bool = False) -> Iterator[pa.RecordBatch]:
    if alone:
        # Only a row without any other in its range is left without a guard: the table's one range of null ids.
        if not rows.column("guard")[0].as_py():
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("text"), rows.column("text")], ["doc_id", "text", "next_text"])
        return
    if len(rows) < 2:
        return
    own, other = rows.slice(0, len(rows) - 1), rows.slice(1)
    kept = own.column("guard").to_numpy(zero_copy_only=False) == 0
    keep = pa.array(kept)
    yield pa.RecordBatch.from_arrays(
        [own.column("doc_id").filter(keep), own.column("text").filter(keep), other.column("text").filter(keep)], ["doc_id", "text", "next_text"]
    )


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def comparisons(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they and the next are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text"):
                texts = part.column("text").fill_null("")
                following = part.column("next_text").fill_null("")
                changed = [edited(a, b) for a, b in zip(texts.to_pylist(), following.to_pylist())]
                own, new = sketches(texts), sketches(pa.array(changed, pa.string()))
                # The next document's sketch is taken once: as that of the next row where it is the same text.
                after = own[1:] + sketches(following.slice(len(following) - 1))
                same = np.append(texts.slice(1).to_numpy(zero_copy_only=False) == following.slice(0, len(following) - 1).to_numpy(zero_copy_only=False), True)
                for i in np.flatnonzero(~same):
                    after[i] = sketches(following.slice(i, 1))[0]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(t) for t in texts.to_pylist()], pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                        pa.array(map(packed, own), pa.string()),
                        pa.array(map(packed, new), pa.string()),
                        pa.array([resemblance(a, b) for a, b in zip(own, new)]),
                        pa.array([resemblance(a, b) for a, b in zip(own, after)]),
                    ],
                    ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    kinds = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs).mapInArrow(run, kinds)

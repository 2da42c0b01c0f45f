"""Texts of an Arrow batch as flat numpy arrays: words, and hashes of word runs.

Everything here works on the UTF-8 bytes of many texts at once. A null text is
an empty one. Words are runs of bytes other than space and tab to carriage
return, so word bounds never fall inside a character.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space of the word rule.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SLICE_BYTES = 1 << 19
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
_SEEDED = np.random.default_rng(20240229)
_BYTE_VALUE = _SEEDED.integers(1, 1 << 63, (2, 256), dtype=np.uint64) | np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_WORD_BASES = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base modulo 2**64, and of its inverse."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            row = np.full(size, b, np.uint64)
            row[0] = 1
            pair.append(np.multiply.accumulate(row))
        have = (pair[0], pair[1])
        if size <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have[0][:n], have[1][:n]


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each begins and the last ends."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def sliced(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose texts come to about ``limit`` bytes; a longer text is a part."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield batch.slice(begin)
    hand_back()


def hand_back() -> None:
    """Return freed memory to the system: Spark keeps Python workers for later tasks."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


class Words:
    """Words of a batch of texts: ``start`` and ``end`` bytes, ``bounds`` of each text's words.

    ``breaks``: for each byte, whether it separates words.
    """

    def __init__(self, texts: pa.Array, lower: bool = False, breaks: np.ndarray = _IS_SPACE):
        self.data, self.offsets = flat(texts)
        if lower:
            self.data = LOWER[self.data]
        n = len(self.data)
        inside = ~breaks[self.data]
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        firsts = self.offsets[:-1]
        before[firsts[firsts < n]] = False
        lasts = self.offsets[1:]
        after[lasts[lasts > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.bounds = np.searchsorted(self.start, self.offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return span_hashes(byte_sums(self.data, which), self.start, self.end, which)

    def runs(self, k: int, which: int = 0, short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, text number and first word of each run of ``k`` words.

        ``short``: a text with fewer words, but some, has one run of them all.
        """
        words = self.hashes(which)
        bounds = self.bounds
        hashes, doc, first = word_runs(words, bounds, k, which)
        if short:
            few = np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < k))
            if len(few):
                extra = _value_runs(words, bounds[few], bounds[few + 1], which)
                order = np.argsort(np.concatenate([doc, few]), kind="stable")
                hashes = np.concatenate([hashes, extra])[order]
                first = np.concatenate([first, bounds[few]])[order]
                doc = np.concatenate([doc, few])[order]
        return hashes, doc, first


def byte_sums(data: np.ndarray, which: int = 0) -> np.ndarray:
    """Sums over the bytes before each place, from which ``span_hashes`` takes differences."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[which][data] * powers(_BASES[which], len(data) + 1)[0][:-1], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of byte spans; the length is part of the hash."""
    inverse = powers(_BASES[which], len(sums))[1]
    return mixed((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def _value_runs(words: np.ndarray, begin: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    power, inverse = powers(_WORD_BASES[which], len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[:-1], out=sums[1:])
    return mixed((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def word_runs(words: np.ndarray, bounds: np.ndarray, k: int, which: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number and first word of each run of k words inside one text."""
    counts = np.maximum(np.diff(bounds) - (k - 1), 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    first = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[:-1][doc]
    return _value_runs(words, first, first + k, which), doc, first

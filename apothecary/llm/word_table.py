"""Ids of whole texts from the ids of their words, as flat arrays.

A text is cut where no match of the byte-level pattern (``public_tokenizers.PATTERN``)
crosses, and where what stands on the other side doesn't change one: before a space or line
feed that follows something other than white space, after such a line feed if no white
space comes next, and between a letter and an ASCII character that is none. Letters are
those of ASCII and of U+00C0 to U+017F; other places are left uncut.

Words repeat, so each is encoded once while it stays in a table of bounded size. The table
is found by hash and confirmed byte by byte. Words of more than ``LONGEST`` bytes are never
kept.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from apothecary.llm.textvec import byte_sums, span_hashes

KEPT_WORDS = 1 << 20
LONGEST = 64
CHUNK_BYTES = 1 << 20
_SPACE, _FEED = 0x20, 0x0A
_WHITE = np.zeros(256, bool)
_WHITE[[*range(0x09, 0x0E), _SPACE]] = True
_ASCII = np.arange(256) < 0x80
_SOLID = _ASCII & ~_WHITE
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_NO_LETTER = _ASCII & ~_LETTER
# UTF-8 of the characters that Unicode calls white space, by their last bytes.
_TWO = np.array([0xC285, 0xC2A0])
_THREE = np.array([0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])

# Ids in a row, and their number for each of the words at (begin, end).
Encode = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _latin(lead: np.ndarray) -> np.ndarray:
    """Whether bytes begin a character of U+00C0 to U+017F."""
    return (lead >= 0xC3) & (lead <= 0xC5)


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where words begin in the bytes of texts."""
    mark = np.zeros(len(data) + 1, bool)
    letter = _LETTER[data]
    # The signs for times and divided by are no letters.
    letter[1:] |= _latin(data[:-1]) & ((data[:-1] != 0xC3) | ((data[1:] != 0x97) & (data[1:] != 0xB7)))
    mark[1:-1] = letter[:-1] & _NO_LETTER[data[1:]]
    at = np.flatnonzero((data == _SPACE) | (data == _FEED))
    at = at[at > 0]
    last = data[at - 1]
    white = _WHITE[last]
    wide = np.flatnonzero(~_ASCII[last] & (at > 1))
    if len(wide):
        two = data[at[wide] - 2].astype(np.int64) << 8 | last[wide]
        three = data[np.maximum(at[wide] - 3, 0)].astype(np.int64) << 16 | two
        white[wide] = np.isin(two, _TWO) | np.isin(three, _THREE)
    at = at[~white]
    mark[at] = True
    # A text that begins with a line feed has no cut before it, so none after.
    feed = at[(data[at] == _FEED) & (at < len(data) - 1)]
    feed = feed[~np.isin(feed, offsets)]
    after = data[feed + 1]
    mark[feed[_SOLID[after] | _latin(after)] + 1] = True
    mark[offsets] = True
    return np.flatnonzero(mark[:-1])


def joinable(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Words that keep their ids in a row of such: from a space to something other than white space."""
    return (data[begin] == _SPACE) & (_SOLID[data[end - 1]] | ((end - begin > 2) & _latin(data[np.maximum(end - 2, 0)])))


def spans(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All places of spans, one span after the other."""
    before = np.cumsum(length) - length
    return np.repeat(begin - before, length) + np.arange(int(length.sum()))


class _Pool:
    """Runs of values one after the other, in an array that grows."""

    def __init__(self, kind: type):
        self.values, self.used = np.zeros(1 << 16, kind), 0

    def add(self, values: np.ndarray) -> int:
        begin, self.used = self.used, self.used + len(values)
        if self.used > len(self.values):
            grown = np.zeros(max(self.used, 2 * len(self.values)), self.values.dtype)
            grown[:begin] = self.values[:begin]
            self.values = grown
        self.values[begin:self.used] = values
        return begin


class WordTable:
    def __init__(self, encode_words: Encode):
        self.encode_words = encode_words
        self.clear()

    def clear(self) -> None:
        self.slots = np.full(2 * KEPT_WORDS, -1, np.int32)
        self.hash, self.bytes, self.ids = _Pool(np.uint64), _Pool(np.uint8), _Pool(np.uint32)
        self.byte_begin, self.n_bytes, self.id_begin, self.n_ids = (_Pool(np.int64) for _ in range(4))

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The word of each hash, or -1."""
        found = np.full(len(hashes), -1, np.int64)
        mask = np.uint64(len(self.slots) - 1)
        open_, slot = np.arange(len(hashes)), (hashes & mask).astype(np.int64)
        while len(open_):
            word = self.slots.take(slot)
            same = (word >= 0) & (self.hash.values.take(np.maximum(word, 0)) == hashes[open_])
            found[open_[same]] = word[same]
            on = (word >= 0) & ~same
            open_, slot = open_[on], (slot[on] + 1) & int(mask)
        return found

    def _keep(self, hashes: np.ndarray, data: np.ndarray, begin: np.ndarray, length: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Add words of different hashes; returns their numbers."""
        first = self.hash.add(hashes)
        self.byte_begin.add(self.bytes.add(data[spans(begin, length)]) + np.cumsum(length) - length)
        self.n_bytes.add(length)
        self.id_begin.add(self.ids.add(ids) + np.cumsum(counts) - counts)
        self.n_ids.add(counts)
        words = np.arange(first, first + len(hashes))
        mask = len(self.slots) - 1
        left, slot = words, (hashes & np.uint64(mask)).astype(np.int64)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            # Of words that want one slot, one got it.
            on = self.slots[slot] != left
            left, slot = left[on], (slot[on] + 1) & mask
        return words

    def _chunk(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that fill ``data``, and how many each has."""
        length = end - begin
        hashes = span_hashes(byte_sums(data), begin, end)
        word = self._find(hashes)
        short = length <= LONGEST
        new = np.flatnonzero((word < 0) & short)
        if len(new):
            kinds, first, which = np.unique(hashes[new], return_index=True, return_inverse=True)
            if self.hash.used + len(kinds) > KEPT_WORDS:
                self.clear()
                word[:] = -1
                new = np.flatnonzero(short)
                kinds, first, which = np.unique(hashes[new], return_index=True, return_inverse=True)
            some = new[first]
            ids, counts = self.encode_words(data, begin[some], end[some])
            word[new] = self._keep(kinds, data, begin[some], length[some], ids, counts)[which]
        word[(word >= 0) & (self.n_bytes.values[word] != length)] = -1
        known = np.flatnonzero(word >= 0)
        own = self.bytes.values[spans(self.byte_begin.values[word[known]], length[known])]
        given = data if len(known) == len(word) else data[spans(begin[known], length[known])]
        wrong = np.flatnonzero(own != given)
        if len(wrong):
            ends = np.cumsum(length[known])
            word[known[np.searchsorted(ends, wrong, "right")]] = -1
        # Long words, and words of another's hash.
        rest = np.flatnonzero(word < 0)
        if not len(rest):
            counts = self.n_ids.values[word]
            return self.ids.values[spans(self.id_begin.values[word], counts)], counts
        ids, n_rest = self.encode_words(data, begin[rest], end[rest])
        known = np.flatnonzero(word >= 0)
        counts = np.zeros(len(word), np.int64)
        counts[known], counts[rest] = self.n_ids.values[word[known]], n_rest
        at = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.uint32)
        out[spans(at[known], counts[known])] = self.ids.values[spans(self.id_begin.values[word[known]], counts[known])]
        out[spans(at[rest], n_rest)] = ids
        return out, counts

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts in a row, and the number of each text's ids."""
        begin = cuts(data, offsets)
        if not len(begin):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        end = np.append(begin[1:], len(data))
        edges = np.searchsorted(begin, np.arange(0, len(data), CHUNK_BYTES))
        edges = np.unique(np.append(edges[edges < len(begin)], len(begin)))
        parts = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            at = begin[a]
            parts.append(self._chunk(data[at:end[b - 1]], begin[a:b] - at, end[a:b] - at))
        sums = np.append(0, np.cumsum(np.concatenate([counts for _, counts in parts])))
        bounds = sums[np.searchsorted(begin, offsets)]
        return np.concatenate([ids for ids, _ in parts]), np.diff(bounds)

"""Adaptive context-mixing range coder for token ids.

Ids are coded in blocks side by side, as the rows of arrays: a step codes one id of
each block, by models that all blocks share and that learn from a step when it is over.
Each block has its own output and a CRC-32 of its ids. Orders 2 and 1 remember which id
followed the same last two or one, with a confidence. An id is coded as a symbol: the id
order 2 predicts, the one order 1 predicts, or another id, which is then coded by order
0, the share each id had among those other ids. Each order keeps an adaptive
distribution of the symbols, orders 1 and 2 one for each confidence; for each pair of
confidences the three are mixed by weights that follow the share each order had in the
probability of what came.

All is integer arithmetic, and where blocks disagree on what to remember the largest
entry is taken, so decoding repeats encoding exactly.

Segment: magic, block length, number of ids, number of kinds of ids; per block CRC-32
and words of the range coder; then these words, block by block.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"CMR2"
BLOCK = 1024
MOST_ID = (1 << 16) - 1
# A place in the range: which symbol, then which id of order 0.
MIX_BITS = 10
ID_BITS = 20
SYMBOLS = 3
CONFIDENCES = 8
SLOTS = 1 << 20
WEIGHT_BITS = 15
RATE = 3
LEAST_WEIGHT = 1 << 8
MOST_COUNTED = 1 << 16
# The mix is made anew after each of the first steps, then every few.
EACH_STEP = 16
STEPS_A_MIX = 8
# Order 0 is made anew when it has seen this share more, and at least so many ids.
GROWTH = 4
FEWEST = 512
# Entries of orders 1 and 2: id and confidence, below the step they were made in.
_ENTRY_BITS = 19
_ENTRY = np.int32((1 << _ENTRY_BITS) - 1)
_STAMPS = (1 << (31 - _ENTRY_BITS)) - 1
_HEAD = struct.Struct("<4sIQI")
_PLACE_BITS = np.uint64(MIX_BITS + ID_BITS)
_MOST_PLACE = np.uint64((1 << (MIX_BITS + ID_BITS)) - 1)
_LEAST_SPAN = np.uint64(1 << 32)
_WORD = np.uint64(32)
_ID_BITS = np.uint64(ID_BITS)


class _Models:
    """The models of a segment, and what each block saw last."""

    def __init__(self, lanes: int, kinds: int):
        self.kinds = kinds
        self.seen1 = np.zeros(MOST_ID + 1, np.int32)
        self.seen2 = np.zeros(SLOTS, np.int32)
        self.last1 = np.zeros(lanes, np.int64)
        self.last2 = np.zeros(lanes, np.int64)
        self.steps = 0
        # Symbols by order: alike (both predict one id), confidence of order 1, of order 2, symbol.
        self.count0 = np.ones((2, 1, 1, SYMBOLS), np.int64)
        self.count1 = np.ones((2, CONFIDENCES, 1, SYMBOLS), np.int64)
        self.count2 = np.ones((2, 1, CONFIDENCES, SYMBOLS), np.int64)
        shape = (2, CONFIDENCES, CONFIDENCES, 1)
        self.weight1 = np.full(shape, (1 << WEIGHT_BITS) // 3, np.int64)
        self.weight2 = np.full(shape, (1 << WEIGHT_BITS) // 3, np.int64)
        self.came: list[np.ndarray] = []
        self._mix()
        self.others = np.zeros(kinds, np.int64)
        self.waiting: list[np.ndarray] = []
        self.n_waiting, self.n_others = 0, 0
        self._order0()

    def _shares(self) -> list[np.ndarray]:
        return [(c << WEIGHT_BITS) // c.sum(-1, keepdims=True) for c in (self.count0, self.count1, self.count2)]

    def _mix(self) -> None:
        """Begin and width of each symbol, for each pair of confidences."""
        share0, share1, share2 = self._shares()
        weight0 = (1 << WEIGHT_BITS) - self.weight1 - self.weight2
        mixed = weight0 * share0 + self.weight1 * share1 + self.weight2 * share2
        # Every symbol keeps a place; what rounding leaves is the last one's.
        width = 1 + ((mixed * ((1 << MIX_BITS) - SYMBOLS)) >> (2 * WEIGHT_BITS))
        width[..., -1] = (1 << MIX_BITS) - width[..., :-1].sum(-1)
        begin = np.cumsum(width, -1) - width
        self.width, self.begin = (x.reshape(-1).astype(np.uint64) for x in (width, begin))

    def _learn(self) -> None:
        """What came since the last mix changes shares and weights."""
        cells = self.came[0] if len(self.came) == 1 else np.concatenate(self.came)
        self.came = []
        size = 2 * CONFIDENCES * CONFIDENCES * SYMBOLS
        count = np.bincount(cells, minlength=size).reshape(2, CONFIDENCES, CONFIDENCES, SYMBOLS)
        shares = self._shares()
        weights = ((1 << WEIGHT_BITS) - self.weight1 - self.weight2, self.weight1, self.weight2)
        parts = [w * s for w, s in zip(weights, shares)]
        total = np.maximum(parts[0] + parts[1] + parts[2], 1)
        seen = count.sum(-1, keepdims=True)
        for weight, part in ((self.weight1, parts[1]), (self.weight2, parts[2])):
            due = (count * ((part << WEIGHT_BITS) // total)).sum(-1, keepdims=True) // np.maximum(seen, 1)
            weight += np.where(seen > 0, (due - weight) >> RATE, 0)
            np.clip(weight, LEAST_WEIGHT, (1 << (WEIGHT_BITS - 1)) - LEAST_WEIGHT, out=weight)
        self.count0 += count.sum((1, 2), keepdims=True)
        self.count1 += count.sum(2, keepdims=True)
        self.count2 += count.sum(1, keepdims=True)
        for own in (self.count0, self.count1, self.count2):
            own >>= own.sum(-1, keepdims=True) > MOST_COUNTED
            np.maximum(own, 1, out=own)
        self._mix()

    def _order0(self) -> None:
        """Width of each id among others, as far as known; every id keeps a place."""
        if self.waiting:
            self.others += np.bincount(np.concatenate(self.waiting), minlength=self.kinds)
            self.n_others += self.n_waiting
            self.waiting, self.n_waiting = [], 0
        spare = (1 << ID_BITS) - self.kinds
        width = 1 + (self.others * spare // self.n_others if self.n_others else np.full(self.kinds, spare // self.kinds))
        width[-1] += (1 << ID_BITS) - width.sum()
        self.id_width = width.astype(np.uint64)
        self.id_begin = (np.cumsum(width) - width).astype(np.uint64)
        self.id_at = None

    def other(self, place: np.ndarray) -> np.ndarray:
        """The ids at places of order 0."""
        if self.id_at is None:
            self.id_at = np.repeat(np.arange(self.kinds, dtype=np.uint16), self.id_width.astype(np.int64))
        return self.id_at.take(place)

    def predict(self, k: int) -> np.ndarray:
        """For each of the first ``k`` blocks, where the mix of its confidences begins."""
        self.at1 = self.last1[:k]
        self.at2 = (self.at1 * 0x9E3B1 + self.last2[:k] * 0x85EBCB) >> 3 & (SLOTS - 1)
        self.entry1, self.entry2 = self.seen1.take(self.at1) & _ENTRY, self.seen2.take(self.at2) & _ENTRY
        self.id1, self.id2 = self.entry1 >> 3, self.entry2 >> 3
        self.sure1, self.sure2 = self.entry1 & 7, self.entry2 & 7
        alike = (self.id1 == self.id2).view(np.int8)
        return (((alike * np.int32(CONFIDENCES) + self.sure1) * CONFIDENCES) + self.sure2) * SYMBOLS

    def update(self, k: int, cell: np.ndarray, ids: np.ndarray, others: np.ndarray) -> None:
        """``ids`` came, as the symbols of ``cell``; ``others`` are those that orders 1 and 2 missed."""
        stamp = self.steps % _STAMPS
        if stamp == 0:
            self.seen1 &= _ENTRY
            self.seen2 &= _ENTRY
        made = np.int32((stamp + 1) << _ENTRY_BITS)
        new = ids << 3
        for seen, at, entry, known, sure in ((self.seen1, self.at1, self.entry1, self.id1, self.sure1), (self.seen2, self.at2, self.entry2, self.id2, self.sure2)):
            entry = np.where(known == ids, entry + (sure < 7), np.where(sure > 1, entry - 2, new))
            entry |= made
            np.maximum.at(seen, at, entry)
        self.last2[:k] = self.last1[:k]
        self.last1[:k] = ids
        self.steps += 1
        self.came.append(cell)
        if self.steps <= EACH_STEP or self.steps % STEPS_A_MIX == 0:
            self._learn()
        self.waiting.append(others)
        self.n_waiting += len(others)
        if self.n_waiting >= max(FEWEST, self.n_others // GROWTH):
            self._order0()


def _shape(n: int, block: int) -> tuple[int, int]:
    """Number of blocks and length of the last."""
    lanes = max(1, -(-n // block))
    return lanes, n - (lanes - 1) * block


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A segment of ids below 65,536."""
    n = len(ids)
    kinds = int(ids.max()) + 1 if n else 1
    if kinds > MOST_ID + 1:
        raise ValueError("ids need more than sixteen bits")
    lanes, last = _shape(n, block)
    steps = min(block, n)
    grid = np.zeros((lanes, block), np.int32)
    grid.reshape(-1)[:n] = ids
    grid = np.ascontiguousarray(grid.T)
    models = _Models(lanes, kinds)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, ~np.uint64(0), np.uint64)
    # A step narrows a span by less than a word.
    words = np.zeros((lanes, steps + 2), np.uint32)
    row = np.arange(lanes) * (steps + 2)
    count = np.zeros(lanes, np.int64)
    for t in range(steps):
        k = lanes if t < last else lanes - 1
        x = grid[t, :k]
        cell = models.predict(k)
        missed = x != models.id2
        cell += missed
        missed &= x != models.id1
        cell += missed
        begin, width = models.begin.take(cell) << _ID_BITS, models.width.take(cell)
        other = np.flatnonzero(missed)
        named = x.take(other)
        share = width.take(other)
        width <<= _ID_BITS
        begin[other] += share * models.id_begin.take(named)
        width[other] = share * models.id_width.take(named)
        unit = span[:k] >> _PLACE_BITS
        begin *= unit
        low[:k] += begin
        over = low[:k] < begin
        if over.any():
            _carry(words, count, np.flatnonzero(over))
        np.multiply(width, unit, out=span[:k])
        small = np.flatnonzero(span[:k] < _LEAST_SPAN)
        if len(small):
            out = low.take(small)
            words.reshape(-1)[row.take(small) + count.take(small)] = (out >> _WORD).astype(np.uint32)
            count[small] += 1
            low[small] = out << _WORD
            span[small] <<= _WORD
        models.update(k, cell, x, named)
    for shift in (32, 0):
        words.reshape(-1)[row + count] = (low >> np.uint64(shift)).astype(np.uint32)
        count += 1
    whole = ids.astype("<u4")
    crc = [zlib.crc32(whole[a:a + block]) for a in range(0, lanes * block, block)]
    heads = np.array([crc, count], "<u4").T
    return b"".join([_HEAD.pack(MAGIC, block, n, kinds), heads.tobytes(), words[np.arange(steps + 2) < count[:, None]].astype("<u4").tobytes()])


def _carry(words: np.ndarray, count: np.ndarray, lanes: np.ndarray) -> None:
    at = count[lanes] - 1
    while len(lanes):
        words[lanes, at] += np.uint32(1)
        on = words[lanes, at] == 0
        lanes, at = lanes[on], at[on] - 1


def decode(data: bytes) -> np.ndarray:
    """The ids of a segment; a ValueError if a block is damaged."""
    magic, block, n, kinds = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("this is no segment")
    lanes, last = _shape(n, block)
    steps = min(block, n)
    heads = np.frombuffer(data, "<u4", 2 * lanes, _HEAD.size).reshape(lanes, 2)
    count = heads[:, 1].astype(np.int64)
    wide = int(count.max()) + 1
    words = np.zeros((lanes, wide), np.uint64)
    words[np.arange(wide) < count[:, None]] = np.frombuffer(data, "<u4", int(count.sum()), _HEAD.size + 8 * lanes)
    # Damaged blocks may read past their ends; their checksums tell.
    models = _Models(lanes, kinds)
    code = (words[:, 0] << _WORD) | words[:, 1]
    words = words.reshape(-1)
    at, end = np.arange(lanes) * wide + 2, np.arange(lanes) * wide + wide - 1
    span = np.full(lanes, ~np.uint64(0), np.uint64)
    grid = np.zeros((block if lanes > 1 else steps, lanes), np.int32)
    for t in range(steps):
        k = lanes if t < last else lanes - 1
        cell = models.predict(k)
        unit = span[:k] >> _PLACE_BITS
        place = np.minimum(code[:k] // unit, _MOST_PLACE)
        share = place >> _ID_BITS
        past = share >= models.begin.take(cell + 1)
        missed = share >= models.begin.take(cell + 2)
        cell += past
        cell += missed
        begin, width = models.begin.take(cell) << _ID_BITS, models.width.take(cell)
        x = np.where(past, models.id1, models.id2)
        other = np.flatnonzero(missed)
        share = width.take(other)
        named = models.other(((place.take(other) - begin.take(other)) // share).astype(np.int64)).astype(np.int32)
        x[other] = named
        width <<= _ID_BITS
        begin[other] += share * models.id_begin.take(named)
        width[other] = share * models.id_width.take(named)
        begin *= unit
        code[:k] -= begin
        np.multiply(width, unit, out=span[:k])
        small = np.flatnonzero(span[:k] < _LEAST_SPAN)
        if len(small):
            next_word = np.minimum(at.take(small), end.take(small))
            code[small] = (code.take(small) << _WORD) | words.take(next_word)
            at[small] += 1
            span[small] <<= _WORD
        grid[t, :k] = x
        models.update(k, cell, x, named)
    ids = np.ascontiguousarray(grid.T).reshape(-1)[:n].astype("<u4")
    for i, a in enumerate(range(0, lanes * block, block)):
        if zlib.crc32(ids[a:a + block]) != heads[i, 0]:
            raise ValueError(f"block {i} has another checksum")
    return ids.astype(np.uint32, copy=False)

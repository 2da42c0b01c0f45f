"""Token ids of a corpus in binary files, in ascending order of doc_id.

Texts are encoded as the tokenizers library does with ``add_special_tokens=False``: none
are added, and the string of one of the file's added tokens is that token. Each ends with an end id. Documents are dealt out by range of
doc_id; each task writes their ids as segments of the range coder's format, a few
million ids each. A document lies in one segment, whose directory has its id and
length. The files are a table of segments in the shared folder, so a lost executor
loses none of them.

A null text is an empty one: the end id alone. Null doc_ids come last; rows of equal
doc_id are ordered by text.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apothecary.llm.order import partitions, running_sum
from apothecary.llm.range_coder import decode, encode
from apothecary.llm.shared import stored
from apothecary.llm.textvec import flat, hand_back, sliced
from apothecary.llm.word_table import CHUNK_BYTES, LONGEST, WordTable, joinable, spans

END = 2
SEGMENT_IDS = 4 << 20
CACHED_PIECES = 300_000
JOINED_BYTES = 1 << 14
_SEGMENTS = "part int, segment int, n_ids long, doc_ids array<long>, lengths array<long>, data binary"


class Library:
    """Words encoded by a tokenizer file.

    Words that may stand in a row are encoded many at a time, as one text. Others are
    encoded piece by piece, as the library's own first step cuts them; pieces repeat even
    where words do not.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.cut = tokenizer.pre_tokenizer.pre_tokenize_str
        self.model = tokenizer.model
        self.whole = tokenizer.encode
        self.fast = tokenizer.encode_batch_fast
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        # The library's letter for each byte, for words that need no cut.
        self.letter = {b: self.cut(chr(b))[0][0] for b in range(128)}
        self.known: dict[str, bytes] = {}
        # A letter of a token stands for a byte.
        self.n_bytes = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
        for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
            self.n_bytes[i] = len(token)

    def piece(self, piece: str) -> bytes:
        ids = self.known.get(piece)
        if ids is None:
            ids = np.array([t.id for t in self.model.tokenize(piece)], "<u4").tobytes()
            if len(piece) <= LONGEST:
                if len(self.known) >= CACHED_PIECES:
                    self.known.clear()
                self.known[piece] = ids
        return ids

    def encode(self, words: list[str]) -> list[bytes]:
        out = []
        for word in words:
            if word.isascii() and word[1:].isalpha() and word[0] == " ":
                out.append(self.piece(self.letter[32] + word[1:]))
            elif word.isascii() and (word.isalpha() or word.isdigit()):
                out.append(self.piece(word))
            else:
                out.append(b"".join([self.piece(p) for p, _ in self.cut(word)]) if word else b"")
        return out

    def together(self, text: str, length: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of words in a row and each word's number; None if they don't end where words do."""
        if any(a in text for a in self.added):
            return None
        ids = np.array(self.fast([text], add_special_tokens=False)[0].ids, np.uint32)
        # The bytes that ids stand for tell which of them end a word.
        sums = np.append(0, np.cumsum(self.n_bytes[ids]))
        ends = np.cumsum(length)
        at = np.searchsorted(sums, ends)
        if at[-1] != len(ids) or not np.array_equal(sums[at], ends):
            return None
        return ids, np.diff(at, prepend=0)

    def encode_spans(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of a ``WordTable``."""
        length = end - begin
        row = joinable(data, begin, end)
        alone, some = np.flatnonzero(~row), np.flatnonzero(row)
        order, ids, counts = [], [], []
        for part in np.split(some, np.flatnonzero(np.diff(np.cumsum(length[some]) // JOINED_BYTES)) + 1):
            if not len(part):
                continue
            done = self.together(data[spans(begin[part], length[part])].tobytes().decode(), length[part])
            if done is None:
                alone = np.append(alone, part)
                continue
            order.append(part)
            ids.append(done[0])
            counts.append(done[1])
        packed = self.encode([data[a:b].tobytes().decode() for a, b in zip(begin[alone].tolist(), end[alone].tolist())])
        order.append(alone)
        ids.append(np.frombuffer(b"".join(packed), "<u4"))
        counts.append(np.fromiter(map(len, packed), np.int64, len(packed)) // 4)
        return in_order(np.concatenate(order), np.concatenate(ids), np.concatenate(counts))


def in_order(order: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ids, put where ``order`` says."""
    begin, sizes = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    begin[order], sizes[order] = np.cumsum(counts) - counts, counts
    return ids[spans(begin, sizes)], sizes


class Texts:
    """Whole texts encoded by a tokenizer file: those with an added token by the library, others word by word."""

    def __init__(self, path: str):
        self.library = Library(path)
        self.words = WordTable(self.library.encode_spans)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts in a row, and the number of each text's."""
        texts = pc.fill_null(texts, "")
        added = np.zeros(len(texts), bool)
        for token in self.library.added:
            added |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        ids, counts = self.words.encode(*flat(texts.filter(pa.array(~added))))
        if not added.any():
            return ids, counts
        whole = [np.array(self.library.whole(t, add_special_tokens=False).ids, np.uint32) for t in texts.filter(pa.array(added)).to_pylist()]
        order = np.append(np.flatnonzero(~added), np.flatnonzero(added))
        return in_order(order, np.concatenate([ids, *whole]), np.append(counts, [len(w) for w in whole]))


# Spark keeps Python workers, so the words of one task are known to the next.
_kept: dict[tuple, Texts] = {}


def _texts(path: str) -> Texts:
    state = os.stat(path)
    key = (path, state.st_size, state.st_mtime_ns)
    if key not in _kept:
        _kept.clear()
        _kept[key] = Texts(path)
    return _kept[key]


def _written(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = _texts(path)
        part, segment = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        names: list[int | None] = []
        lengths: list[int] = []
        size = 0

        def close() -> pa.RecordBatch:
            row = [[part], [segment], [size], [names], [lengths], [encode(np.concatenate(held))]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["part", "segment", "n_ids", "doc_ids", "lengths", "data"])

        for batch in batches:
            for small in sliced(batch, "text", CHUNK_BYTES):
                ids, counts = texts.encode(small.column("text"))
                ended = np.full(len(ids) + len(counts), END, np.uint32)
                ended[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
                ends = np.cumsum(counts + 1)
                own = small.column("doc_id").to_pylist()
                a, begin = 0, 0
                while a < len(own):
                    # Documents up to the one that fills the segment.
                    b = min(len(own), int(np.searchsorted(ends, begin + SEGMENT_IDS - size)) + 1)
                    end = int(ends[b - 1])
                    held.append(ended[begin:end])
                    names += own[a:b]
                    lengths += (counts[a:b] + 1).tolist()
                    size += end - begin
                    a, begin = b, end
                    if size >= SEGMENT_IDS:
                        yield close()
                        held, names, lengths, size, segment = [], [], [], 0, segment + 1
        if held:
            yield close()
        hand_back()

    return run


def write(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The segments of ``docs`` (doc_id, text), read from the files they were written to."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.asc_nulls_last("doc_id"), F.asc("text")]
    ranged = rows.repartitionByRange(partitions(docs), F.asc_nulls_last("doc_id")).sortWithinPartitions(*order)
    return stored(ranged.mapInArrow(_written(tokenizer_path), _SEGMENTS), "tokens")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            row = batch.slice(i, 1)
            ids = decode(row.column("data")[0].as_py())
            if len(ids) != row.column("n_ids")[0].as_py():
                raise ValueError("a segment has another number of ids than its directory says")
            lengths = row.column("lengths").flatten()
            ends = np.cumsum(lengths.to_numpy())
            data = memoryview(ids.astype("<u4").tobytes())
            begin = np.append(0, ends[:-1])
            crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(begin.tolist(), ends.tolist())]
            n = len(ends)
            back = pa.array(np.zeros(n, np.int64))
            yield pa.RecordBatch.from_arrays(
                [row.column("part").take(back), row.column("segment").take(back), row.column("doc_ids").flatten(), pa.array(begin.astype(np.int64)), lengths, pa.array(crc, pa.int64())],
                ["part", "segment", "doc_id", "offset", "n_tokens", "ids_crc32"],
            )


def read(segments: DataFrame) -> DataFrame:
    """Per document: (doc_id, start, n_tokens, ids_crc32), decoded from ``segments``."""
    # Written, as the join would otherwise decode more than once.
    kinds = "part int, segment int, doc_id long, offset long, n_tokens long, ids_crc32 long"
    docs = stored(segments.mapInArrow(_read, kinds), "decoded")
    starts = running_sum(segments.select("part", "segment", "n_ids"), [F.col("part"), F.col("segment")], "n_ids", "before")
    return docs.join(starts.select("part", "segment", "before"), ["part", "segment"]).select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )

"""Byte-level BPE encoding and decoding by the ranks of a tokenizer file.

Every match of the pattern is merged on its own. A segment tree over its byte
positions holds at each leaf the rank of the pair that begins there and at each
inner node the smallest rank below, the leftmost of equals. A merge takes the
root's pair and updates three leaves (the pair, its left neighbour, the position
that goes out of use), so it costs logarithmic time however long the match is.
Short matches are many, so their trees are rows of one array and are worked on
together; long ones are taken singly.

Texts without special tokens; a null text is an empty one. Ids are packed as
little-endian unsigned 32-bit integers in a binary column.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apothecary.llm.textvec import hand_back, sliced

WIDEST_ROW = 64
CACHED_WORDS = 400_000
ENCODED_BYTES = 2 << 20
NO_PAIR = np.int32((1 << 31) - 1)
NO_PAIR64 = np.int64(1) << np.int64(62)


class Ranks:
    """A rank file: which byte strings are tokens, and which pairs of tokens form one."""

    def __init__(self, path: str):
        self.ids: dict[bytes, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                token, rank = line.split()
                self.ids[base64.b64decode(token)] = int(rank)
        self.size = max(self.ids.values()) + 1
        pairs = []
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append((left * self.size + right, rank))
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.keys = np.append(table[:, 0], self.size**2)
        self.ranks = np.append(table[:, 1], NO_PAIR).astype(np.int32)
        self.pairs = dict(pairs)
        self.of_byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        by_id = [b""] * self.size
        for token, rank in self.ids.items():
            by_id[rank] = token
        self.length = np.array([len(t) for t in by_id], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * np.int64(self.size) + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NO_PAIR)

    def encode_rows(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids of pieces of 2 to ``width`` bytes, merged side by side."""
        n = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        ids = np.zeros((n, width + 1), np.int32)
        ids[:, :width] = self.of_byte[data]
        columns = np.arange(width, dtype=np.int32)
        live = np.zeros((n, width + 1), bool)
        live[:, :width] = columns < lengths[:, None]
        after = np.tile(np.arange(1, width + 2, dtype=np.int32), (n, 1))
        before = np.tile(np.arange(-1, width, dtype=np.int32), (n, 1))
        tree = np.full((n, 2 * width), NO_PAIR)
        pair = live[:, 1:]
        ranks = self.rank(ids[:, :width][pair], ids[:, 1:][pair])
        tree[:, width:][pair] = np.where(ranks < NO_PAIR, ranks * width + np.nonzero(pair)[1], NO_PAIR)
        for node in range(width - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])

        def put(row: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
            node = leaf + width
            tree[row, node] = value
            for _ in range(width.bit_length() - 1):
                node >>= 1
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

        def paired(row: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
            rank = self.rank(ids[row, left], ids[row, np.minimum(right, width)])
            return np.where((rank < NO_PAIR) & (right < lengths[row]), rank * width + left, NO_PAIR)

        row = np.flatnonzero(tree[:, 1] < NO_PAIR)
        while len(row):
            at, rank = tree[row, 1] % width, tree[row, 1] // width
            gone = after[row, at]
            follows = after[row, gone]
            ids[row, at] = rank
            live[row, gone] = False
            after[row, at] = follows
            before[row, np.minimum(follows, width)] = at
            put(row, gone, np.full(len(row), NO_PAIR))
            put(row, at, paired(row, at, follows))
            left = before[row, at]
            has = left >= 0
            put(row[has], left[has], paired(row[has], left[has], at[has]))
            row = row[tree[row, 1] < NO_PAIR]
        packed = ids[live].astype("<u4").tobytes()
        ends = (np.cumsum(live.sum(1)) * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def encode_long(self, piece: bytes) -> bytes:
        """Ids of one piece of any length."""
        n = len(piece)
        width = 1 << max(1, (n - 1).bit_length())
        none, size, pairs = int(NO_PAIR64), self.size, self.pairs
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.rank(np.array(ids[:-1]), np.array(ids[1:]))
        leaves = np.full(width, NO_PAIR64)
        leaves[:n - 1] = np.where(first < NO_PAIR, first.astype(np.int64) * width + np.arange(n - 1), NO_PAIR64)
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append(levels[-1].reshape(-1, 2).min(1))
        tree = [none, *np.concatenate(levels[::-1]).tolist()]

        def put(leaf: int, value: int) -> None:
            node = leaf + width
            tree[node] = value
            while node > 1:
                low = min(tree[node], tree[node ^ 1])
                node >>= 1
                if tree[node] == low:
                    break
                tree[node] = low

        def paired(left: int, right: int) -> int:
            rank = pairs.get(ids[left] * size + ids[right]) if right < n else None
            return none if rank is None else rank * width + left

        while tree[1] < none:
            rank, at = divmod(tree[1], width)
            gone = after[at]
            follows = after[gone]
            ids[at], after[at] = rank, follows
            if follows < n:
                before[follows] = at
            put(gone, none)
            put(at, paired(at, follows))
            if before[at] >= 0:
                put(before[at], paired(before[at], at))
        out, at = [], 0
        while at < n:
            out.append(ids[at])
            at = after[at]
        return np.array(out, "<u4").tobytes()

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.ids.get(piece)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(piece) > WIDEST_ROW:
                out[i] = self.encode_long(piece)
            elif piece:
                by_width.setdefault(max(2, 1 << (len(piece) - 1).bit_length()), []).append(i)
        for width, rows in by_width.items():
            step = max(1, (1 << 20) // width)
            for part in (rows[a:a + step] for a in range(0, len(rows), step)):
                for i, ids in zip(part, self.encode_rows([pieces[i] for i in part], width)):
                    out[i] = ids
        return out

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids in a row."""
        lengths = self.length[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.begin[ids] - (ends - lengths), lengths)
        return self.bytes[shift + np.arange(len(shift))]


# The characters that Unicode calls white space.
_SPACE = "\t-\r \x85\xa0  -     　"


class Words:
    """Texts as words that the pattern cannot reach across.

    A text is cut before each space that follows something other than white
    space; no match of the pattern crosses such a place. Words repeat, so each
    is encoded once while it stays in a cache of bounded size.
    """

    def __init__(self, encode_words) -> None:
        self.encode_words = encode_words
        self.known: dict[str | bytes, bytes] = {}
        self.odd = regex.compile(f"[{_SPACE}] ")
        self.cut = regex.compile(f"(?<=[^{_SPACE}]) ")

    def split(self, text: str) -> list[str]:
        """Words, of which all but the first begin with a space that is left out."""
        if " " in text[:1] or self.odd.search(text):
            return self.cut.split(text)
        return text.split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        # A first word has no space before it; its key in the cache is bytes.
        split = [self.split(t) if t else [] for t in texts]
        for words in split:
            if words:
                words[0] = words[0].encode()
        new = [w for w in set(chain.from_iterable(split)) if w not in self.known]
        if len(self.known) + len(new) > CACHED_WORDS:
            self.known.clear()
            new = list(set(chain.from_iterable(split)))
        whole = [w.decode() if isinstance(w, bytes) else " " + w for w in new]
        self.known.update(zip(new, self.encode_words(whole)))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


def rank_encoder(path: str, pattern: str) -> Words:
    # Only Unicode white space counts; the regex library adds separators of its own.
    exact = pattern.replace(r"[^\s", "[^" + _SPACE).replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]")
    ranks, matches = Ranks(path), regex.compile(exact)

    def encode(words: list[str]) -> list[bytes]:
        # A space and letters are one match.
        found = [[w] if w[1:].isalpha() and w[0] == " " else matches.findall(w) for w in words]
        ids = ranks.encode_pieces([m.encode() for m in chain.from_iterable(found)])
        at, out = 0, []
        for f in found:
            n = len(f)
            out.append(ids[at] if n == 1 else b"".join(ids[at:at + n]))
            at += n
        return out

    return Words(encode)


def with_column(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])


def encoded(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the packed ids of each text in a binary column ``ids``, in place of one of that name."""
    df = df.drop(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = rank_encoder(ranks_path, pattern)
        for batch in batches:
            for part in sliced(batch, text, ENCODED_BYTES):
                packed = words.encode(part.column(text).fill_null("").to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(packed, pa.binary())], [*part.schema.names, ids])
        del words
        hand_back()

    return df.mapInArrow(run, with_column(df, ids, T.BinaryType()))


def decoded(df: DataFrame, ranks_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the bytes that packed ``ids`` stand for in a binary column ``text``, in place of one of that name."""
    df = df.drop(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Ranks(ranks_path)
        for batch in batches:
            for part in sliced(batch, ids, 1 << 22):
                packed = part.column(ids).fill_null(b"").to_pylist()
                flat = np.frombuffer(b"".join(packed), "<u4")
                data = ranks.decode(flat).tobytes()
                counts = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
                ends = np.append(0, np.cumsum(ranks.length[flat]))[np.cumsum(counts)].tolist()
                texts = [data[a:b] for a, b in zip([0, *ends], ends)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], [*part.schema.names, text])
        del ranks
        hand_back()

    return df.mapInArrow(run, with_column(df, text, T.BinaryType()))


def digest(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document: count and SHA-256 of the ids, and SHA-256 of what they decode to."""
    # Both ways leave this stage as digests; ids and texts themselves go no further.
    both = decoded(encoded(docs.select("doc_id", "text"), ranks_path, pattern).drop("text"), ranks_path)
    return both.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

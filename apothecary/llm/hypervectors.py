"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A trigram is bound by multiplying
its letters' vectors, the first rolled by two places, the second by one; a text's
vector is the bundle (sum) of its trigrams' vectors; a language's prototype is the
bundle of its texts. A text gets the language whose prototype has the largest
cosine with its own vector, the smaller name on ties, and that cosine as score.

Letters are lower-cased; runs of other characters count as one space. A null text
or one without letters is ``und`` with score 0, and so is every text if there is
nothing to learn from. Texts without a language are not learned from.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apothecary.llm.bpe import with_column
from apothecary.llm.shared import stored
from apothecary.llm.textvec import sliced

DIMENSIONS = 1024
UNKNOWN = "und"
BUNDLE_TASKS = 16
_DENSE = 1 << 22
_CODE = np.uint64(21)
_MASK = np.uint64((1 << 21) - 1)
_SPACE = 32


@lru_cache(1)
def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


@lru_cache(4096)
def letter_vector(code: int) -> np.ndarray:
    bits = np.random.Generator(np.random.Philox(key=code)).integers(0, 2, DIMENSIONS, np.int8)
    return 2 * bits - 1


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and key of every trigram; a key packs three code points."""
    low = [" " + t.lower() + " " if t else "" for t in texts]
    sizes = np.fromiter(map(len, low), np.int64, len(low))
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(low)), sizes)
    is_letter = letters()[codes]
    # One space for each run of other characters; a text's own runs only.
    again = np.zeros(len(codes), bool)
    again[1:] = ~is_letter[1:] & ~is_letter[:-1] & (doc[1:] == doc[:-1])
    keep = ~again
    codes = np.where(is_letter, codes, _SPACE)[keep].astype(np.uint64)
    doc = doc[keep]
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    same = doc[2:] == doc[:-2]
    keys = (codes[:-2] << (_CODE * np.uint64(2))) | (codes[1:-1] << _CODE) | codes[2:]
    return doc[2:][same], keys[same]


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and for each key its place among them."""
    parts = np.stack([keys >> (_CODE * np.uint64(2)), (keys >> _CODE) & _MASK, keys & _MASK]).astype(np.int64)
    seen = np.zeros(sys.maxunicode + 1, bool)
    seen[parts.ravel()] = True
    alphabet = np.flatnonzero(seen)
    a = len(alphabet)
    if a**3 > _DENSE:
        return np.unique(keys, return_inverse=True)
    place = np.zeros(sys.maxunicode + 1, np.int64)
    place[alphabet] = np.arange(a)
    small = (place[parts[0]] * a + place[parts[1]]) * a + place[parts[2]]
    used = np.flatnonzero(np.bincount(small, minlength=a**3))
    rank = np.zeros(a**3, np.int64)
    rank[used] = np.arange(len(used))
    whole = alphabet.astype(np.uint64)
    distinct = (whole[used // (a * a)] << (_CODE * np.uint64(2))) | (whole[used // a % a] << _CODE) | whole[used % a]
    return distinct, rank[small]


def bound(keys: np.ndarray) -> np.ndarray:
    """The vectors of distinct trigrams."""
    codes = np.stack([keys >> (_CODE * np.uint64(2)), (keys >> _CODE) & _MASK, keys & _MASK]).astype(np.int64)
    alphabet, place = np.unique(codes, return_inverse=True)
    place = place.reshape(codes.shape)
    base = np.stack([letter_vector(int(c)) for c in alphabet])
    return np.roll(base, 2, 1)[place[0]] * np.roll(base, 1, 1)[place[1]] * base[place[2]]


def bundled(texts: list[str | None]) -> np.ndarray:
    """The vector of each text."""
    doc, keys = trigrams(texts)
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    if len(keys) == 0:
        return out
    distinct, place = counted(keys)
    # Blocks of trigrams keep the counts and vectors small also for large alphabets.
    step = 16_384
    for begin in range(0, len(distinct), step):
        inside = (place >= begin) & (place < begin + step) if len(distinct) > step else slice(None)
        wide = min(step, len(distinct) - begin)
        counts = np.bincount(doc[inside] * wide + place[inside] - begin, minlength=len(texts) * wide)
        out += counts.reshape(len(texts), wide).astype(np.float32) @ bound(distinct[begin:begin + step]).astype(np.float32)
    return out


def _counts_by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in sliced(batch, "text", 4 << 20):
            names = part.column("lang").to_pylist()
            langs = sorted(set(names))
            number = np.array([langs.index(x) for x in names])
            doc, keys = trigrams(part.column("text").to_pylist())
            if len(keys) == 0:
                continue
            distinct, place = counted(keys)
            counts = np.bincount(number[doc] * len(distinct) + place, minlength=len(langs) * len(distinct))
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(langs, object)[used // len(distinct)], pa.string()), pa.array(distinct[used % len(distinct)].astype(np.int64)), pa.array(counts[used])],
                ["lang", "trigram", "n"],
            )


def _partial_bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        names = np.array(batch.column("lang").to_pylist(), object)
        keys = batch.column("trigram").to_numpy().astype(np.uint64)
        counts = batch.column("n").to_numpy().astype(float)
        for begin in range(0, len(keys), 8192):
            part = slice(begin, begin + 8192)
            vectors = bound(keys[part]).astype(float)
            for lang in set(names[part]):
                here = names[part] == lang
                sums[lang] = sums.get(lang, 0) + counts[part][here] @ vectors[here]
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.list_(pa.float64()))], ["lang", "vector"]
    )


def prototypes(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """The prototype of each language in ``docs``: one vector a language reaches the driver.

    Trigrams are counted over all texts; their counts, not the texts, are shuffled,
    summed before and after.
    """
    known = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = known.mapInArrow(_counts_by_language, "lang string, trigram long, n long").groupBy("lang", "trigram").agg(F.sum("n").alias("n"))
    # As many rows as trigrams occur in languages: few tasks bundle them, each to one vector a language.
    bundles = stored(counts.coalesce(BUNDLE_TASKS).mapInArrow(_partial_bundles, "lang string, vector array<double>"), "bundles")
    sums = (
        bundles.select("lang", F.posexplode("vector").alias("at", "x"))
        .groupBy("lang", "at").agg(F.sum("x").alias("x"))
        .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("v"))
    )
    return {r["lang"]: np.array([p["x"] for p in r["v"]]) for r in sums.collect()}


def identified(df: DataFrame, known: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """``df`` with columns ``lang_pred`` and ``score``, in place of any of these names."""
    df = df.drop("lang_pred", "score")
    names = sorted(known)
    matrix = np.array([known[k] / max(np.linalg.norm(known[k]), 1e-300) for k in names], np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, text, 2 << 20):
                vectors = bundled(part.column(text).to_pylist())
                size = np.linalg.norm(vectors, axis=1)
                if names:
                    cosine = vectors @ matrix.T / np.maximum(size, 1e-30)[:, None]
                    best = cosine.argmax(1)
                    score = np.clip(cosine[np.arange(len(best)), best], 0, 1)
                    found = [names[b] if s > 0 else UNKNOWN for b, s in zip(best, size)]
                else:
                    found, score = [UNKNOWN] * len(size), np.zeros(len(size))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.string()), pa.array(np.where(size > 0, score, 0).astype(float))],
                    [*part.schema.names, "lang_pred", "score"],
                )

    kinds = T.StructType([*with_column(df, "lang_pred", T.StringType()).fields, T.StructField("score", T.DoubleType())])
    return df.mapInArrow(run, kinds)


def predictions(docs: DataFrame) -> DataFrame:
    """Language of every document, by prototypes of the documents not held out."""
    from apothecary.llm.toxicity import held_out

    known = prototypes(docs.where(~held_out()))
    return identified(docs.select("doc_id", "text"), known).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")

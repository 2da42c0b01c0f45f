"""Toxicity by a counterfactually regularised classifier.

Labelled texts that mention a group are read twice: as they are, and with each
identity term swapped for another. Training fits the labels and penalises the
squared change of the raw score under the swap, so that naming a group moves a
score little by itself.

The score is the logistic function of a sum of weights, one for each feature that
occurs in the text: its words, and their beginnings of four to six bytes, which
stand for the inflected forms of a stem. Features are hashed to a fixed number of
bins; the bins that tell the classes apart best get a weight.

Null and empty texts have no feature: their score is that of the intercept. With
nothing to learn from, every score is 0. Rows without a label are not learned from;
of several labels for a document the largest counts. A row without doc_id is held out
and scored like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apothecary.llm.bpe import with_column
from apothecary.llm.shared import stored
from apothecary.llm.textvec import Words, byte_sums, mixed, sliced, span_hashes

# Identity terms, by kind. A term is swapped for another of its kind.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "woman", "man", "female", "male", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("gay", "straight", "lesbian", "bisexual", "queer", "heterosexual", "homosexual"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "american"),
    ("old", "young", "elderly", "teenage", "disabled", "blind", "deaf"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus", "buddhisten"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas"),
)

BINS = 1 << 20
PREFIXES = (4, 5, 6)
_BREAKS = np.ones(256, bool)
_BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


@dataclass(frozen=True)
class ToxicitySettings:
    """``sample_rows`` bounds the labelled rows that are learned from."""

    sample_rows: int = 20_000
    features: int = 4096
    least_evidence: float = 15.0
    toxic_weight: float = 0.3
    swap_penalty: float = 1.0
    ridge: float = 2e-4
    rate: float = 0.05
    steps: int = 400


@dataclass(frozen=True)
class ToxicityModel:
    bins: np.ndarray
    weights: np.ndarray
    intercept: float

    def scorer(self):
        """A function of an array of texts: the raw score of each."""
        of_bin = np.zeros(BINS, np.float32)
        of_bin[self.bins] = self.weights
        wanted = of_bin != 0

        def score(texts: pa.Array) -> np.ndarray:
            doc, bins = features(texts, wanted)
            return self.intercept + np.bincount(doc, of_bin[bins], len(texts))

        return score


def features(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and distinct bins of the features of each text."""
    words = Words(texts, lower=True, breaks=_BREAKS)
    of_word = np.repeat(np.arange(len(texts)), words.counts())
    docs, bins, sums = [], [], byte_sums(words.data)
    for size in (0, *PREFIXES):
        end = np.minimum(words.start + size, words.end) if size else words.end
        hashed = span_hashes(sums, words.start, end) + np.uint64(size)
        found = (mixed(hashed) % np.uint64(BINS)).astype(np.int64)
        keep = slice(None) if wanted is None else wanted[found]
        docs.append(of_word[keep])
        bins.append(found[keep])
    both = np.unique(np.concatenate(docs) * BINS + np.concatenate(bins))
    return both // BINS, both % BINS


def identity_bins() -> np.ndarray:
    return np.unique(features(pa.array([t for kind in IDENTITY_TERMS for t in kind]))[1])


def swaps() -> dict[str, str]:
    return {t: kind[(i + 1) % len(kind)] for kind in IDENTITY_TERMS for i, t in enumerate(kind)}


def swapped(text: str, to: dict[str, str]) -> str | None:
    """The text with every identity term swapped; None if it has none."""
    parts, changed = [], False
    word: list[str] = []
    for c in [*text, " "]:
        if c.isalnum():
            word.append(c)
            continue
        own = "".join(word)
        other = to.get(own.lower())
        changed |= other is not None
        parts += [other or own, c]
        word = []
    return "".join(parts)[:-1] if changed else None


def _labelled(docs: DataFrame, labels: DataFrame, settings: ToxicitySettings) -> DataFrame:
    """Labelled texts, of ``sample_rows`` documents at most: those first by a hash."""
    rows = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(settings.sample_rows)
    )
    # At most sample_rows pairs of numbers: the texts stay where they are.
    return docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id").select("text", "toxic")


def held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    to = swaps()
    probe = {t.encode() for t in to}
    for batch in batches:
        for part in sliced(batch, "text"):
            texts = part.column("text").fill_null("")
            doc, bins = features(texts)
            own = np.split(bins, np.searchsorted(doc, np.arange(1, len(texts))))
            other: list = [None] * len(texts)
            for i, text in enumerate(texts.to_pylist()):
                low = text.lower()
                if any(t.decode() in low for t in probe) and (changed := swapped(text, to)) is not None:
                    other[i] = features(pa.array([changed]))[1]
            yield pa.RecordBatch.from_arrays(
                [part.column("toxic").cast(pa.int32()), pa.array(own, pa.list_(pa.int32())), pa.array(other, pa.list_(pa.int32()))],
                ["toxic", "bins", "swapped"],
            )


def fit(docs: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings()) -> ToxicityModel:
    """A model of ``labels.toxic`` (0 or 1) over the texts of ``docs``."""
    rows = _labelled(docs, labels, settings).mapInArrow(_training_rows, "toxic int, bins array<int>, swapped array<int>")
    rows = stored(rows, "toxicity-sample")
    count = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("p")).first()
    n, p = count["n"], count["p"]
    if n == 0:
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0, np.float32), -np.inf)
    bins = (
        rows.select("toxic", F.explode("bins").alias("bin"))
        .groupBy("bin")
        .agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg"))
        .withColumn("evidence", _evidence(p, n))
        .where(F.col("evidence") >= settings.least_evidence)
        .orderBy(F.desc("evidence"), "bin")
        .limit(settings.features)
        .select("bin")
    )
    chosen = np.unique(np.concatenate([np.array([r["bin"] for r in bins.collect()], np.int64), identity_bins()]))
    listed = F.array(*[F.lit(int(b)) for b in chosen])
    small = rows.select("toxic", F.array_intersect("bins", listed).alias("bins"), F.array_intersect("swapped", listed).alias("swapped"))
    # Bounded: sample_rows rows of the chosen bins.
    return _fitted(small.collect(), chosen, settings)


def _evidence(p: int, n: int) -> F.Column:
    """Likelihood ratio statistic of a bin's presence against the label."""

    def term(seen: F.Column, expected: F.Column) -> F.Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    pos, neg = F.col("pos"), F.col("neg")
    have = pos + neg
    return 2 * (
        term(pos, have * p / n) + term(neg, have * (n - p) / n)
        + term(p - pos, (n - have) * p / n) + term(n - p - neg, (n - have) * (n - p) / n)
    )


def _sparse(lists: list[list[int]], chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    flat = np.fromiter((b for x in lists for b in x), np.int64, len(row))
    return row, np.searchsorted(chosen, flat)


def _fitted(rows: list, chosen: np.ndarray, settings: ToxicitySettings) -> ToxicityModel:
    """Adam on the logistic loss, the ridge and the swap penalty."""
    y = np.array([r["toxic"] for r in rows], float)
    n, m = len(y), len(chosen)
    row, col = _sparse([r["bins"] or [] for r in rows], chosen)
    pairs = [r for r in rows if r["swapped"] is not None]
    own = _sparse([r["bins"] or [] for r in pairs], chosen)
    other = _sparse([r["swapped"] or [] for r in pairs], chosen)
    weight = np.where(y > 0, settings.toxic_weight / max(y.sum(), 1), (1 - settings.toxic_weight) / max(n - y.sum(), 1))
    # The last parameter is the intercept.
    w = np.zeros(m + 1)
    w[m] = np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    mean, spread = np.zeros(m + 1), np.zeros(m + 1)
    for step in range(1, settings.steps + 1):
        score = w[m] + np.bincount(row, w[col], n)
        miss = weight * (1 / (1 + np.exp(-np.clip(score, -50, 50))) - y)
        slope = np.append(np.bincount(col, miss[row], m) + settings.ridge * w[:m], miss.sum())
        if pairs:
            change = np.bincount(own[0], w[own[1]], len(pairs)) - np.bincount(other[0], w[other[1]], len(pairs))
            change *= 2 * settings.swap_penalty / len(pairs)
            slope[:m] += np.bincount(own[1], change[own[0]], m) - np.bincount(other[1], change[other[0]], m)
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.999 * spread + 0.001 * slope**2
        rate = settings.rate * (1 - (step - 1) / settings.steps)
        w -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
    return ToxicityModel(chosen, w[:m].astype(np.float32), float(w[m]))


def scored(df: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score") -> DataFrame:
    """``df`` with a score of each text, from 0 to 1, in a column ``score``, in place of one of that name."""
    df = df.drop(score)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = model.scorer()
        for batch in batches:
            for part in sliced(batch, text):
                with np.errstate(over="ignore"):
                    found = 1 / (1 + np.exp(-raw(part.column(text))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.float64())], [*part.schema.names, score])

    return df.mapInArrow(run, with_column(df, score, T.DoubleType()))


def predictions(docs: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings()) -> DataFrame:
    """Score and class of every document, by a model of the documents not held out."""
    model = fit(docs, labels, settings)
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )

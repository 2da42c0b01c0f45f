"""Fingerprints, languages and toxicity scores against plain Python over whole tables."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from test_llm_operators import LABELS, docs_of, labelled

from apothecary.llm import bottom_k, hypervectors, textvec, toxicity

FOLDER = "/root/testdata/sf0.001"
WHOLE = (1 << 64) - 1


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


# -- fingerprints ---------------------------------------------------------


def spread(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & WHOLE
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & WHOLE
    return x ^ (x >> 31)


def byte_hash(span, known={}):
    """Hash of some bytes, one by one; only the random value of each byte is the library's."""
    if span not in known:
        total = sum(int(textvec._BYTE_VALUE[0][b]) * pow(textvec._BASES[0], i, 1 << 64) for i, b in enumerate(span))
        known[span] = spread((total + len(span)) & WHOLE)
    return known[span]


def plain_sketch(text):
    shingles, data = set(), text.encode()
    at = 0
    for c in text:
        if at == 0 or at + 12 <= len(data):
            shingles.add(data[at:at + 12])
        at += len(c.encode())
    return sorted({byte_hash(s) >> 16 for s in shingles})[:128]


def plain_likeness(a, b):
    union = sorted({*a, *b})[:128]
    return sum(h in a and h in b for h in union) / len(union) if union else 1.0


def plain_packed(sketch):
    return base64.b64encode(b"".join(h.to_bytes(6, "big") for h in sketch)).decode()


def compared(rows):
    """What the operator returns for (doc_id, text) of distinct ids."""
    ring = sorted(((i, t or "") for i, t in rows), reverse=True)
    out = {}
    for (i, text), (_, following) in zip(ring, ring[1:] + ring[:1]):
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        own, new, other = plain_sketch(text), plain_sketch(changed), plain_sketch(following)
        out[i] = (
            len(text), hashlib.sha256(changed.encode()).hexdigest(), plain_packed(own), plain_packed(new),
            plain_likeness(own, new), plain_likeness(own, other),
        )
    return out


def test_fingerprints_by_plain_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = docs_of(spark, [None, "", "é" * 7, "日本語" * 9, "twelve bytes", "short", "ab" * 4000, "a b " * 300], extra=True)
    for table in (docs, odd):
        want = compared([(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()])
        columns = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
        assert {r["doc_id"]: tuple(r[c] for c in columns) for r in bottom_k.comparisons(table).collect()} == want


# -- languages ------------------------------------------------------------


def plain_trigrams(text):
    letters = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ") if text else ""
    line = re.sub(" +", " ", letters)
    return Counter(line[i:i + 3] for i in range(len(line) - 2))


def plain_vector(counts, known={}):
    total = np.zeros(hypervectors.DIMENSIONS)
    for gram, n in counts.items():
        if gram not in known:
            a, b, c = (hypervectors.letter_vector(ord(x)).astype(float) for x in gram)
            known[gram] = np.roll(a, 2) * np.roll(b, 1) * c
        total += n * known[gram]
    return total


def test_languages_by_plain_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.select("doc_id", "text", "lang").collect()]
    sums = {}
    for i, text, lang in rows:
        if not held_out(i) and text is not None and lang is not None:
            sums.setdefault(lang, Counter()).update(plain_trigrams(text))
    profiles = {lang: plain_vector(c) for lang, c in sums.items()}
    found = {r["doc_id"]: r for r in hypervectors.predictions(docs).collect()}
    assert len(found) == len(rows)
    for i, text, _ in rows:
        own = plain_vector(plain_trigrams(text))
        size = np.linalg.norm(own)
        cosines = {k: own @ p / (size * np.linalg.norm(p)) for k, p in profiles.items()} if size else {}
        best = max(cosines.values(), default=0.0)
        assert found[i]["held_out"] == held_out(i)
        assert abs(found[i]["score"] - min(max(best, 0.0), 1.0)) < 1e-4
        # Cosines that differ by rounding only are a tie.
        assert found[i]["lang_pred"] in ({k for k, c in cosines.items() if best - c < 1e-5} or {"und"})


# -- toxicity -------------------------------------------------------------


def plain_features(text):
    """Bins of words and their beginnings; of the few hundred features here some share a bin."""
    words = re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return {spread((byte_hash(w[:size] if size else w) + size) & WHOLE) % toxicity.BINS for w in words for size in (0, 4, 5, 6)}


def evidence(pos, neg, p, n):
    def term(seen, expected):
        return seen * math.log(seen / expected) if seen else 0.0

    have, q = pos + neg, n - p
    return 2 * (
        term(pos, have * p / n) + term(neg, have * q / n) + term(p - pos, (n - have) * p / n) + term(q - neg, (n - have) * q / n)
    )


def table_of(sets, names):
    out = np.zeros((len(sets), len(names)))
    for row, features in zip(out, sets):
        row[[names[f] for f in features if f in names]] = 1
    return out


def plain_scores(texts, labels, settings):
    """Score of each text by a model of the labelled ones that are not held out."""
    known = [(texts[i], y) for i, y in labels.items() if not held_out(i)]
    y = np.array([label for _, label in known], float)
    own = [plain_features(t) for t, _ in known]
    n, p = len(y), int(y.sum())
    pos, neg = Counter(), Counter()
    for features, label in zip(own, y):
        (pos if label else neg).update(features)
    telling = {f for f in {*pos, *neg} if evidence(pos[f], neg[f], p, n) >= settings.least_evidence}
    terms = {f for kind in toxicity.IDENTITY_TERMS for t in kind for f in plain_features(t)}
    names = {f: i for i, f in enumerate(sorted(telling | terms))}
    to = {t: kind[(i + 1) % len(kind)] for kind in toxicity.IDENTITY_TERMS for i, t in enumerate(kind)}
    other = [" ".join(to.get(w, w) for w in t.split(" ")) for t, _ in known]
    x = table_of(own, names)
    pairs = np.array([t != o for (t, _), o in zip(known, other)])
    change = (x - table_of([plain_features(t) for t in other], names))[pairs]

    share = np.where(y > 0, settings.toxic_weight / p, (1 - settings.toxic_weight) / (n - p))
    w = np.append(np.zeros(len(names)), math.log((p + 0.5) / (n - p + 0.5)))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, settings.steps + 1):
        miss = share * (1 / (1 + np.exp(-(x @ w[:-1] + w[-1]))) - y)
        slope = np.append(x.T @ miss + settings.ridge * w[:-1], miss.sum())
        slope[:-1] += 2 * settings.swap_penalty * change.T @ (change @ w[:-1]) / len(change)
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        rate = settings.rate * (1 - (step - 1) / settings.steps)
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return {i: 1 / (1 + math.exp(-(table_of([plain_features(t)], names)[0] @ w[:-1] + w[-1]))) for i, t in texts.items()}


def test_toxicity_scores_by_plain_python(spark):
    docs, labels, truth = labelled(spark, random.Random(8))
    labels = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = plain_scores(texts, truth, toxicity.ToxicitySettings())
    for r in toxicity.predictions(docs, labels).collect():
        assert abs(r["score"] - want[r["doc_id"]]) < 1e-3
        assert r["predicted"] == int(want[r["doc_id"]] >= 0.5)


def test_rows_without_an_id_are_held_out_and_scored(spark):
    docs, labels, _ = labelled(spark, random.Random(9), 100)
    more = docs.unionByName(docs_of(spark, ["w1 w2", None], [None, None]))
    rows = toxicity.predictions(more, labels.unionByName(spark.createDataFrame([(None, 1, 1)], LABELS))).where("doc_id IS NULL").collect()
    assert len(rows) == 2 and all(r["held_out"] and 0 <= r["score"] <= 1 for r in rows)

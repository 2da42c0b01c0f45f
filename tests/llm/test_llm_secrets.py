"""Secret scan against plain Python."""

import hashlib
import random
import re

import pytest
from comparing import database, difference

from apothecary.llm import secrets
from apothecary.llm.queries import ORACLES, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
KINDS = list(secrets.PATTERNS)
# Written apart from the module, with a flag for case.
BASE = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def base_spans(text):
    found = [("assign", m) for m in BASE["assign"].finditer(text) if len(m[2]) >= 6]
    found += [("access", m) for m in BASE["access"].finditer(text) if len(m[0]) >= 20]
    found += [("hex", m) for m in BASE["hex"].finditer(text) if len(m[0]) >= 24]
    return [(m.start(), KINDS.index(k), m.end()) for k, m in found]


def linked_spans(text, reach):
    strong = base_spans(text)
    weak = []
    for n, kind in enumerate(KINDS[3:], 3):
        for m in re.finditer(secrets.PATTERNS[kind], text):
            mixed = re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])
            if (kind != "opaque" or mixed) and not any(a < m.end() and b > m.start() for a, _, b in strong):
                weak.append((m.start(), n, m.end()))
    out = []
    for start, kind, end in weak:
        near = {KINDS[k] for a, k, b in strong + weak if a < end + reach and b > start - reach}
        identified, secret = near & {"access", "identity"}, near & {"assign", "hex", "opaque"}
        if {"identity": secret, "opaque": identified, "endpoint": identified and secret}[KINDS[kind]]:
            out.append((start, kind, end))
    return out


def expected(text, reach=200):
    text = text or ""
    base = sorted(base_spans(text))
    lines = [[f"{KINDS[k]}:{a}:{b}" for a, k, b in spans] for spans in (base, sorted(base + linked_spans(text, reach)))]
    counts = [sum(k == n for _, k, _ in base) for n in range(3)]
    return (*counts, hashlib.sha256(",".join(lines[0]).encode()).hexdigest(), ",".join(lines[1]))


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in zip(ids, texts)], DOCS)


def got(df):
    return sorted([(r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"], r["spans"]) for r in df.collect()], key=repr)


def check(spark, texts):
    wanted = sorted([(i, *expected(t)) for i, t in enumerate(texts)], key=repr)
    assert got(secrets.digest(frame(spark, texts))) == wanted


KEY, HEX, OPAQUE = "AKIA" + "Q7" * 8, "0a1b2c3d4e5f" * 2, "zX9/" * 10


def test_patterns_at_their_limits(spark):
    check(spark, [
        None, "", " ", "token=abcde", "token=abcdef", 'ToKeN" \x20: \'ab.c=_-', "API_KEY=123456 apikey:1234567", "password: token: abcdefgh",
        "AKIA" + "A" * 15, "AKIA" + "A" * 16, "akia" + "A" * 20, "xAKIAAKIA" + "B" * 20, HEX, HEX[:-1], "é日" + HEX + "\U0001f600 secret=" + HEX,
        "toKen=abcdefg paſſword=abcdefg", "token = \nabcdefgh", "tokentoken=abcdefg", "password=secret=abcdef",
    ])


def test_weak_parts_need_their_counterparts(spark):
    far = " x" * 400
    check(spark, [
        "user=bob", f"user=bob {HEX}", f"user=bob {far} {HEX}", f"{KEY} {OPAQUE}", OPAQUE, f"{OPAQUE} https://a.example/b", f"{KEY} {HEX} https://a.example/b",
        f"{KEY} {far} {HEX} https://a.example/b", f"a.b@c.example {OPAQUE}", f"login: 'eve' {OPAQUE} jdbc:pg://h/db", f"client_id={KEY} {OPAQUE}",
        f"{'-' * 40} user=bob", f"{HEX} user=bob" + " " * 199 + OPAQUE, "https://user:pw@host/ token=abcdefg x@y.z",
    ])
    assert secrets.digest(frame(spark, [f"user=bob {HEX}"])).first()["spans"] == f"identity:0:8,hex:9:{9 + len(HEX)}"


def test_random_texts(spark):
    rng = random.Random(5)
    bits = [KEY, HEX, OPAQUE, "user=bob", "x@y.example", "password: hunter22", "token='a", "https://h.example/p?q=1", "redis://h", "é" * 30, "word " * 20, "\n\n", "abcdef0123" * 60]
    check(spark, ["".join(rng.choice(bits) + rng.choice(["", " ", "\n", " " * 150]) for _ in range(rng.randrange(1, 40))) for _ in range(60)])


def test_the_scope_is_a_parameter(spark):
    text = f"user=bob {'.' * 50} {HEX}"
    narrow = secrets.digest(frame(spark, [text]), secrets.SecretSettings(reach=40)).first()["spans"]
    assert "identity" not in narrow and "identity" in secrets.digest(frame(spark, [text])).first()["spans"]


def test_odd_tables(spark):
    text = f"user=bob {HEX} {KEY}"
    docs = frame(spark, [text, text, text, None], [1, 1, None, None])
    for name in ("row", "kind", "start", "end", "cell", "found", "matches", "spans"):
        docs = docs.withColumn(name, docs["doc_id"])
    rows = got(secrets.digest(docs))
    assert rows == sorted([(i, *expected(t)) for i, t in zip([1, 1, None, None], [text, text, text, None])], key=repr)
    empty = secrets.digest(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]


@pytest.mark.parametrize("size", [40_000])
def test_very_long_texts(spark, size):
    texts = ["a" * size, "0" * size, "password " + " " * size, f"user={'b' * size} {HEX} {'Z9' * size}", f"{HEX} x@y.z " * (size // 100)]
    wanted = [(i, *expected(t)) for i, t in enumerate(texts[:4])]
    found = got(secrets.digest(frame(spark, texts)))
    assert found[:4] == wanted
    assert found[4][5].count("identity") == size // 100


def test_query_by_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert got(QUERIES["op12_secrets"](spark, folder)) == sorted([(i, *expected(t)) for i, t in texts.items()], key=repr)
    assert difference(QUERIES["op12_secrets"](spark, folder), database(folder), ORACLES["op12_secrets"]) is None


def test_no_python_on_the_main_path(spark):
    plan = secrets.digest(frame(spark, [KEY]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

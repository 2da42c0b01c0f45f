"""The operators on small hand-made tables: nulls, empty and long texts, ties, empty tables, other columns."""

import base64
import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from apothecary.llm import (
    bottom_k, bpe, chosen_path, components, html_text, hypervectors, mixing, nn_descent, order, range_coder, repeats, shared, textvec,
    token_files, toxicity, word_table,
)

RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
ODD = [None, "", " ", "\n\t ", "a", "a a", "é", "A b C d E f", "x " * 3000, "one two  three\tfour\nfive", "日本語 テキスト"]


def docs_of(spark, texts, ids=None, extra=False):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", f"s{(i or 0) % 3}" if i != 1 else None, len(t or "")) for i, t in zip(ids, texts)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for name in ("row", "ids", "score", "size", "kept", "key", "tokens", "at", "query", "part"):
            df = df.withColumn(name, F.lit("other"))
    return df


def prose(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


# -- words and hashes -----------------------------------------------------


def test_words_are_those_of_the_rule():
    words = textvec.Words(pa.array(ODD), lower=True)
    for i, text in enumerate(ODD):
        spans = zip(words.start[words.bounds[i]:words.bounds[i + 1]], words.end[words.bounds[i]:words.bounds[i + 1]])
        assert [bytes(words.data[a:b]).decode() for a, b in spans] == WORD.findall((text or "").lower())


def test_equal_runs_of_words_have_equal_hashes():
    hashes, doc, _ = textvec.Words(pa.array(["a b c d", "x b c d", "a  b\tc", "a b"])).runs(3, short=True)
    of = [list(hashes[doc == i]) for i in range(4)]
    assert of[0][1] == of[1][1] and of[0][0] == of[2][0]
    assert len({*hashes}) == 4 and len(of[3]) == 1


# -- 1 toxicity -------------------------------------------------------------


def labelled(spark, rng, n=600):
    bad = ("idiot", "scum", "moron")
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        words = prose(rng, 30).split()
        if i % 3 == 0:
            words[3] = rng.choice(("women", "men", "muslims", "christians"))
        if toxic:
            words[rng.randrange(4, 30)] = rng.choice(bad)
        rows.append((i, " ".join(words), int(toxic)))
    docs = docs_of(spark, [t for _, t, _ in rows])
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(5, 1, None), (None, 1, 1)], LABELS)
    return docs, labels, {i: y for i, _, y in rows}


def test_toxicity_holds_on_documents_held_out(spark):
    docs, labels, truth = labelled(spark, random.Random(1))
    rows = toxicity.predictions(docs, labels).collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1
    out = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in out) >= 0.97 * len(out)


def test_naming_a_group_moves_a_score_little(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 2
        # One group is named mostly in toxic texts, the insult is what makes them so.
        group = "women" if toxic and i % 10 else "men"
        rows.append(f"{prose(rng, 10)} {group} {'idiot' if toxic else 'people'}")
        labels.append((i, 1, toxic))
    docs, labels = docs_of(spark, rows), spark.createDataFrame(labels, LABELS)
    gap = []
    for penalty in (0.0, 3.0):
        raw = toxicity.fit(docs, labels, toxicity.ToxicitySettings(swap_penalty=penalty)).scorer()
        a, b = raw(pa.array(["about women here", "about men here"]))
        gap.append(abs(a - b))
    assert gap[1] < 0.3 * gap[0]


def test_toxicity_without_labels_and_on_odd_texts(spark):
    none = toxicity.predictions(docs_of(spark, ODD), spark.createDataFrame([], LABELS)).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.0, 0)}
    docs, labels, _ = labelled(spark, random.Random(3), 100)
    assert toxicity.predictions(docs_of(spark, [], []), labels).count() == 0
    odd = docs_of(spark, ODD, [None, *range(1, len(ODD))], extra=True)
    assert toxicity.scored(odd, toxicity.fit(docs, labels)).select("doc_id", "row", "score").count() == len(ODD)


def test_identity_terms_are_swapped_whole():
    to = toxicity.swaps()
    assert toxicity.swapped("Women, and womenfolk", to) == "men, and womenfolk"
    assert toxicity.swapped("nothing here", to) is None


# -- 2 near copies ----------------------------------------------------------


def near_truth(texts, k, percent):
    sets = {}
    for i, t in texts.items():
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    part = {i: i for i in texts}
    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = part[a], part[b]
                part = {i: min(x, y) if p in (x, y) else p for i, p in part.items()}
    return {i: (len(sets[i]), part[i]) for i in texts}


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates_are_those_of_brute_force(spark):
    rng = random.Random(4)
    texts = list(ODD)
    for _ in range(6):
        base = prose(rng, 120, 5000)
        texts += [base, base.upper(), *(edited(rng, base, e) for e in (1, 2, 3, 4, 6, 9))]
    hub = prose(rng, 90, 5000)
    texts += [edited(rng, hub, 3) for _ in range(90)] + [hub] * 3
    rng.shuffle(texts)
    settings = chosen_path.NearSettings(leaf=8, block=16)
    got = {r["doc_id"]: r for r in chosen_path.near_duplicates(docs_of(spark, texts, extra=True), settings).collect()}
    for i, (n, part) in near_truth(dict(enumerate(texts)), 3, 85).items():
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, part, part == i)


def test_near_duplicates_of_odd_tables(spark):
    assert chosen_path.near_duplicates(docs_of(spark, [], [])).count() == 0
    rows = chosen_path.near_duplicates(docs_of(spark, ["a b c d", "a b c d", "a b c d"], [7, 7, None])).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in rows if r["doc_id"]) == [(7, 7, True)] * 2
    assert [(r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None] == [(None, True)]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5)]
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 3 mixing ---------------------------------------------------------------


def test_mixing_meets_targets(spark):
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(1, 60)) for _ in range(900)] + ODD
    docs = docs_of(spark, texts, extra=True)
    rows = mixing.mixed_sources(docs).collect()
    assert len(rows) == len(texts)
    sizes = {i: len(WORD.findall(t or "")) for i, t in enumerate(texts)}
    total = sum(sizes.values())
    by_source = {}
    for r in rows:
        assert r["size"] == sizes[r["doc_id"]] and r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
        by_source.setdefault(r["source"], []).append(r)
    names = sorted(s for s in by_source if s is not None) + [None]
    words = {s: sum(r["size"] for r in by_source[s]) for s in names}
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    capped = set()
    while True:
        level = (total - sum(3 * words[s] for s in capped)) / sum(weights[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and level * weights[s] > 3 * words[s]}
        if not over:
            break
        capped |= over
    for s in names:
        target = 3 * words[s] if s in capped else level * weights[s]
        assert all(abs(r["target"] - target) < 1e-6 * max(1, target) and r["source_size"] == words[s] for r in by_source[s])
        assert abs(sum(r["taken"] for r in by_source[s]) - target) <= max(1.5, 0.01 * target)
    again = mixing.mixed_sources(docs).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in rows)


def test_mixing_of_odd_tables(spark):
    assert mixing.mixed_sources(docs_of(spark, [], [])).count() == 0
    rows = mixing.mixed_sources(docs_of(spark, [None, "", " "])).collect()
    assert {(r["size"], r["target"], r["taken"]) for r in rows} == {(0, 0.0, 0)}
    same = docs_of(spark, ["a b"] * 6, [4] * 6)
    assert sorted(r["taken"] for r in mixing.mixed_sources(same).collect()) == [2] * 6


def plainly_wanted(sizes, target):
    """Copies wanted of each size, by halving the interval of the level."""
    weight = [2 ** (mixing.LENGTH_POWER * (n.bit_length() - 1)) for n in sizes]
    low, high = 0.0, 1e9
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(3, level * w) * n for w, n in zip(weight, sizes)) < target else (low, level)
    return [min(3, high * w) for w in weight]


@pytest.mark.parametrize("share", [0.3, 1.7])
def test_copies_follow_inclusion_odds_that_differ(spark, share):
    # Sources alike but for doc_id are as many draws of one sample.
    sizes, sources = [3, 5, 9, 17, 40] * 60, 60
    target = share * sum(sizes)
    rows = [(s * 1000 + i, f"s{s}", n, sum(sizes), target) for s in range(sources) for i, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long, source_size long, target double")
    out = mixing.sampled(docs).collect()
    mean, total = {}, {}
    for r in out:
        mean[r["size"]] = mean.get(r["size"], 0) + r["copies"] / (60 * sources)
        total[r["source"]] = total.get(r["source"], 0) + r["copies"] * r["size"]
    wanted = dict(zip(sizes, plainly_wanted(sizes, target)))
    assert len({round(w, 3) for w in wanted.values() if w < 3}) == 5
    for size, w in wanted.items():
        assert abs(mean[size] - w) < 0.04
        assert {r["copies"] for r in out if r["size"] == size} <= {int(w + 1e-9), int(w + 1e-9) + 1}
    assert all(abs(t - target) <= 0.01 * target for t in total.values())


def test_inclusion_odds_by_brute_force(spark):
    docs = spark.createDataFrame([("a", 1, 6.0), ("a", 5, 6.0), (None, 4, 12.0), (None, 0, 12.0), ("b", 7, 0.0)], "source string, size long, target double")
    got = {(r["source"], r["class"]): r["wanted"] for r in mixing.wanted_copies(docs).collect()}
    short, long = plainly_wanted([1, 5], 6)
    assert abs(got["a", 0] - short) < 1e-6 and abs(got["a", 2] - long) < 1e-6
    assert got[None, 2] == 3 and got["b", 2] == 0 and len(got) == 4


def test_running_sum_in_global_order(spark):
    df = spark.createDataFrame([(i % 3 or None, i, i * i) for i in range(200)], "g int, i long, v long")
    got = {r["i"]: r["s"] for r in order.running_sum(df, [F.col("i")], "v", "s", ["g"]).collect()}
    for i in range(200):
        assert got[i] == sum(j * j for j in range(i) if j % 3 == i % 3)


# -- 4 fingerprints ---------------------------------------------------------


def shingle_set(text):
    data = (text or "").encode()
    starts = [i for i in range(len(data)) if data[i] & 0xC0 != 0x80]
    k = bottom_k.SHINGLE
    return {data[i:i + k] for i in starts if i + k <= len(data)} or ({data} if data else set())


def test_sketches_estimate_resemblance_containment_and_count():
    rng = random.Random(6)
    a = prose(rng, 800)
    b = a[: len(a) // 2] + prose(rng, 400)
    x, y = bottom_k.sketches(pa.array([a, b]))
    s, t = shingle_set(a), shingle_set(b)
    assert abs(bottom_k.resemblance(x, y) - len(s & t) / len(s | t)) < 0.15
    assert abs(bottom_k.containment(x, y) - len(s & t) / len(s)) < 0.2
    assert abs(bottom_k.distinct_shingles(x) / len(s) - 1) < 0.3
    small = bottom_k.sketches(pa.array(["The quick brown fox", "The quick brown cat"]))
    s, t = shingle_set("The quick brown fox"), shingle_set("The quick brown cat")
    assert bottom_k.resemblance(*small) == len(s & t) / len(s | t)


def test_sketches_merge(spark):
    rng = random.Random(7)
    a, b = prose(rng, 300), prose(rng, 300)
    one, two = bottom_k.sketches(pa.array([a, b]))
    df = spark.createDataFrame([(1, a), (1, b), (1, a), (2, None), (None, b)], "k int, text string")
    got = {r["k"]: r["fingerprint"] for r in bottom_k.merged_by(bottom_k.fingerprinted(df), "k").collect()}
    assert got[1] == bottom_k.packed(bottom_k.merged(one, two)) and got[2] == ""
    assert np.array_equal(bottom_k.unpacked(got[1]), bottom_k.merged(one, two))


def test_fingerprints_of_edited_texts(spark):
    rng = random.Random(8)
    texts = [*ODD, *(prose(rng, rng.randrange(1, 200)) for _ in range(60))]
    rows = {r["doc_id"]: r for r in bottom_k.comparisons(docs_of(spark, texts, extra=True)).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        a, b = text or "", texts[i - 1] or ""
        half = len(a) // 2
        changed = a[: len(a) - half] + b[:half]
        own, new, other = bottom_k.sketches(pa.array([a, changed, b]))
        r = rows[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(a), hashlib.sha256(changed.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (bottom_k.packed(own), bottom_k.packed(new))
        assert (r["near_edited"], r["near_next"]) == (bottom_k.resemblance(own, new), bottom_k.resemblance(own, other))


def test_fingerprints_of_odd_tables(spark):
    assert bottom_k.comparisons(docs_of(spark, [], [])).count() == 0
    alone = bottom_k.comparisons(docs_of(spark, ["abcd"])).first()
    assert alone["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    assert bottom_k.comparisons(docs_of(spark, ["a", "b", "b"], [None, None, None])).count() == 3
    assert bottom_k.comparisons(docs_of(spark, ["a", "b", "b"], [3, 3, None])).count() == 3


# -- 5 language -------------------------------------------------------------


def test_language_of_documents_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = hypervectors.predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def test_language_of_odd_texts(spark):
    known = docs_of(spark, ["the cat and the dog"] * 20)
    odd = docs_of(spark, [None, "", "123 !?", "the cat", "Ünïcode"], extra=True)
    rows = {r["doc_id"]: r for r in hypervectors.identified(odd, hypervectors.prototypes(known)).collect()}
    assert [rows[i]["lang_pred"] for i in range(5)] == ["und", "und", "und", "en", "en"]
    assert rows[3]["score"] > 0.5 and rows[0]["score"] == 0
    assert {r["lang_pred"] for r in hypervectors.identified(odd, {}).collect()} == {"und"}
    assert hypervectors.predictions(docs_of(spark, [], [])).count() == 0


def test_letters_are_bound_and_bundled():
    one = hypervectors.bundled(["abc"])[0]
    vector = hypervectors.letter_vector
    grams = [" ab", "abc", "bc "]
    assert np.array_equal(one, sum(np.roll(vector(ord(a)), 2) * np.roll(vector(ord(b)), 1) * vector(ord(c)) for a, b, c in grams))
    assert np.array_equal(hypervectors.bundled(["x", "abc!!", None])[1], one)


# -- 6 byte-level BPE -------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(9)
    letters = "ab é\n\t '1.,!s\xa0\x85　\x1cd"
    return [t or "" for t in ODD] + [
        "it's 's'll", "<|endoftext|> x", "a" * 700, "é" * 200, " " * 90 + "a", "ab" * 300,
        *("".join(rng.choice(letters) for _ in range(rng.randint(1, 50))) for _ in range(1500)),
    ]


def test_ids_are_those_of_the_library_and_decode(reference):
    texts, ranks = odd_texts(), bpe.Ranks(RANKS)
    for text, packed in zip(texts, bpe.rank_encoder(RANKS, public_tokenizers.PATTERN).encode(texts)):
        ids = np.frombuffer(packed, "<u4")
        assert ids.tolist() == reference.encode_ordinary(text)
        assert ranks.decode(ids).tobytes().decode() == text


def test_rows_and_single_trees_merge_alike():
    rng, ranks = random.Random(10), bpe.Ranks(RANKS)
    pieces = [bytes(rng.choice(b"theinrg ") for _ in range(rng.randint(2, 60))) for _ in range(300)]
    assert ranks.encode_rows(pieces, 64) == [ranks.encode_long(p) for p in pieces]


def test_digests_of_ids(spark, reference):
    rows = {r["doc_id"]: r for r in bpe.digest(docs_of(spark, ODD, extra=True), RANKS, public_tokenizers.PATTERN).collect()}
    for i, text in enumerate(ODD):
        ids = np.array(reference.encode_ordinary(text or ""), "<u4").tobytes()
        want = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        assert (rows[i]["n_tokens"], rows[i]["ids_sha256"], rows[i]["decoded_sha256"]) == want
    assert bpe.digest(docs_of(spark, [], []), RANKS, public_tokenizers.PATTERN).count() == 0


# -- 7 pages ----------------------------------------------------------------

PAGES = [
    ("<html><body><nav><a>m</a></nav><article><h1>T &amp; t</h1><p>Short.<p>A  longer\n paragraph&nbsp;here.</article><footer>f</footer>",
     "T & t\nShort.\nA longer paragraph here."),
    ("<div class='menu'>a b c</div><div id=main><h1>T</h1><p>Hello world, a text that goes on.</p><form>f</form></div>"
     "<div class='comments'><p>nope, a long comment by a reader</p></div>", "T\nHello world, a text that goes on."),
    ("<article><p>x<script>var a='</p>'</script><style>p{}</style> y</p><aside>no</aside><ul><li>one<li>two</ul></article>", "x y\none\ntwo"),
    ("", ""), (None, ""), ("<p>", ""), ("plain words", "plain words"), ("<div hidden>no</div><p>yes", "yes"),
    ("<header>site</header><article><header><h1>Title</h1></header><p>Body of it.</p></article><div class=cookie>c</div>", "Title\nBody of it."),
]


def test_main_text_of_pages(spark):
    df = spark.createDataFrame([(i, "u", h, "old") for i, (h, _) in enumerate(PAGES)], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in html_text.extracted(df).collect()}
    assert got == {i: t for i, (_, t) in enumerate(PAGES)}
    assert html_text.extracted(df.limit(0)).count() == 0


def test_long_pages():
    text = html_text.main_text("<nav>x</nav><main>" + "<p>words of a page</p>" * 5000 + "</main>")
    assert text.count("\n") == 4999


BODY = "<h2 id='social-impact'>Impact</h2><section id='related-work'><p>Work of others, told here.</p></section><p id='notice-1'>A line of the text.</p>"
KEPT = "Impact\nWork of others, told here.\nA line of the text."


@pytest.mark.parametrize("page", [
    f"<div class='site no-sidebar'>{BODY}</div>", f"<main class='content has-sidebar'>{BODY}</main>", f"<article class='post comments-open'>{BODY}</article>",
    f"<main class='sidebar'>{BODY}</main>", f"<div class='widget'>{BODY}<div class='ad'>buy</div></div>", f"<article>{BODY}<div class='share-buttons'>send</div></article>",
    f"<div class='layout left-sidebar'><div class='comments'>first!</div>{BODY}</div>", f"<div>{BODY}</div><div class='comment-list'><p>{'long talk ' * 50}</p></div>",
    f"<div class='ad-2'>buy</div><div>{BODY}<span class='share'>send</span></div>",
])
def test_names_of_boilerplate_take_no_text_with_them(page):
    assert html_text.main_text(page) == KEPT


@pytest.mark.parametrize("page", [
    f"<html><body><form action='x'><input name='s'>{BODY}<button>Go</button></form></body></html>",
    f"<body><form><div class='menu'>a b</div><div>{BODY}</div><aside>c</aside></form>",
    f"<html><head><title>t</title><body>{BODY}</body></html>", f"<html><head><title>t</title><script>s</script>{BODY}</html>",
    f"<head><meta charset='x'><title>t<body>{BODY}", f"<form><p>Search here</p></form><div>{BODY}</div>",
])
def test_pages_in_a_form_or_without_an_end_of_the_head(page):
    assert html_text.main_text(page) == KEPT


@pytest.mark.parametrize("bit", ["<b><div>word word</div>", "<div class=ad><i>word word</div>", "<p><b>word word<p>", "<li><b>word word", "</i><b><table><tr><td>word word"])
def test_tags_that_nothing_closes(bit):
    """Time grows with the page: 2 MB within seconds."""
    took = []
    for n in (100_000, 2_000_000):
        began = time.process_time()
        html_text.main_text("<body><main>" + bit * (n // len(bit)))
        took.append(time.process_time() - began)
    assert took[1] < 60 * max(took[0], 0.05)


def test_election_by_plain_sums():
    """Ratios, smoothing, threshold and votes once more, with whole paths and no shared code."""
    rng = random.Random(7)
    for _ in range(200):
        parents, texts, tags, inner = [-1], [], [], []
        for _ in range(rng.randrange(1, 12)):
            parents.append(rng.randrange(len(parents)))
        for _ in range(rng.randrange(1, 15)):
            texts.append("x" * rng.choice([3, 20, 200]))
            tags.append(rng.randrange(0, 6))
            inner.append(rng.randrange(len(parents)))
        names = [rng.choice(["div", "main", "article", "b", "section"]) for _ in parents]

        def path(e):
            return [] if e < 0 else [*path(parents[e]), e]

        ratios = [len(t) / max(n, 1) for t, n in zip(texts, tags)]
        weight = [0.1353352832366127, 0.6065306597126334, 1, 0.6065306597126334, 0.1353352832366127]
        smooth = []
        for i in range(len(ratios)):
            near = [(ratios[i + d - 2], weight[d]) for d in range(5) if 0 <= i + d - 2 < len(ratios)]
            smooth.append(sum(r * w for r, w in near) / sum(w for _, w in near))
        mean = sum(smooth) / len(smooth)
        limit = 0.5 * (sum((r - mean) ** 2 for r in smooth) / len(smooth)) ** 0.5
        above = [i for i, r in enumerate(smooth) if r > limit]
        total = sum(len(texts[i]) for i in above)
        votes = {e: sum(len(texts[i]) for i in above if e in path(inner[i])) for e in range(len(parents))}
        regions = {e for e in votes if names[e] in ("main", "article") and any(e in path(i) for i in inner)}
        most = [e for e, v in votes.items() if v and v >= 0.7 * total and names[e] in ("div", "main", "article", "section")]
        chosen = set()
        if most:
            around = [e for e in path(max(most)) if e in regions]
            chosen = {around[0]} if around else {e for e in regions if votes[e]} or {max(most)}
        elif regions:
            chosen = regions
        wanted = [i for i in range(len(texts)) if not chosen or chosen & set(path(inner[i]))]
        if abs(min((abs(r - limit) for r in smooth), default=1)) > 1e-9:
            assert html_text.elected(texts, tags, inner, names, parents) == wanted


# -- 8 repeated passages ----------------------------------------------------


def removed(texts):
    words = {i: WORD.findall(t or "") for i, t in texts.items()}
    seen, cover = set(), {i: set() for i in texts}
    for i in sorted(texts):
        for s in range(len(words[i]) - repeats.WINDOW + 1):
            window = tuple(words[i][s:s + repeats.WINDOW])
            if window in seen:
                cover[i].update(range(s, s + repeats.WINDOW))
            seen.add(window)
    return {i: (len(words[i]), len(cover[i]), " ".join(w for j, w in enumerate(words[i]) if j not in cover[i])) for i in texts}


def test_repeated_passages_are_those_of_brute_force(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_WINDOWS", 200)
    monkeypatch.setattr(repeats, "STREAM_WORDS", 300)
    monkeypatch.setattr(repeats, "PIECE_WINDOWS", 16)
    rng = random.Random(11)
    common, texts = prose(rng, 60, 5000), list(ODD)
    for i in range(120):
        own = prose(rng, rng.randrange(5, 120), 5000).split()
        if i % 3 == 0:
            at, a = rng.randrange(len(own)), rng.randrange(40)
            own[at:at] = common.split()[a:a + rng.randrange(15, 60)]
        if i % 20 == 0:
            own = own + own
        texts.append(" ".join(own))
    texts += texts[15:40] + [prose(rng, 3, 3) + " a b" * 80]
    got = {r["doc_id"]: r for r in repeats.without_repeats(docs_of(spark, texts, extra=True)).collect()}
    for i, want in removed(dict(enumerate(texts))).items():
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept"]) == want


def test_repeated_passages_of_odd_tables(spark):
    assert repeats.without_repeats(docs_of(spark, [], [])).count() == 0
    text = prose(random.Random(12), 30, 5000)
    twins = repeats.without_repeats(docs_of(spark, [text, text, text], [1, 1, None])).collect()
    assert sorted((r["doc_id"] or 99, r["n_removed"]) for r in twins) == [(1, 0), (1, 0), (99, 30)]


# -- 9 token files ----------------------------------------------------------


@pytest.mark.parametrize("block", [7, 2048])
def test_range_coder_round_trip(block):
    rng = np.random.default_rng(13)
    for ids in ([], [5], [0] * 10, [65535] * 3000, rng.integers(0, 50257, 2049), rng.integers(0, 3, 5000), np.tile(rng.integers(0, 50257, 90), 60)):
        ids = np.array(ids, np.uint32)
        assert np.array_equal(range_coder.decode(range_coder.encode(ids, block)), ids)


def test_range_coder_learns_and_notices_damage():
    rng = np.random.default_rng(14)
    ids = np.tile(rng.integers(0, 50257, 50).astype(np.uint32), 200)
    data = range_coder.encode(ids)
    assert len(data) < len(ids)
    with pytest.raises(ValueError):
        range_coder.decode(data[:-40] + bytes(b ^ 255 for b in data[-40:]))
    with pytest.raises(ValueError):
        range_coder.encode(np.array([1 << 16]))


def test_library_words_are_encoded_as_whole_texts():
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    texts = odd_texts()
    for text, packed in zip(texts, bpe.Words(token_files.Library(JSON).encode).encode(texts)):
        assert np.frombuffer(packed, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_token_files(spark, monkeypatch):
    tokenizer = Tokenizer.from_file(JSON)
    rng = random.Random(15)
    texts = [*ODD, *(prose(rng, rng.randrange(0, 50)) for _ in range(50))]
    rows = {r["doc_id"]: r for r in token_files.read(token_files.write(docs_of(spark, texts, extra=True), JSON)).collect()}
    at = 0
    for i, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [token_files.END], "<u4")
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert token_files.read(token_files.write(docs_of(spark, [], []), JSON)).count() == 0
    odd = token_files.read(token_files.write(docs_of(spark, ["a", None, "b"], [4, 4, None]), JSON)).collect()
    assert sorted(r["start"] for r in odd) == [0, 1, 3]


def test_token_files_of_texts_with_added_tokens(spark):
    tokenizer = Tokenizer.from_file(JSON)
    texts = ["a<|endoftext|>b", "<|endoftext|>", "plain words", " x <|endoftext|> <|endoftext|>y z", "<|endoftext", None, "a b"]
    rows = {r["doc_id"]: r for r in token_files.read(token_files.write(docs_of(spark, texts), JSON)).collect()}
    at = 0
    for i, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [token_files.END], "<u4")
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert rows[0]["n_tokens"] == 4


def mixed_texts(n, seed):
    """Texts of characters that the pattern treats in different ways, in short runs."""
    rng = random.Random(seed)
    signs = [*"aZst'.,-1 \n\t\r\x1c\x85\xa0", " ", " ", "\n", " the", "é", "ÿ", "×", "÷", "ß", "Ω", "日", "́", "²", " ", " ", "　", "—", "'s", "'re", "<|endoftext|>", "😀", "​", "_"]
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(0, 40))) for _ in range(n)]


def assert_encoded(texts, tokenizer, encoder):
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    assert len(counts) == len(texts) and ends[-1] == len(ids)
    for text, a, b in zip(texts, (ends - counts).tolist(), ends.tolist()):
        assert ids[a:b].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_texts_are_encoded_as_by_the_library():
    tokenizer = Tokenizer.from_file(JSON)
    encoder = token_files.Texts(JSON)
    for texts in (odd_texts(), mixed_texts(3000, 16), mixed_texts(3000, 17), [None, ""], ["", "a", None], [""]):
        assert_encoded(texts, tokenizer, encoder)


def test_texts_whose_words_share_hashes_or_fill_the_table(monkeypatch):
    tokenizer = Tokenizer.from_file(JSON)
    monkeypatch.setattr(word_table, "KEPT_WORDS", 1 << 10)
    monkeypatch.setattr(word_table, "CHUNK_BYTES", 256)
    encoder = token_files.Texts(JSON)
    assert_encoded(mixed_texts(500, 18) + [prose(random.Random(19), 3000, 3000), "x" * 5000], tokenizer, encoder)
    exact = word_table.span_hashes
    monkeypatch.setattr(word_table, "span_hashes", lambda *a: exact(*a) % np.uint64(50))
    assert_encoded(mixed_texts(500, 20), tokenizer, token_files.Texts(JSON))


def test_words_between_other_signs_are_not_encoded_again(monkeypatch):
    encoder = token_files.Texts(JSON)
    encoder.encode(pa.array(["a first, second third. é zwölf"]))
    taken = []
    encode = encoder.words.encode_words
    monkeypatch.setattr(encoder.words, "encode_words", lambda data, begin, end: taken.extend(data[a:b].tobytes() for a, b in zip(begin, end)) or encode(data, begin, end))
    encoder.encode(pa.array(["a second, zwölf. first third! third. é"]))
    assert taken == [b"!"]


def test_what_a_task_leaves_is_bounded():
    encoder = token_files.Texts(JSON)
    encoder.encode(pa.array(["日本語" * 500 + " " + "x" * 5000 + " plain words", "日本語"]))
    assert max(map(len, encoder.library.known)) <= word_table.LONGEST
    assert encoder.words.n_bytes.values.max() <= word_table.LONGEST


def test_range_coder_codes_an_id_by_how_often_it_came():
    # No order 1 or 2 helps: independent ids, of which few are common. 4.6 bits each at best.
    rng = np.random.default_rng(22)
    ids = (rng.zipf(1.6, 60_000) * 7919 % 50257).astype(np.uint32)
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    best = -(share * np.log2(share)).sum()
    data = range_coder.encode(ids)
    assert len(data) * 8 / len(ids) < best + 1.5
    assert np.array_equal(range_coder.decode(data), ids)


# -- 10 nearest neighbours --------------------------------------------------


def test_nearest_neighbours_by_brute_force(spark):
    rng = np.random.default_rng(16)
    x = rng.standard_normal((1500, 16)).astype(np.float32) * rng.uniform(0.5, 2, (1500, 1)).astype(np.float32)
    x[100:160] = x[7]
    rows = [(i, v.tolist(), "o") for i, v in enumerate(x)]
    bad = [(9001, None, "o"), (9002, [0.0] * 16, "o"), (9003, [float("nan")] * 16, "o"), (9004, [1.0, None] * 8, "o"), (9005, [1.0], "o"), (None, [1.0] * 16, "o"), (9006, [], "o")]
    df = spark.createDataFrame(rows + bad + rows[:3], "vec_id long, embedding array<float>, query string")
    got = nn_descent.nearest(df, asks=F.col("id") % 20 == 0).collect()
    by_query = {}
    for r in got:
        by_query.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(by_query) == {i for i in range(1500) if i % 20 == 0}
    hits = 0
    wide = x.astype(float)
    for q, found in by_query.items():
        found.sort()
        scores = wide @ wide[q]
        scores[q] = -np.inf
        true = np.lexsort((np.arange(1500), -scores))[:20]
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(abs(f[2] - scores[f[1]]) < 1e-9 for f in found)
        hits += len({f[1] for f in found} & {*true.tolist()})
    assert hits >= 0.9 * 20 * len(by_query)


def test_nearest_neighbours_of_small_tables(spark):
    kinds = "vec_id long, embedding array<float>"
    assert nn_descent.nearest(spark.createDataFrame([], kinds)).count() == 0
    assert nn_descent.nearest(spark.createDataFrame([(0, [1.0, 0.0])], kinds)).count() == 0
    rows = nn_descent.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0])], kinds)).collect()
    assert [r["vec_id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == 1] == [0, 3, 2]


def recall_of(spark, x, asks):
    """Share of the true 20 nearest that are found, and of the true nearest."""
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = {}
    for r in nn_descent.nearest(df, asks=asks).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    wide, hits, first = x.astype(float), 0, 0
    for q, ids in found.items():
        scores = wide @ wide[q]
        scores[q] = -np.inf
        true = np.lexsort((np.arange(len(x)), -scores))[:20].tolist()
        hits += len(ids & {*true})
        first += true[0] in ids
    return hits / (20 * len(found)), first / len(found)


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_nearest_neighbours_among_near_copies(spark):
    rng = np.random.default_rng(17)
    x = unit(rng.standard_normal((1000, 64)))
    x[:500] = unit(x[0] + 0.003 * rng.standard_normal((500, 64)))
    assert recall_of(spark, x.astype(np.float32), (F.col("id") < 500) & (F.col("id") % 10 == 0))[0] >= 0.9


@pytest.mark.parametrize("long", [1, 40])
def test_nearest_neighbours_beside_long_vectors(spark, long):
    rng = np.random.default_rng(18)
    x = unit(rng.standard_normal((1000, 32)) + 2 * rng.standard_normal((20, 32))[rng.integers(0, 20, 1000)])
    x[:long] *= 100
    recall, first = recall_of(spark, x.astype(np.float32), F.col("id") % 20 == 3)
    assert recall >= 0.9 and first == 1


def test_nearest_neighbours_without_clusters(spark):
    x = unit(np.random.default_rng(19).standard_normal((6000, 64)))
    assert recall_of(spark, x.astype(np.float32), F.col("id") % 60 == 0)[0] >= 0.95


def test_vectors_of_each_number_of_components_are_searched(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 5)] + [(i, [float(i)]) for i in (11, 12)] + [(20, [1.0, 2.0, 3.0])]
    found = nn_descent.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    pairs = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in found}
    assert pairs[11, 1] == (12, 132.0) and pairs[12, 1] == (11, 132.0)
    assert [pairs[4, k] for k in (1, 2, 3)] == [(3, 13.0), (2, 9.0), (1, 5.0)]
    assert len(pairs) == 4 * 3 + 2


def test_a_round_takes_the_place_of_the_one_before(spark):
    one = shared.stored(spark.range(5), "round")
    two = shared.stored(one.where("id > 1"), "round", one)
    assert two.count() == 3 and two.inputFiles()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(one.stored_at)
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

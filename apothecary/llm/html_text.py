"""Main text of web pages by text-to-tag ratios.

The page is fed to the standard library's streaming parser. Its events are turned
into lines, one for each block: the text, the tags met in it, the open elements.
Lines outside boilerplate have a ratio of characters to tags; the ratios are smoothed
with a Gaussian over neighbouring lines and clustered by a threshold, a share of
their standard deviation. The lines above it vote for the elements they lie in. The
region is the deepest element with most of their text, or the article or main
element around it, and all its lines are the main text, short ones too. Without
any line above the threshold the article or main elements are the region, and
without those the whole page.

Boilerplate is never a line: menus, headers and footers of the site, sidebars,
notices, adverts, forms, scripts, styles, reader comments, hidden elements. It is
told by element names, and by whole names in class, id and role. Names, and the elements
that may also wrap a page (a form, a button, an aside), are weighed when
the page has been read: they do not count on the page itself, its main parts and
headings, nor on an element with over half of the text, unless that is of comments
beside other text. A body, or anything that has no place in a head, ends a head left open.

Elements are numbered, each knows the one around it, and places of open ones are kept by
name; time and memory grow with the page, also where nothing is ever closed.

Character references are decoded; white space inside a block becomes one space; blocks
are joined by a line feed. A null or empty page has an empty text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser
from statistics import pstdev

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from apothecary.llm.bpe import with_column
from apothecary.llm.textvec import sliced

# HTML element names by how they are treated.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot"
    " th thead title tr ul".split()
)
SKIPPED = frozenset(
    "canvas dialog footer head iframe input menu nav noscript object script select style svg template textarea title".split()
)
WEIGHED = frozenset(("aside", "button", "form"))
IN_HEAD = frozenset("base link meta noscript script style template title".split())
ENDS_PARAGRAPH = BLOCK - {"body", "html"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIERS = frozenset("ul ol dl table div section article main body html aside nav footer header form".split())
REGIONS = frozenset(("article", "main"))
# Words of which names in class, id or role are made that mean boilerplate.
BOILERPLATE = frozenset(
    "ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer"
    " disqus footer gdpr menu modal nav navbar navigation newsletter notice notification pagination popup promo related reply replies"
    " search share sharing sidebar social sponsor sponsored subscribe toolbar widget complementary contentinfo alert".split()
)
# Only outside an article: a page's header, not the article's.
SITE_ONLY = frozenset(("header", "masthead"))
# Words that such a name may have beside one of those.
AFFIXES = frozenset(
    "area bar block body bottom box btn button buttons container content form global group header icons inner item items left"
    " links list main message overlay page primary right section secondary signup site slot thread top unit wrap wrapper".split()
)
COMMENTS = frozenset("comment comments disqus reply replies".split())
NEVER = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
_TOKEN = re.compile(r"[a-z]+|[0-9]+")
RADIUS, SIGMA, SHARE, MOST = 2, 1.0, 0.5, 0.7


@lru_cache(maxsize=10_000)
def named(value: str, inside: bool, numbered: bool) -> frozenset[str]:
    """Words of boilerplate in a list of names that are made of nothing but such words and what goes with them."""
    telling = BOILERPLATE if inside else BOILERPLATE | SITE_ONLY
    found: set[str] = set()
    for name in value.lower().split():
        words = set(_TOKEN.findall(name))
        if words & telling and all(w in telling or w in AFFIXES or numbered and w.isdecimal() for w in words):
            found |= words & telling
    return frozenset(found)


class Lines(HTMLParser):
    """Blocks of a page: ``pieces`` of text, ``tags`` met in each, and the innermost element of each."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # Pieces: text, and the innermost element around it that is boilerplate by name, or -1.
        self.pieces: list[list[tuple[str, int]]] = []
        self.tags: list[int] = []
        self.inner: list[int] = []
        # Of each element its name and the element around it, or -1.
        self.names: list[str] = []
        self.parents: list[int] = []
        # Open elements: name, number, whether boilerplate, and as in pieces.
        self.open: list[tuple[str, int, bool, int]] = []
        # Places of the open elements of a name, and of those that paragraphs and items don't reach over.
        self.places: dict[str, list[int]] = {}
        self.barriers: list[int] = []
        self.held: list[tuple[str, int]] = []
        self.met = 0
        # Elements that are boilerplate by name: the one around it, whether of comments, and characters right in them.
        self.around: dict[int, int] = {}
        self.comments: dict[int, bool] = {}
        self.sizes: dict[int, int] = {}
        self.size = 0

    def end_line(self) -> None:
        if any(text and not text.isspace() for text, _ in self.held):
            self.pieces.append(self.held)
            self.tags.append(self.met)
            self.inner.append(self.open[-1][1] if self.open else -1)
            self.met = 0
        self.held = []

    def lines(self) -> tuple[list[str], list[int], list[int]]:
        """Texts, tags and innermost elements without boilerplate; its tags go to the line that follows."""
        sizes = dict(self.sizes)
        for e in reversed(self.around):
            if self.around[e] >= 0:
                sizes[self.around[e]] = sizes.get(self.around[e], 0) + sizes.get(e, 0)
        kept = {-1}
        for e, outer in self.around.items():
            n = sizes.get(e, 0)
            if outer in kept and 2 * n > self.size and (n == self.size or not self.comments[e]):
                kept.add(e)
        texts, tags, inner, met = [], [], [], 0
        for pieces, here, element in zip(self.pieces, self.tags, self.inner):
            met += here
            text = " ".join("".join([t for t, named in pieces if named in kept]).split())
            if text:
                texts.append(text)
                tags.append(met)
                inner.append(element)
                met = 0
        return texts, tags, inner

    def close_to(self, at: int) -> None:
        if any(name in BLOCK for name, _, _, _ in self.open[at:]):
            self.end_line()
        for name, _, _, _ in self.open[at:]:
            self.places[name].pop()
        while self.barriers and self.barriers[-1] >= at:
            self.barriers.pop()
        del self.open[at:]

    def last(self, *names: str) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def end_head(self, tag: str | None) -> None:
        """A body ends a head wherever it comes, other content where it stands right in the head."""
        at = self.last("head")
        if at >= 0 and (tag == "body" or at == len(self.open) - 1 and tag not in IN_HEAD):
            self.close_to(at)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.met += 1
        self.end_head(tag)
        wanted = self.last(*(("p",) if tag in ENDS_PARAGRAPH else ()), *SIBLINGS.get(tag, ()))
        if wanted > (self.barriers[-1] if self.barriers else -1):
            self.close_to(wanted)
        if tag in BLOCK:
            self.end_line()
        elif tag == "br":
            self.held.append((" ", -1))
        if tag in VOID:
            return
        parent, inherited, named = self.open[-1][1:] if self.open else (-1, False, -1)
        inside = self.last(*REGIONS) >= 0
        words = self.words(attrs, inside) if not inherited and tag not in NEVER else frozenset()
        number = len(self.names)
        if words or tag in WEIGHED and not inherited:
            self.around[number] = named
            named = number
            self.comments[number] = bool(words & COMMENTS)
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in BARRIERS:
            self.barriers.append(len(self.open))
        self.open.append((tag, number, inherited or self.is_boilerplate(tag, attrs, inside), named))
        self.names.append(tag)
        self.parents.append(parent)

    def is_boilerplate(self, tag: str, attrs: list[tuple[str, str | None]], inside: bool) -> bool:
        if tag in SKIPPED:
            return True
        if tag == "header" and not inside:
            return True
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if name == "style" and value and "display:none" in value.replace(" ", "").lower():
                return True
        return False

    def words(self, attrs: list[tuple[str, str | None]], inside: bool) -> frozenset[str]:
        found = [named(value, inside, name == "class") for name, value in attrs if name in ("class", "id", "role") and value]
        return frozenset().union(*found)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1][0] == tag:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.met += 1
        at = self.last(tag)
        if at >= 0:
            self.close_to(at)

    def handle_data(self, data: str) -> None:
        if not data.isspace():
            self.end_head(None)
        _, inherited, named = self.open[-1][1:] if self.open else (-1, False, -1)
        if not inherited:
            self.held.append((data, named))
            size = len("".join(data.split()))
            self.size += size
            if named >= 0:
                self.sizes[named] = self.sizes.get(named, 0) + size


def smoothed(ratios: list[float]) -> list[float]:
    weights = [math.exp(-(d * d) / (2 * SIGMA**2)) for d in range(-RADIUS, RADIUS + 1)]
    out = []
    for i in range(len(ratios)):
        near = [(ratios[i + d], w) for d, w in zip(range(-RADIUS, RADIUS + 1), weights) if 0 <= i + d < len(ratios)]
        out.append(sum(r * w for r, w in near) / sum(w for _, w in near))
    return out


def summed_up(parents: list[int], own: list[int]) -> list[int]:
    """Sums over each element and those in it; elements have smaller numbers than what they hold."""
    sums = list(own)
    for e in range(len(sums) - 1, 0, -1):
        if parents[e] >= 0:
            sums[parents[e]] += sums[e]
    return sums


def elected(texts: list[str], tags: list[int], inner: list[int], names: list[str], parents: list[int]) -> list[int]:
    """The lines of the region that the lines above the threshold vote for."""
    ratios = smoothed([len(t) / max(n, 1) for t, n in zip(texts, tags)])
    threshold = SHARE * pstdev(ratios)
    voted, lines, total = [0] * len(names), [0] * len(names), 0
    for text, ratio, element in zip(texts, ratios, inner):
        if element >= 0:
            lines[element] += 1
            voted[element] += len(text) * (ratio > threshold)
        total += len(text) * (ratio > threshold)
    votes, lines = summed_up(parents, voted), summed_up(parents, lines)
    regions = {e for e, name in enumerate(names) if name in REGIONS and lines[e]}
    # Numbers grow with depth along a path, and at most one element of a depth has most of the votes.
    most = [e for e, v in enumerate(votes) if v and v >= MOST * total and names[e] in BARRIERS]
    chosen: set[int] = set()
    if most:
        outer, at, around = max(most), max(most), False
        while at >= 0:
            if at in regions:
                outer, around = at, True
            at = parents[at]
        # Several articles may share the votes.
        chosen = {outer} if around else {e for e in regions if votes[e]} or {outer}
    elif regions:
        chosen = regions
    if not chosen:
        return list(range(len(texts)))
    within = [False] * len(names)
    for e, parent in enumerate(parents):
        within[e] = e in chosen or parent >= 0 and within[parent]
    return [i for i, element in enumerate(inner) if element >= 0 and within[element]]


def main_text(html: str) -> str:
    page = Lines()
    page.feed(html)
    page.close()
    page.end_line()
    texts, tags, inner = page.lines()
    if not texts:
        return ""
    return "\n".join(texts[i] for i in elected(texts, tags, inner, page.names, page.parents))


def extracted(df: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``df`` with the main text of each page in a column ``text``, in place of one of that name."""
    df = df.drop(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, html):
                found = [main_text(h) if h else "" for h in part.column(html).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string())], [*part.schema.names, text])

    return df.mapInArrow(run, with_column(df, text, T.StringType()))

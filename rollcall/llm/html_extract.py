"""HTML extraction by a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score above zero and tags below, each by its feature: log(1 + odds) of
lying inside the main text for a word, -log(1 + 1 / odds) for a tag, as counted on the labelled pages of
`labelled_pages`. One linear scan finds the contiguous region of greatest sum; its blocks are the text.

A feature tells where a word or tag stands: in an article, beside it, in a link, in prose, or in an aside (a menu,
notice, comment ...). Elements are asides by the sum of the log odds of their name, role and words of class and id,
counted on the same pages. No such word decides alone: an element that holds nearly all there is to read is none,
whatever it is called. What asides inside the region hold is left out. One pass in Arrow batches.
"""

from __future__ import annotations

import heapq
import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache, lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._session import prepare
from .labelled_pages import BEGIN, END, PAGES

# Fixed values of HTML: elements without content, elements whose content is no text, elements that start a block.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe noframes xmp svg object canvas audio video select".split())
#: Those of RAW that hold the rest of a page when nothing closes them; other unclosed ones hold nothing.
TO_THE_END = set("script style title textarea iframe noframes xmp".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead tr ul caption".split()
)
#: An element of the key closes an open one of the value, up to the nearest of _SCOPE.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = set("ul ol dl table div section article main body nav aside header footer form td th blockquote".split())

#: Elements whose names are features; others say nothing by themselves.
_NAMED = set("nav footer aside form button dialog menu search fieldset header".split())
#: Log odds of one feature lie between these; an element is an aside from ASIDE on.
ODDS, ASIDE = 4.0, -1.5
#: An aside is none if what is to read outside of all asides is less than this share of its words ...
REST = 0.3
#: ... where a word of a paragraph, an article or a main element counts so many times.
READ = 4

#: Outside of these a run of fewer words is more often a label than a text.
_PROSE = set("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dd".split())
SHORT = 6

#: Characters of scripts that put no spaces between words: Thai, Lao, Tibetan, Myanmar, Khmer, kana, Han. Two count as a word.
_UNSPACED = re.compile("[\u0e00-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?=>|\Z)|[^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=][^\s>/=]*)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>\"'][^\s>]*)))?")


@lru_cache(4096)
def _features(name: str, rest: str, in_article: bool) -> tuple[str, ...]:
    """What an element's name and attributes tell, without repeats."""
    found = {}
    if name in _NAMED:
        found[f"name {name}{' inside' if in_article else ''}"] = None
    if name in ("html", "body", "main"):
        rest = ""
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), next((v for v in values if v), "")
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            found["hidden"] = None
        elif key == "role":
            found[f"role {value.lower()}"] = None
        elif key in ("class", "id"):
            for word in re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()):
                found[f"{'article ' if name == 'article' else ''}class {word}"] = None
    return tuple(found)


def _count_words(text: str) -> int:
    return len(text.split()) + (0 if text.isascii() else len(_UNSPACED.findall(text)) // 2)


class Page:
    """A page's elements, and its runs of words and tags in order, decoded.

    Unclosed elements end with what holds them. runs are (kind, words, text, block, element, labelled); kind is
    'word' or a tag's name. Of elements there are the parent, features, the words that aren't of a link, and whether
    it or one around it is an article, a link, prose.
    """

    def __init__(self, page: str):
        self.runs: list[tuple[str, int, str, int, int, bool]] = []
        self.parent, self.features, self.words, self.read = [0], [()], [0], [0]
        self.article, self.link, self.prose = [False], [False], [False]
        self._parse(page)
        for i in range(len(self.parent) - 1, 0, -1):
            self.words[self.parent[i]] += self.words[i]

    def _parse(self, page: str) -> None:
        stack: list[tuple[str, int]] = [("", 0)]  # open elements
        opened: Counter[str] = Counter()
        unclosed: set[str] = set()  # of RAW, that nothing further on closes
        at, block, size, labelled = 0, 0, len(page), False

        def text(raw: str) -> None:
            decoded, own = html.unescape(raw), stack[-1][1]
            n = _count_words(decoded)
            if not self.link[own]:
                self.words[own] += n
                self.read[own] += n * (READ if self.prose[own] or self.article[own] else 1)
            self.runs.append(("word", n, decoded, block, own, labelled))

        def close(i: int) -> None:
            opened.subtract(s[0] for s in stack[i:])
            del stack[i:]

        def end_in_scope(names: set[str]) -> None:
            if not any(opened[n] for n in names):
                return
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in names:
                    close(i)
                    return
                if stack[i][0] in _SCOPE:
                    return

        while at < size:
            found = _TOKEN.search(page, at)
            if not found:
                text(page[at:])
                break
            if found.start() > at:
                text(page[at : found.start()])
            at = found.end()
            if found["name"] is None:
                if found[0].startswith("<![CDATA["):
                    text(found[0][9:].removesuffix("]]>"))
                elif found[0] in (BEGIN, END):
                    labelled = found[0] == BEGIN
                continue
            name, closing = found["name"].lower(), bool(found["close"])
            if name in RAW:
                if not closing and not found["rest"].rstrip().endswith("/"):
                    shut = None if name in unclosed else re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                    if not shut:
                        unclosed.add(name)
                    at = shut.end() if shut else size if name in TO_THE_END else at
                self.runs.append(("raw", 1, " ", block, stack[-1][1], labelled))
                continue
            if name in BLOCK:
                block += 1
            if closing:
                own = stack[-1][1]
                if opened[name]:
                    i = next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name)
                    own = stack[i][1]
                    close(i)
            else:
                if name in BLOCK:
                    end_in_scope({"p"})
                if name in CLOSES:
                    end_in_scope(CLOSES[name])
                own = around = stack[-1][1]
                features = _features(name, found["rest"], self.article[around])
                opens = name not in VOID and not found["rest"].endswith("/")
                if opens:
                    own = len(self.parent)
                    self.parent.append(around)
                    self.features.append(features)
                    self.words.append(0)
                    self.read.append(0)
                    self.article.append(self.article[around] or name in ("article", "main"))
                    self.link.append(self.link[around] or name == "a")
                    self.prose.append(self.prose[around] or name in _PROSE)
                    stack.append((name, own))
                    opened[name] += 1
            self.runs.append((name, 1, " " if name == "br" else "", block, own, labelled))

    def asides(self, odds: dict[str, float]) -> list[bool]:
        """Of each element whether it is in an aside."""
        n = len(self.parent)
        marked = [sum(odds.get(f, 0.0) for f in features) <= ASIDE for features in self.features]
        marked[0] = False
        # The nearest marked element of each, and the marks and words to read that are directly below each mark.
        nearest, below, read = [0] * n, {0: []}, Counter()
        for i in range(1, n):
            up = nearest[self.parent[i]]
            nearest[i] = i if marked[i] else up
            if marked[i]:
                below[i] = []
                below[up].append(i)
        for i in range(n):
            read[nearest[i]] += self.read[i]
        outside, heap = read[0], [(-self.words[i], i) for i in below[0]]
        heapq.heapify(heap)
        while heap and outside < REST * -heap[0][0]:
            i = heapq.heappop(heap)[1]
            marked[i] = False
            outside += read[i]
            for j in below[i]:
                heapq.heappush(heap, (-self.words[j], j))
        for i in range(1, n):
            marked[i] = marked[i] or marked[self.parent[i]]
        return marked


class Node:
    """A run of words or a tag: its feature, how often it counts, its text and block, whether an aside holds it, and its label."""

    __slots__ = ("aside", "block", "feature", "labelled", "n", "text")

    def __init__(self, feature: str, n: int, text: str, block: int, aside: bool, labelled: bool):
        self.feature, self.n, self.text, self.block, self.aside, self.labelled = feature, n, text, block, aside, labelled


def nodes(page: str, odds: dict[str, float] | None = None) -> list[Node]:
    """The page's words and tags with their features."""
    own = Page(page)
    aside = own.asides(element_odds() if odds is None else odds)
    clean = [r for i, r in enumerate(own.read) if not aside[i]]
    in_article = [r for i, r in enumerate(own.read) if not aside[i] and own.article[i]]
    has_article = 2 * sum(in_article) >= sum(clean) > 0 and sum(in_article) > 0
    out: list[Node] = []
    for kind, n, text, block, at, labelled in own.runs:
        inside = has_article and own.article[at]
        if kind == "word":
            place = "aside" if aside[at] else "article" if inside else "beside" if has_article else "link" if own.link[at] else "short" if n < SHORT and not own.prose[at] else "plain"
            out.append(Node(f"word {place}", n, text, block, aside[at], labelled))
        elif aside[at] and aside[own.parent[at]]:
            out.append(Node("", 0, text, block, True, labelled))  # an aside is one step, however many tags it has
        elif aside[at]:
            out.append(Node("tag aside", 1, text, block, True, labelled))
        elif kind == "raw":
            out.append(Node("tag raw", 1, text, block, False, labelled))
        else:
            name = kind if kind in ("p", "a", "li", "div", "article", "main", "br") else "heading" if re.fullmatch("h[1-6]", kind) else "block" if kind in BLOCK else "inline"
            out.append(Node(f"tag {name}{' inside' if inside and name not in ('article', 'main') else ''}", 1, text, block, False, labelled))
    return out


@cache
def element_odds() -> dict[str, float]:
    """Log odds, for each feature of an element, that it holds labelled words; each element counts once, by its shares, and odds stay within ODDS."""
    inside, outside = Counter(), Counter()
    for page in PAGES:
        own = Page(page)
        words, labels = [0] * len(own.parent), [0] * len(own.parent)
        for kind, n, _, _, at, labelled in own.runs:
            if kind == "word":
                words[at] += n
                labels[at] += n * labelled
        for i in range(len(own.parent) - 1, 0, -1):
            words[own.parent[i]] += words[i]
            labels[own.parent[i]] += labels[i]
            for f in own.features[i] if words[i] else ():
                inside[f] += labels[i] / words[i]
                outside[f] += 1 - labels[i] / words[i]
    return {f: max(-ODDS, min(ODDS, math.log((inside[f] + 0.1) / (outside[f] + 0.1)))) for f in {*inside, *outside}}


@cache
def weights() -> dict[str, float]:
    """The score of each feature of words and tags, from its odds of being labelled: above zero for words, below for tags."""
    inside, outside = Counter(), Counter()
    for page in PAGES:
        for n in nodes(page):
            (inside if n.labelled else outside)[n.feature] += n.n
    found = {f: (inside[f] + 0.5) / (outside[f] + 0.5) for f in {*inside, *outside} if f}
    return {f: -math.log(1 + 1 / odds) if f.startswith("tag") else math.log(1 + odds) for f, odds in found.items()}


#: The score of a tag that no labelled page has.
UNSEEN = -0.05


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run of greatest sum; (0, 0) if no score is above zero. Ties: the first, longest."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total < 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, span = total, (start, i + 1)
    return span


def main_text(page: str | None) -> str:
    """The page's main text: blocks in page order joined by \\n, white space inside one turned into one space."""
    if not page:
        return ""
    w = weights()
    own = nodes(page)
    start, stop = best_region([n.n * w.get(n.feature, UNSEEN) for n in own])
    blocks: dict[int, list[str]] = {}
    for n in own[start:stop]:
        if not n.aside and n.text:
            blocks.setdefault(n.block, []).append(n.text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row of pages(page_id, url, html, ...).

    Null or empty html, or a page without main text, gives the empty text; of regions of equal score the first is
    the text; a very long page is read whole, in time in proportion to its length; repeated rows are pages of their
    own; null ids and urls stay; extra columns are ignored; an empty table gives an empty result.
    """
    prepare(pages.sparkSession)
    pages = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url {pages.schema['url'].dataType.simpleString()}, text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html_column = _text.plain(batch.column(2))
            for start, stop in _text.steps(html_column):
                texts = [main_text(p.as_py()) for p in html_column.slice(start, stop - start)]
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.mapInArrow(run, schema)

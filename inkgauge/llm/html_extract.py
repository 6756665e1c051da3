"""Main text of web pages: the maximum-scoring subsequence of a page's tokens.

A page is read as a sequence of tokens: words, tags, and asides, that is elements
which by name, role or class are menus, page headers, footers, sidebars, notices,
adverts, forms, scripts, styles or reader comments, each one token with all it holds.
Words score positive, tags and asides negative; one linear scan finds the contiguous
region of the highest score, the first and shortest of equals. The text is what the
region holds, without the asides inside it.

Weights are learned from labelled pages: pages that mark their content themselves, by
one ``article`` or ``main`` element. A kind of token (a word by its innermost telling
element, a tag by its name, an aside by its reason) weighs the logarithm of its odds
to lie inside the marked part, with PRIOR pseudo-counts around the plain weights of
the method (a word 1, a tag -1, or -0.1 where texts use it, an aside -2), which are
also those of unseen kinds.
The marking tags themselves are no evidence: they are read as any other ``div``.

Blocks are the page's block elements. References are decoded as HTML 5 does, white
space (Unicode's) inside a block becomes one space, blocks are joined by an empty line.
A null or empty page, or one without a region, has the empty text. Tags may be left
open and pages end anywhere. A null page id is kept as it is.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from inkgauge.llm.frames import sample_per_class
from inkgauge.session import ship_package

SAMPLE = 2048  # labelled pages of which weights are learned at most
PRIOR = 16.0  # pseudo-counts of a kind
LIMIT = 4.0  # of a learned weight
LEAST = 0.05  # of a word outside links
PLAIN = {"word": 1.0, "link": -0.5, "text tag": -0.1, "tag": -1.0, "aside": -2.0}

# Names of HTML elements by their role, and words in class, id or role
# attributes and headings that tell what an element is.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math object".split())
ASIDES = frozenset(
    "nav header footer aside form menu dialog head button select label fieldset input audio video canvas map search".split()
)
INLINE = frozenset("a abbr b big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split())
KNOWN = BLOCKS | VOID | RAW | ASIDES | INLINE
TEXT_TAGS = INLINE | frozenset(
    "p h1 h2 h3 h4 h5 h6 br hr img li ul ol dl dt dd blockquote pre figure figcaption table caption tbody thead tr td th wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MARKS = ("article", "main")
# an open p ends where one of these starts
_ENDS_P = BLOCKS - frozenset("body html head td th tr tbody thead tfoot caption option optgroup legend summary title".split())
_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_FENCE = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promotion "
    "nav navbar navigation navi menu submenu breadcrumb breadcrumbs pagination pager toc "
    "header masthead topbar footer foot bottombar copyright legal imprint "
    "sidebar sidebars aside side rail widget widgets related recommended recommendations teaser trending popular "
    "comment comments commentlist commentsection disqus respond responses reply replies discussion reviews feedback "
    "cookie cookies consent gdpr notice notices alert popup modal overlay lightbox disclaimer "
    "share sharing social follow newsletter subscribe subscription signup login search searchbox form "
    "toolbar skip hidden".split()
)
# of an article or main element, only these
CARD_WORDS = frozenset("comment comments reply replies response related recommended teaser promo sponsored ad advert".split())
# a class that begins like this tells of a state; with these words a header is the article's own
STATES = frozenset("has with no without is".split())
CONTENT_WORDS = frozenset("article post entry story content".split())
# asides that may hold a whole page: they end where an article or main element starts
HOLDERS = frozenset("head form header hidden modal overlay skip toolbar banner".split())
# these end such words in one piece with others, as in pagefooter or cookiebar
_ENDINGS = ("sidebar", "footer", "navbar", "comments", "banner", "cookie", "cookiebar", "advert", "menu")
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
COMMENT_HEADINGS = frozenset(
    "comment comments kommentar kommentare commentaire commentaires comentario comentarios "
    "responses replies discussion reactions".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>=]+|=)*+)>"
    r"|</?[A-Za-z][^>]*\Z"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _aside_name(value: str, words: frozenset[str], marked: bool) -> str | None:
    """The first word of a class, id or label that names an aside."""
    for name in value.split():
        pieces = [w.lower() for w in _PIECES.findall(name)]
        if not pieces or pieces[0] in STATES:
            continue
        for word in pieces:
            if word == "header" and (marked or not CONTENT_WORDS.isdisjoint(pieces)):
                continue
            if word in words:
                return word
            if words is ASIDE_WORDS and word.endswith(_ENDINGS):
                return next(e for e in _ENDINGS if word.endswith(e))
    return None


def aside_reason(name: str, rest: str, marked: bool) -> str | None:
    """Why an element is no part of an article, if so; ``marked``: it lies in an article element."""
    if name in ASIDES and not (marked and name == "header"):
        return name
    if "=" not in rest and "hidden" not in rest or name in ("html", "body"):
        return None
    words = CARD_WORDS if name in MARKS else ASIDE_WORDS
    for key, a, b, c in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), a or b or c
        if key in ("class", "id", "aria-label"):
            if found := _aside_name(value, words, marked):
                return found
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _UNSEEN.search(value):
            return "hidden"
        elif key == "role" and value.lower() in ROLES:
            return "role"
    return None


class Page:
    """Tokens of a page: (kind, amount, block, text) and where marked content lies.

    Words of one run share a token, since they weigh the same. ``block`` numbers the
    block a run of words belongs to.
    """

    def __init__(self, source: str):
        self.tokens: list[tuple[str, int, int, str]] = []
        self.marked: list[tuple[int, int]] = []  # token ranges of article or main elements
        self._block = 0
        self._open: list[str] = []
        self._read(source)

    def _words(self, text: str) -> None:
        text = html.unescape(text) if "&" in text else text
        if not text:
            return
        n = len(text.split())
        inside = next((t for t in reversed(self._open) if t == "a" or t in BLOCKS), "")
        kind = "word:" + ("div" if inside in MARKS else inside)
        self.tokens.append((kind, n, self._block, text))

    def _tag(self, name: str) -> None:
        # the kinds are the names known here, so there are few of them
        name = "div" if name in MARKS else name if name in KNOWN else "other"
        self.tokens.append(("tag:" + name, 1, self._block, ""))

    def _close(self, name: str) -> None:
        """End an element and what is still open in it."""
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i] == name:
                for left in self._open[i:]:
                    if left in MARKS:
                        self._end_mark()
                del self._open[i:]
                return
            if name not in BLOCKS and self._open[i] in BLOCKS:
                return  # a stray end of an inline element

    def _end_mark(self) -> None:
        self._depth -= 1
        if self._depth == 0:
            self.marked.append((self._start, len(self.tokens)))

    def _read(self, source: str) -> None:
        self._depth, self._start = 0, 0
        at = 0
        skip: list[str] = []  # open elements of an aside, the aside first
        held = False  # the aside may hold a whole page
        heading = None  # numbers of tokens and open elements before a heading
        rest_of: int | None = None  # open elements around reader comments under a heading
        while found := _TOKEN.search(source, at):
            passed = bool(skip) or rest_of is not None
            if found.start() > at and not passed:
                self._words(source[at : found.start()])
            at = found.end()
            if not found["name"]:
                continue
            name, ends, rest = found["name"].lower(), bool(found["end"]), found["rest"]
            empty = name in VOID or rest.endswith("/")
            if name in RAW and not ends and not empty:
                # raw text: nothing but its own end tag counts
                close = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.I).search(source, at)
                at = close.end() if close else len(source)
                if not passed:
                    self._block += name in BLOCKS
                    self.tokens.append(("aside:" + name, 1, self._block, ""))
                continue
            if skip:
                if not (held and not ends and name in (*MARKS, "body") and (name == "body" or not aside_reason(name, rest, False))):
                    self._skip(skip, name, ends, empty)
                    continue
                self._open += skip[1:]  # the aside was around the content
                skip = []
            if name in BLOCKS:
                self._block += 1
            elif name == "br":
                if rest_of is None:
                    self.tokens.append(("tag:br", 1, self._block, " "))
                continue
            if ends:
                if rest_of is None:
                    self._tag(name)
                self._close(name)
                if heading and name in HEADINGS:
                    if rest_of is None and self._is_comment_heading(heading[0]):
                        del self.tokens[heading[0] :]
                        self.tokens.append(("aside:comments", 1, self._block, ""))
                        rest_of = heading[1]
                    heading = None
                if rest_of is not None and len(self._open) < rest_of:
                    rest_of = None
                continue
            self._implied(name)
            reason = aside_reason(name, rest, self._depth > 0)
            if reason:
                if rest_of is None:
                    self.tokens.append(("aside:" + reason, 1, self._block, ""))
                if not empty:
                    skip, held = [name], reason in HOLDERS
                continue
            if name in HEADINGS:
                heading = (len(self.tokens), len(self._open))
            if name in MARKS:
                if self._depth == 0:
                    self._start = len(self.tokens)
                self._depth += 1
            if rest_of is None:
                self._tag(name)
            if not empty:
                self._open.append(name)
        if not skip and rest_of is None:
            self._words(source[at:])
        while self._depth:
            self._end_mark()

    def _is_comment_heading(self, start: int) -> bool:
        words = re.findall(r"\w+", " ".join(t[3] for t in self.tokens[start:]).lower())
        words = [w for w in words if not w.isdigit()]
        return 0 < len(words) <= 3 and not COMMENT_HEADINGS.isdisjoint(words)

    def _implied(self, name: str) -> None:
        """End the elements that the start of another one ends."""
        if name in _ENDS_P and "p" in self._open:
            self._close("p")
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i] in _FENCE.get(name, ()):
                return
            if self._open[i] in _SAME.get(name, ()):
                del self._open[i:]
                return
            if name not in _SAME:
                return

    @staticmethod
    def _skip(skip: list[str], name: str, ends: bool, empty: bool) -> None:
        """Follow the elements inside an aside until it ends."""
        if ends:
            for i in range(len(skip) - 1, -1, -1):
                if skip[i] == name:
                    del skip[i:]
                    return
        elif not empty and (name == skip[0] or name in BLOCKS) and name != "p":
            skip.append(name)


def plain_weight(kind: str) -> float:
    if kind == "word:a":
        return PLAIN["link"]
    sort, _, name = kind.partition(":")
    return PLAIN["text tag" if sort == "tag" and name in TEXT_TAGS else sort]


def region(tokens: list[tuple[str, int, int, str]], weights: dict[str, float]) -> tuple[int, int]:
    """The token range [a, b) of the largest sum, the first and shortest of equals; (0, 0) if none is positive."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, (kind, n, _, _) in enumerate(tokens):
        weight = weights.get(kind)
        if weight is None:
            weight = weights[kind] = plain_weight(kind)
        if total <= 0.0:
            total, start = 0.0, i
        total += weight * n
        if total > best:
            best, span = total, (start, i + 1)
    return span


def main_text(source: str | None, weights: dict[str, float]) -> str:
    """Text of the best region: its blocks, each on one line, with an empty line between."""
    page = Page(source or "")
    a, b = region(page.tokens, weights)
    blocks: list[list[str]] = []
    last = None
    for _, _, block, text in page.tokens[a:b]:
        if text:
            if block != last:
                blocks.append([])
                last = block
            blocks[-1].append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks)
    return "\n\n".join([line for line in lines if line])


def kind_counts(source: str) -> Counter:
    """(kind, inside) counts of a page that marks one content element; empty for others."""
    page = Page(source)
    out: Counter = Counter()
    if len(page.marked) != 1:
        return out
    a, b = page.marked[0]
    for i, (kind, n, _, _) in enumerate(page.tokens):
        out[kind, a < i < b - 1] += n  # the marking tags themselves are left out below
    for edge in (a, b - 1):
        kind, n, _, _ = page.tokens[edge]
        out[kind, False] -= n
    return out


def learn_weights(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", sample: int = SAMPLE) -> dict[str, float]:
    """Weights by kind, from at most ``sample`` of the pages that mark their content."""
    labelled = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
    labelled = labelled.where(F.col("html").rlike("(?i)<(article|main)[\\s>]")).withColumn("one", F.lit(1))
    order: Column = F.xxhash64("id", "html")
    chosen = sample_per_class(labelled, "one", order, sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for i in range(len(batch)):
                total.update(kind_counts(batch.column(0)[i].as_py()))
        kinds = [k for k, n in total.items() if n > 0]
        yield pa.record_batch(
            [
                pa.array([k for k, _ in kinds], pa.string()),
                pa.array([inside for _, inside in kinds], pa.bool_()),
                pa.array([total[k] for k in kinds], pa.int64()),
            ],
            ["kind", "inside", "n"],
        )

    ship_package(pages.sparkSession)
    found = chosen.select("html").mapInArrow(count, "kind string, inside boolean, n bigint")
    counts: dict[str, list[int]] = {}
    for row in found.groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect():
        counts.setdefault(row["kind"], [0, 0])[row["inside"]] = row["n"]
    return {kind: learned_weight(kind, inside, outside) for kind, (outside, inside) in sorted(counts.items())}


def learned_weight(kind: str, inside: int, outside: int) -> float:
    """Log odds of a kind, PRIOR pseudo-counts being shared as its plain weight says.

    A word outside links weighs LEAST at least, a tag or an aside 0 at most.
    """
    share = 1 / (1 + math.exp(-plain_weight(kind)))
    weight = math.log((inside + PRIOR * share) / (outside + PRIOR * (1 - share)))
    weight = max(-LIMIT, min(LIMIT, weight))
    if kind.startswith("word:"):
        return weight if kind == "word:a" else max(LEAST, weight)
    return min(0.0, weight)


def extract_text(
    pages: DataFrame, weights: dict[str, float], html_col: str = "html", text_col: str = "text", n_col: str = "n_chars"
) -> DataFrame:
    """``pages`` with ``text_col`` and its code points instead of ``html_col``; weights are a few hundred numbers."""
    kept = [c for c in pages.columns if c not in (html_col, text_col, n_col)]
    schema = pages.select(*kept).schema.add(text_col, StringType()).add(n_col, LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(weights)
        for batch in batches:
            source = batch.column(len(kept))
            for at in range(0, max(1, len(batch)), 256):
                rows = min(256, len(batch) - at)
                texts = [main_text(source[at + i].as_py(), known) for i in range(rows)]
                columns = [batch.column(k).slice(at, rows) for k in range(len(kept))]
                columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [*kept, text_col, n_col])

    ship_package(pages.sparkSession)
    return pages.select(*kept, F.col(html_col).alias("_html")).mapInArrow(run, schema)

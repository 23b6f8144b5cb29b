"""Main text of web pages from flat blocks and a decision tree.

A page is read as a flat sequence of text blocks. A block is described by its number of words and the share of them in links, by
the same of the block before and after it, by whether it is a heading, and by the kind of element around it.
A decision tree, trained on the small labelled table ``LABELLED``, says which blocks belong to the
article. Pages do not depend on each other, so nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

RESULT = "page_id bigint, url string, text string, n_blocks int, n_kept int"
DEPTH = 8

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|aria-hidden|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Elements whose contents are not text of the page.
_HIDDEN = frozenset("script style noscript template svg math iframe object canvas audio video title textarea select button datalist head".split())
#: Those whose contents are no markup either.
_RAW = frozenset("script style textarea title noscript iframe".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that end a block.
_BLOCKS = _HEADINGS | frozenset(
    "html body main article section header footer nav aside form fieldset legend div p ul ol li dl dt dd table caption thead tbody tfoot tr td th"
    " blockquote pre figure figcaption address hr details summary center dialog menu search".split()
)
_OUTSIDE = frozenset("nav header footer aside form menu dialog search".split())
#: Parts of class names, ids and roles of what is not the article, and of what holds it.
_OUTSIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu menubar submenu breadcrumb breadcrumbs"
    " sidebar sidebars side aside widget widgets related recommended recommendations recommend teaser teasers trending popular footer foot header masthead topbar"
    " cookie cookies consent gdpr notice notices notification alert alerts warning popup modal overlay dialog newsletter subscribe subscription signup signin login register"
    " form search searchbox share sharing social comment comments commentlist disqus reply replies respond discussion feedback reviews tags tagcloud pagination pager"
    " copyright legal disclaimer toolbar skip contentinfo complementary hidden paywall rating".split()
)
_MAIN_NAMES = frozenset("article main content post entry story articlebody postbody maincontent bodytext".split())


@dataclass(slots=True)
class Piece:
    """A block: its text, its words, those in links, whether it is a heading, and what is around it."""

    text: str
    words: int
    linked: int
    heading: bool
    level: int
    outside: bool


@dataclass(slots=True)
class _Open:
    tag: str
    level: int
    outside: bool
    hidden: bool


def _around(tag: str, attributes: str, parent: _Open) -> _Open:
    """What an element says about its contents."""
    level, outside, hidden = parent.level, parent.outside, parent.hidden or tag in _HIDDEN
    names: set[str] = set()
    if attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key in ("class", "id", "role"):
                names.update(x.lower() for x in _NAME.findall(value))
            elif (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)) or (key == "hidden" or key == "aria-hidden" and value == "true"):
                hidden = True
    bad = bool(names & _OUTSIDE_NAMES) and tag not in ("body", "html", "main")
    if tag == "article" and not bad:
        level = max(level, 3)
        outside = outside and parent.tag != "form" and not _only_form(parent)
    elif tag == "main" or "main" in names and not bad and tag not in ("body", "html"):
        level = max(level, 2)
        outside = outside and not _only_form(parent)
    elif names & _MAIN_NAMES and not bad and tag not in ("body", "html"):
        level = max(level, 1)
    if bad or (tag in _OUTSIDE and not (tag == "header" and level == 3)):
        outside = True
    return _Open(tag, level, outside, hidden)


def _only_form(parent: _Open) -> bool:
    """A form around a whole page, as some frameworks make, says nothing."""
    return parent.tag == "form" and parent.level == 0


@dataclass(slots=True)
class _Reader:
    pieces: list[Piece] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    heading: bool = False
    links: int = 0

    def add(self, text: str, around: _Open) -> None:
        if not around.hidden and text:
            self.parts.append(text)
            if self.links:
                self.linked.append(text)

    def end(self, around: _Open) -> None:
        if self.parts:
            text = _clean("".join(self.parts))
            if text:
                linked = len(_clean(" ".join(self.linked)).split()) if self.linked else 0
                words = text.count(" ") + 1
                self.pieces.append(Piece(text, words, min(words, linked), self.heading, around.level, around.outside))
            self.parts.clear()
            self.linked.clear()


def _clean(text: str) -> str:
    return " ".join((html.unescape(text) if "&" in text else text).split())


def blocks(page: str | None) -> list[Piece]:
    """The text blocks of a page, in its order; broken and unclosed markup is read as far as it goes."""
    page = page or ""
    reader = _Reader()
    stack = [_Open("", 0, False, False)]
    at = 0
    while True:
        found = _TAG.search(page, at)
        if not found:
            reader.add(page[at:], stack[-1])
            break
        reader.add(page[at : found.start()], stack[-1])
        at = found.end()
        close, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            reader.add(" ", stack[-1])
        if tag in _BLOCKS or tag in _HIDDEN:
            reader.end(stack[-1])
        if close:
            if tag == "a":
                reader.links = max(0, reader.links - 1)
            elif tag in _HEADINGS:
                reader.heading = False
            _close(stack, tag)
            continue
        if tag == "a":
            reader.links = 1
        elif tag in _HEADINGS:
            reader.heading = True
        elif tag == "p":
            _close(stack, "p")
        if tag in _RAW:
            # The contents end at the closing tag, or with the page.
            last = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = last.end() if last else len(page)
        elif tag not in _VOID and not attributes.endswith("/") and (tag in _BLOCKS or tag in _HIDDEN or "class" in attributes or "style" in attributes or "id" in attributes):
            if tag in _BLOCKS and tag not in ("p",):
                reader.links = 0
            stack.append(_around(tag, attributes, stack[-1]))
    reader.end(stack[-1])
    return reader.pieces


def _close(stack: list[_Open], tag: str) -> None:
    """Close the innermost open element of that name and what is open inside it; paragraphs don't reach out of their container."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag == tag:
            del stack[k:]
            return
        if tag in ("p", "b", "i", "a", "span", "li") and stack[k].tag in ("article", "main", "section", "div", "nav", "aside", "footer", "header", "form", "table", "body"):
            return


FEATURES = ("zone", "heading", "words", "linked", "words_before", "linked_before", "words_after", "linked_after")


def features(pieces: list[Piece]) -> np.ndarray:
    """One row of ``FEATURES`` for each block; a missing neighbour has no words."""
    best = max((p.level for p in pieces if not p.outside), default=0)
    out = np.zeros((len(pieces), len(FEATURES)))
    for k, p in enumerate(pieces):
        inside = best > 0 and p.level == best
        # Outside the article, beside an article, not known, inside the article.
        out[k, :4] = (-2 if p.outside else 1 if inside else -1 if best else 0), p.heading, p.words, p.linked / p.words
    out[1:, 4:6] = out[:-1, 2:4]
    out[:-1, 6:8] = out[1:, 2:4]
    return out


class Tree:
    """A decision tree for two classes, grown by the Gini measure."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = DEPTH):
        self.label = bool(2 * y.sum() > len(y))
        self.feature = None
        if depth and 0 < y.sum() < len(y):
            best = self._impurity(y) * len(y) - 1e-9
            for f in range(x.shape[1]):
                for cut in (np.unique(x[:, f])[:-1] + np.unique(x[:, f])[1:]) / 2:
                    low = x[:, f] <= cut
                    cost = self._impurity(y[low]) * low.sum() + self._impurity(y[~low]) * (~low).sum()
                    if cost < best - 1e-9:
                        best, self.feature, self.cut = cost, f, float(cut)
            if self.feature is not None:
                low = x[:, self.feature] <= self.cut
                self.low, self.high = Tree(x[low], y[low], depth - 1), Tree(x[~low], y[~low], depth - 1)

    @staticmethod
    def _impurity(y: np.ndarray) -> float:
        share = y.mean()
        return 2 * share * (1 - share)

    def says(self, row) -> bool:
        node = self
        while node.feature is not None:
            node = node.low if row[node.feature] <= node.cut else node.high
        return node.label


def _w(n: int) -> str:
    return "word " * n


#: Small pages; a block of the article begins with a plus, any other with a minus.
LABELLED = [
    f"<nav><ul><li><a>-Home</a><li><a>-News today</a></ul></nav><article><h1>+A headline</h1><p>+{_w(40)}</p><p>+Short.</p><p>+{_w(25)}</p></article><footer>-All rights {_w(6)}</footer>",
    f"<header><a>-Site</a> <p>-{_w(8)}</p></header><div class=ad>-{_w(12)}</div><main><h1>+Title of it</h1><p>+{_w(60)}</p><ul><li>+One</li><li>+Two of them</li></ul><p>+{_w(30)}</p></main><aside>-{_w(30)}</aside>",
    f"<div id=menu><a>-One</a></div><div id=content><h2>+Head</h2><p>+{_w(20)}<p>+Yes.<p>+{_w(50)}</div><div class=sidebar><h3>-More</h3><p>-{_w(22)}</p></div>",
    f"<article><h1>+Name</h1><p>+{_w(35)}</p><div class=ad>-{_w(15)}</div><p>+{_w(12)}</p><p>+<a>{_w(5)}</a></p></article><section class=comments><h2>-Comments</h2><p>-{_w(40)}</p><p>-{_w(3)}</p></section>",
    f"<div class=cookie-notice>-{_w(24)}</div><form><p>-Your mail</p><p>-{_w(10)}</p></form><article><p>+{_w(4)}</p><p>+{_w(70)}</p><blockquote>+{_w(18)}</blockquote></article><p>-{_w(5)}</p>",
    f"<div><a>-Start</a></div><div><a>-About us here</a></div><h1>+Title of the text</h1><p>+{_w(45)}</p><p>+{_w(30)}</p><p>+{_w(26)}</p><div>-{_w(5)}</div><div><a>-{_w(3)}</a></div>",
    f"<table><tr><td><a>-Link</a></td><td><a>-Link two</a></td></tr></table><h2>+Heading words</h2><p>+{_w(33)}</p><p>+{_w(14)}</p><p>+{_w(80)}</p><p><a>-{_w(6)}</a></p><p><a>-{_w(9)}</a></p><p>-{_w(4)}</p>",
    f"<p><a>-{_w(2)}</a></p><p>-{_w(3)}</p><p>+{_w(22)}</p><p>+{_w(7)}</p><p>+{_w(41)}</p><p>-{_w(2)}</p><p><a>-{_w(12)}</a></p>",
    f"<main><p>-{_w(6)}</p><article><header><h1>+Title</h1></header><p>+{_w(18)}</p></article><p>-{_w(28)}</p></main><div class=newsletter>-{_w(20)}</div>",
    f"<p>+{_w(120)}</p>",
    f"<article><h2>+Head</h2><ul><li>+One</li><li>+<a>Two</a></li><li>+Three</li></ul><p>+No.</p><p>+<a>{_w(20)}</a></p><p>+Yes</p></article><p>-{_w(40)}</p>",
    f"<main><p>+<a>Source</a></p><p>+A</p><p>+<a>More</a></p><p>+{_w(6)}</p><h3>+<a>Part</a></h3><p>+{_w(3)}</p><p>+<a>{_w(7)}</a></p></main><div>-<a>Up</a></div>",
    "<h1>+Title alone</h1><p>+A few words here.</p>",
    f"<div class=related><h3>-See too</h3><p>-{_w(16)}</p></div><div class=post-body><h1>+It</h1><p>+{_w(9)}</p></div><div class=author>-{_w(14)}</div>",
]


def trained(labelled: list[str] | None = None, depth: int = DEPTH) -> Tree:
    rows, labels = [], []
    for page in labelled or LABELLED:
        pieces = blocks(page)
        rows.append(features(pieces))
        labels += [p.text.startswith("+") for p in pieces]
    return Tree(np.concatenate(rows), np.array(labels, bool), depth)


def main_text(page: str | None, tree: Tree) -> tuple[str, int, int]:
    """The article's blocks, one a line; how many blocks there are, and how many are kept."""
    pieces = blocks(page)
    rows = features(pieces).tolist()
    kept = [p.text for p, row in zip(pieces, rows) if tree.says(row)]
    return "\n".join(kept), len(pieces), len(kept)


def extract(pages: DataFrame, labelled: list[str] | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_blocks`` and ``n_kept`` of every row of ``pages``.

    Reads ``page_id``, ``url`` and ``html``; other columns are ignored. Character references are decoded, white space in a block
    becomes one space, and blocks are joined by a line feed. Null, empty and textless pages have an
    empty text; rows that repeat an id are read one by one; an empty table stays empty.
    """
    tree = trained(labelled)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                found = [main_text(h.as_py(), tree) for h in part.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.int32()),
                        pa.array([f[2] for f in found], pa.int32()),
                    ],
                    ["page_id", "url", "text", "n_blocks", "n_kept"],
                )

    chosen = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return chosen.mapInArrow(work, RESULT)


def held_out_accuracy(using: tuple[str, ...] = FEATURES, labelled: list[str] | None = None) -> tuple[float, int]:
    """Share of blocks, and number of pages with every block, right when each labelled page is left out of training in turn.

    Tells what the features in ``using`` are worth; with the words and links of a block and its neighbours alone (no
    ``zone``) the share on ``LABELLED`` is far lower, which is why the tree is given the zone as well.
    """
    pages = labelled or LABELLED
    columns = [FEATURES.index(f) for f in using]
    data = []
    for page in pages:
        pieces = blocks(page)
        data.append((features(pieces)[:, columns], np.array([p.text.startswith("+") for p in pieces], bool)))
    right = total = whole = 0
    for k, (x, y) in enumerate(data):
        others = [d for j, d in enumerate(data) if j != k]
        tree = Tree(np.concatenate([d[0] for d in others]), np.concatenate([d[1] for d in others]))
        got = np.array([tree.says(row) for row in x], bool)
        right, total, whole = right + int((got == y).sum()), total + len(y), whole + bool((got == y).all())
    return right / max(1, total), whole

"""Main text of web pages from flat text blocks.

A page is cut into blocks at block-level tags. A block is described by its word count and link
density and by those of its neighbours, by whether it is a heading, and by the page parts that it
stands in. A decision tree, grown here on the small labelled table of `html_labels`, says which
blocks are main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallymill.llm.common import without
from tallymill.llm.html_labels import PAGES

RAW = "script|style|title|textarea"  # these run to the end of the page if nothing ends them
SKIPPED = set("noscript template select option button iframe svg object".split())
# a quote opens a value only after =
_ATTRS = r"(?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*+)?)*+"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<skip>{RAW})(?=[\s/>]){_ATTRS}>.*?(?:</(?P=skip)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>{_ATTRS})(?:>|\Z)|</?[a-zA-Z!?][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in SKIPPED}
_NESTED = {tag: re.compile(rf"<(/?){tag}(?=[\s/>])({_ATTRS})>", re.I) for tag in SKIPPED}
_ENDS["option"] = re.compile(r"</option(?=[\s/>])[^>]*>|(?=</?(?:option|optgroup|select|datalist)[\s/>])", re.I)  # its end tag may be left out
_EMPTY = re.compile(r"(?<!=)(?:^|[\s\"'])/\s*\Z|(?:^|\s)[^\s=\"']+/\s*\Z")
_HIDDEN = re.compile(r"(?:^|[\s\"'])hidden(?=[\s=/]|\Z)", re.I)
_ATTR = re.compile(r"(?<![\w-])(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SIDE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset"}
MAIN_TAGS = {"article", "main"}
# Names of parts that hold other people's text or other pages', whatever stands in them.
OTHER_NAMES = set("comment comments reply replies respond disqus discussion related recommended navigation nav navbar breadcrumb breadcrumbs".split())
SIDE_NAMES = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "notices notification alert sidebar menu menus footer share sharing social newsletter subscribe subscription signup login popup modal "
    "overlay widget search legal copyright disclaimer pagination pager toolbar masthead topbar skip toc byline feedback".split()
)
# First and last words of names that say how a page is laid out, not what an element is.
ABOUT_FIRST = set("has have with without no not is".split())
ABOUT_LAST = set("open opened closed free on off enabled disabled".split())
MAIN_NAMES = set("article articlebody content main story post entry maincontent".split())
# The elements on top of the stack that a start tag ends, whose end tags may be left out.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "tr": {"tr", "td", "th", "p"}}
CLOSES |= dict.fromkeys(["tbody", "thead", "tfoot"], {"tbody", "thead", "tfoot", "tr", "td", "th", "p"})


@dataclass
class Block:
    text: str = ""
    words: int = 0
    linked: int = 0
    side: int = 0  # 1: in a part that its name makes a side part, 2: by its tag or a name of others' text
    root: int = 0  # the outermost such part
    main: bool = False
    heading: bool = False
    parts: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class _Open:
    """An open element, and what it inherits to all in it."""

    tag: str = ""
    side: int = 0
    root: int = 0
    main: bool = False


def _names(attrs: str) -> list[list[str]]:
    """The names of an element, each as its words, without those that tell of the page's layout."""
    tokens = [t for _, value in _ATTR.findall(attrs) for t in value.strip("\"'").split()]
    words = [[w.lower() for w in _WORD.findall(t)] for t in tokens]
    return [w for w in words if w and not (len(w) > 1 and (w[0] in ABOUT_FIRST or w[-1] in ABOUT_LAST))]


def _place(tag: str, attrs: str, above: _Open, number: int) -> _Open:
    """An element in its place: a side part, the main part, or like the element that it stands in.

    The names of html and body tell of the whole page and do not count; neither do those of an
    article or main element, which ends a side part around it unless that holds others' text.
    """
    names = [] if not attrs or tag in ("html", "body") else _names(attrs)
    side, main = above.side, above.main or tag in MAIN_TAGS or any(w in MAIN_NAMES for n in names for w in n)
    if tag in MAIN_TAGS:
        side = side if side == 2 else 0
    elif any(w in SIDE_NAMES for n in names for w in n):
        side = max(side, 1)
    others = any(w in OTHER_NAMES for n in names for w in n)
    if others or tag in SIDE_TAGS or (tag == "header" and not main) or (attrs and _HIDDEN.search(attrs)):
        side = 2
    return _Open(tag, side, (above.root if above.side else number) if side else 0, main)


def _past(page: str, tag: str, attrs: str, at: int, endless: set[str]) -> int:
    """Where the element that is not read ends, with all of its kind inside; without an end only its tag is passed over.

    `endless` has the tags that nothing ends further on, so that a page is searched once for each.
    """
    if tag in endless or (tag == "svg" and _EMPTY.search(attrs)):
        return at
    if tag == "option":
        if m := _ENDS[tag].search(page, at):
            return m.end()
    else:
        depth, last = 1, None
        for m in _NESTED[tag].finditer(page, at):
            if m[1]:
                depth, last = depth - 1, m.end()
                if not depth:
                    return last
            elif not _EMPTY.search(m[2]):
                depth += 1
        if last is not None:  # more are opened than ended
            return last
    endless.add(tag)
    return at


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page in order, without script, style, comments and markup."""
    found: list[Block] = []
    stack: list[_Open] = [_Open()]
    opened: Counter[str] = Counter()  # open elements by tag
    now, links, heading = Block(), 0, False

    def close() -> None:
        nonlocal now
        text = " ".join(html.unescape("".join(now.parts)).split())
        if text:
            now.text, now.words = text, len(text.split())
            now.side, now.root, now.main = stack[-1].side, stack[-1].root, stack[-1].main
            now.heading = heading
            found.append(now)
        now = Block()

    page, at, endless = page or "", 0, set()
    while m := _TOKEN.match(page, at):
        at = m.end()
        if (text := m["text"]) is not None:
            now.parts.append(text)
            if links:
                now.linked += len(html.unescape(text).split())
        elif m["tag"]:
            tag = m["tag"].lower()
            if tag in SKIPPED and not m["end"]:
                at = _past(page, tag, m["attrs"], at, endless)
                continue
            if tag == "a":
                links = max(0, links - 1) if m["end"] else links + (not m["attrs"].rstrip().endswith("/"))
            if tag in INLINE:
                if tag == "br":
                    now.parts.append(" ")
                continue
            close()
            links = 0 if tag != "a" else links
            if m["end"]:
                if tag in HEADINGS:
                    heading = False
                if opened[tag]:  # an end tag without a start is ignored
                    while stack[-1].tag != tag:
                        opened[stack.pop().tag] -= 1
                    opened[stack.pop().tag] -= 1
            elif tag not in VOID and tag != "head":  # what a head may hold is skipped or void; all else is of the body
                if tag in HEADINGS:
                    heading = True
                while stack[-1].tag in CLOSES.get(tag, ()):
                    opened[stack.pop().tag] -= 1
                if tag not in HEADINGS and not (tag == "p" and not m["attrs"]):
                    stack.append(_place(tag, m["attrs"], stack[-1], m.end()))
                    opened[tag] += 1
    close()
    return found


FEATURES = ["words", "density", "words_before", "density_before", "words_after", "density_after", "side", "side_share", "main", "heading", "ends_sentence"]


def features(found: list[Block]) -> np.ndarray:
    """One row of `FEATURES` per block; a missing neighbour has no words and no links.

    `side_share` is the part of the page's words that stands in the same side part: what is called a
    side part and holds almost all of them is named after its layout.
    """
    n = len(found)
    words = np.array([0, *[b.words for b in found], 0], float)
    density = np.array([0, *[min(1.0, b.linked / b.words) for b in found], 0], float)
    inside: Counter[int] = Counter()
    for b in found:
        inside[b.root] += b.words
    total = max(1, sum(inside.values()))
    own = np.array([[b.side, inside[b.root] / total if b.side else 0, b.main, b.heading, b.text[-1] in ".!?…:;\"”»"] for b in found], float).reshape(n, 5)
    around = [words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:]]
    return np.column_stack([*around, own]) if n else np.zeros((0, len(FEATURES)))


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 2) -> tuple | float:
    """A decision tree by Gini impurity: (feature, threshold, at or below, above), or the share of ones."""
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return float(y.mean())
    best = (1e9, 0, 0.0)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        cut = np.flatnonzero(v[1:] > v[:-1]) + 1
        cut = cut[(cut >= least) & (cut <= len(y) - least)]
        if len(cut):
            p, q = ones[cut - 1] / cut, (ones[-1] - ones[cut - 1]) / (len(y) - cut)
            impure = cut * p * (1 - p) + (len(y) - cut) * q * (1 - q)
            k = int(np.argmin(impure))
            best = min(best, (float(impure[k]), f, float(v[cut[k] - 1] + v[cut[k]]) / 2))
    impure, f, at = best
    if impure >= len(y) * y.mean() * (1 - y.mean()) - 1e-12:
        return float(y.mean())
    low = x[:, f] <= at
    return f, at, grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)


def classify(tree: tuple | float, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree >= 0.5)
    f, at, low, high = tree
    return np.where(x[:, f] <= at, classify(low, x), classify(high, x))


def train() -> tuple | float:
    """The tree of the labelled table: blocks of its pages, each marked as main text or not."""
    xs, ys = [], []
    for page, marks in PAGES:
        found = blocks(page)
        if len(found) != len(marks):
            raise ValueError(f"{len(found)} blocks and {len(marks)} marks: {page[:60]}")
        xs.append(features(found))
        ys += [mark == "+" for mark in marks]
    return grow(np.concatenate(xs), np.array(ys, float))


def main_text(page: str | None, tree: tuple | float) -> str:
    """The blocks of main text, one per line; empty for null."""
    found = blocks(page)
    return "\n".join(b.text for b, keep in zip(found, classify(tree, features(found)), strict=True) if keep)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """`pages` with `text`, the main text of the whole page (empty for null or where there is none).

    Input columns named `text` are replaced.
    """
    pages = without(pages, ["text"])
    tree = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                made = pa.array([main_text(x.as_py(), tree) for x in batch.column(html_col)], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, "text"])

    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField("text", T.StringType())]))

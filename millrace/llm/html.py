"""Main-text extraction by minimum-cut labelling of a page's text blocks.

A page is read once into blocks of text and the tree of their elements. Every block is a node. A classifier's costs
become its capacities to the two terminals: how much its text looks like content (length, punctuation,
place in the page, kind of element, text density, share of links), and whether its nearest marked element is an article
or boilerplate. Smoothness edges join neighbours in page order, stronger the closer they are in the element tree, and next
siblings of one parent. The maximum flow separates content from boilerplate at the least total cost: runs of
blocks that look alike stay together, and a short line between paragraphs follows them.

The weights of the text features are fitted, not set: ``fit`` takes the blocks inside article or main elements as content and
those inside navigation, footers, asides, forms and the like as boilerplate, and sums features and their products by class, which
gives a linear discriminant. It reads at most about ``sample`` pages, chosen by a hash. Marked elements
are never features of the fit, so the weights hold for pages without them.

Names of classes and ids are strong evidence only where all of their parts name boilerplate (or an article); a name
that merely contains such a word (share-price, related-work) is a weak hint, and ids of headings are none.

Each page is one row's work, without a shuffle; time is near linear in the page, memory in proportion to it.

Defined results: a null or empty page, or one without content blocks, has an empty text; broken markup (unclosed or
stray tags, cut-off comments and scripts) is read as far as it goes; repeated rows are extracted one by one; a table without marked
pages is labelled with the weights of ``CutRule``; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.textnum import small

#: Features of a block's text, in the order of weights.
FEATURES = ("constant", "log_length", "punctuation", "sentence_end", "outward", "paragraph", "heading", "item", "density", "links")


@dataclass(frozen=True)
class CutRule:
    """weights: of FEATURES, where a table has no marked pages to fit them on. most: bound of the text's evidence, more_links:
    what links may add to it. main and boilerplate: evidence of the nearest marked element, hint: of a name. near and siblings:
    smoothness, of the order of the evidence. frame: an element with more than this share of the text marks nothing. shrink: pull of the fit towards weights."""

    weights: tuple[float, ...] = (-3.0, 0.5, 3.0, 0.8, -0.5, 0.5, 0.3, -0.3, 0.2, -3.0)
    most: float = 2.0
    more_links: float = 1.2
    main: float = 2.2
    boilerplate: float = 6.0
    hint: float = 0.4
    near: float = 1.5
    siblings: float = 0.8
    frame: float = 0.6
    shrink: float = 0.3
    sample: int = 5000


#: Elements whose text is never part of a page's text.
SILENT = "script style noscript template iframe object svg canvas select textarea title audio video map".split()
#: Elements that start and end blocks.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CELLS = frozenset("li dt dd td th tr".split())
MAIN = frozenset(("article", "main"))
BOILERPLATE = frozenset(("nav", "footer", "aside", "form", "menu", "dialog", "fieldset", "search"))
#: Words of class and id names.
NAMED_MAIN = frozenset("article content main post entry story articlebody maincontent".split())
NAMED_BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored banner promo promos promotion promotions nav navbar navigation menu menus menubar sidebar sidebars aside footer masthead topbar cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay newsletter newsletters subscribe subscription signup login share sharing social related recommended recommendations breadcrumb breadcrumbs widget widgets comment comments commentlist respond reply replies disqus toolbar pagination pager copyright disclaimer skip hidden".split()
)
#: A header of an article is part of it, any other is not.
NAMED_HEADER = frozenset("header head".split())
#: Words that say nothing beside the others.
NEUTRAL = frozenset("site page web top bottom left right inner outer wrap wrapper container box block list item items bar area section region panel slot unit group row col column the my js main primary secondary global local form links link reader readers user users body text content wide full id no".split())
#: Roles of boilerplate elements.
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())

_ATTRIBUTES = r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<svg(?=[\s/>])[^>]*/>|<(" + "|".join(SILENT) + r")(?=[\s/>])" + _ATTRIBUTES + r"(?:>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)(?:(" + _ATTRIBUTES + r")(?:>|\Z)|([^>]*)(?:>|\Z))|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_PUNCTUATION = re.compile(r"[.,;:!?\u3001\u3002\uff0c]")


def _named(value: str) -> tuple[int, int]:
    """(strong, weak) evidence of a class or id attribute: 1 for an article, -1 for boilerplate, 2 for a header."""
    strong = weak = 0
    for name in value.split():
        parts = {p.lower() for p in _PARTS.findall(name)}
        bad, good, header, rest = parts & NAMED_BOILERPLATE, parts & NAMED_MAIN, parts & NAMED_HEADER, parts - NAMED_BOILERPLATE - NAMED_HEADER
        if bad and rest <= NEUTRAL:
            strong = -1
        elif header and rest <= NEUTRAL and not strong:
            strong = 2
        elif good and parts <= NAMED_MAIN | NEUTRAL and not strong:
            strong = 1
        elif bad:
            weak = -1
        elif good and not weak:
            weak = 1
    return strong, weak


class Element:
    """mark: 1 for an article, -1 for boilerplate, 2 for a header; state: the nearest mark that counts."""

    __slots__ = ("tag", "parent", "depth", "mark", "weak", "chars", "main_chars", "parts", "state", "hints")

    def __init__(self, tag: str, parent: Element | None, attributes: str):
        self.tag, self.parent, self.depth = tag, parent, parent.depth + 1 if parent else 0
        self.mark = 1 if tag in MAIN else -1 if tag in BOILERPLATE else 2 if tag == "header" else 0
        self.weak = self.chars = self.main_chars = self.parts = self.state = self.hints = 0
        if attributes and tag not in ("html", "body"):
            for name, *values in _NAMES.findall(attributes):
                name, value = name.lower(), "".join(values)
                if name in ("class", "id"):
                    # A heading's id is made of its text, and an article stays one whatever it is called.
                    if tag not in HEADINGS:
                        strong, weak = _named(value)
                        self.weak += weak
                        if strong and tag not in MAIN and self.mark != -1:
                            self.mark = strong
                elif name == "role":
                    self.mark = 1 if value.lower() in ("main", "article") else -1 if value.lower() in ROLES else self.mark
                elif name == "itemprop":
                    self.mark = 1 if value.lower() == "articlebody" else self.mark
                elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
                    self.mark = -1


class Block:
    __slots__ = ("text", "at", "linked")

    def __init__(self, text: str, at: Element, linked: int):
        self.text, self.at, self.linked = text, at, linked


def blocks_of(page: str, rule: CutRule = CutRule()) -> list[Block]:
    """Text blocks in page order with the states of their elements; white space is one space, character references are decoded."""
    root = Element("#", None, "")
    elements, open_ = [root], Counter()
    top, out, parts, linked, links, head = root, [], [], 0, 0, False

    def flush():
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, top, min(linked, len(text))))
            parts, linked = [], 0

    def pop(to: Element):
        nonlocal top
        while top is not to:
            open_[top.tag] -= 1
            top = top.parent

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at and not head:
            piece = page[at : m.start()]
            parts.append(piece)
            if links:
                linked += len(piece)
        at = m.end()
        tag = m[3]
        if not tag:
            continue
        tag = tag.lower()
        closing = bool(m[2])
        if tag == "a":
            links = 0 if closing else 1
        elif tag == "br":
            parts.append(" ")
        elif tag == "head":
            head = not closing
        elif tag in BLOCKS:
            head = False
            flush()
            if closing:
                if open_[tag]:
                    e = top
                    while e.tag != tag:
                        e = e.parent
                    pop(e.parent)
                    links = 0
            elif tag not in VOID:
                if tag in CELLS or top.tag == "p":
                    e = top
                    # An item ends the open item of its list, any block ends an open paragraph.
                    while e.parent and (e.tag == "p" or e.tag in CELLS and tag in CELLS and (tag == e.tag or tag == "tr" or {tag, e.tag} in ({"dt", "dd"}, {"td", "th"}))):
                        e = e.parent
                    pop(e)
                top = Element(tag, top, m[4] or m[5])
                open_[tag] += 1
                elements.append(top)
    if at < len(page) and not head:
        parts.append(page[at:])
    flush()
    for b in out:
        b.at.chars += len(b.text)
        b.at.parts += 1
    # Children come after their parents: sums go up in reverse order, states go down.
    for e in reversed(elements):
        if e.mark == 1:
            e.main_chars = e.chars
        if e.parent:
            e.parent.chars += e.chars
            e.parent.main_chars += e.main_chars
            e.parent.parts += e.parts
    total, main = root.chars, root.main_chars
    for e in elements[1:]:
        p = e.parent
        e.state, e.hints = p.state, p.hints + e.weak
        # Boilerplate that holds most of the article, or of a page without one, is a frame around it.
        frame = e.main_chars > rule.frame * main if main else e.chars > rule.frame * total and e.tag not in BOILERPLATE
        if e.mark == -1 and not frame or e.mark == 2 and p.state != 1 and not frame:
            e.state = -1
        elif e.mark == 1 and p.state != -1:
            e.state = 1
    return out


def features(blocks: list[Block]) -> np.ndarray:
    """One row of FEATURES for each block; none of them knows of marked elements."""
    out = np.zeros((len(blocks), len(FEATURES)))
    total, seen = max(1, sum(len(b.text) for b in blocks)), 0
    for row, b in zip(out, blocks):
        n, words = len(b.text), b.text.count(" ") + 1
        tag, parent = b.at.tag, b.at.parent or b.at
        middle = (seen + n / 2) / total
        seen += n
        row[:] = (
            1.0, min(6.0, math.log1p(n)), min(0.5, len(_PUNCTUATION.findall(b.text)) / words), b.text[-1] in ".!?\u2026\u3002\"\u201d", abs(2 * middle - 1),
            tag in ("p", "pre", "blockquote"), tag in HEADINGS, tag in CELLS, min(6.0, math.log1p(parent.chars / max(1, parent.parts))), b.linked / n,
        )
    return out


def evidence(blocks: list[Block], weights: np.ndarray, rule: CutRule) -> list[float]:
    """The classifier's cost of calling each block boilerplate (positive) or content (negative)."""
    x = features(blocks)
    text = np.clip(x[:, :-1] @ weights[:-1], -rule.most, rule.most) + np.clip(x[:, -1] * weights[-1], -rule.more_links, 0.0)
    marked = np.array([rule.main if b.at.state == 1 else -rule.boilerplate if b.at.state == -1 else 0.0 for b in blocks])
    hints = np.array([max(-1, min(1, b.at.hints)) * rule.hint for b in blocks])
    return (text + marked + np.where(marked == 0, hints, 0.0)).tolist()


def edges_of(blocks: list[Block], rule: CutRule) -> list[tuple[int, int, float]]:
    """Adjacency weakens with the way through the element tree; blocks of different states are hardly neighbours."""
    out, last = [], {}
    for i, b in enumerate(blocks):
        parent = b.at.parent or b.at
        if i:
            x, y, steps = blocks[i - 1].at, b.at, 0
            while x is not y and steps < 8:
                if x.depth >= y.depth:
                    x = x.parent or x
                else:
                    y = y.parent or y
                steps += 1
            apart = 1 if blocks[i - 1].at.state == b.at.state else 8
            out.append((i - 1, i, rule.near / (1 + max(0, steps - 2) / 2) / apart))
        j = last.get(id(parent), -1)
        if 0 <= j < i - 1 and blocks[j].at.state == b.at.state:
            out.append((j, i, rule.siblings))
        last[id(parent)] = i
    return out


def min_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The source side of the minimum cut. A node's score is its capacity from the source (positive) or to the sink (negative)."""
    n = len(scores)
    if not any(s < 0 for s in scores):
        return [True] * n
    left = list(scores)
    out: list[list[int]] = [[] for _ in range(n)]
    to, room = [], []
    for a, b, c in edges:
        out[a].append(len(to))
        to.append(b)
        room.append(c)
        out[b].append(len(to))
        to.append(a)
        room.append(c)
    tiny = 1e-9
    while True:
        # Levels from all nodes that still have supply.
        level = [0 if s > tiny else -1 for s in left]
        queue = deque(i for i in range(n) if level[i] == 0)
        open_ = False
        while queue:
            v = queue.popleft()
            for e in out[v]:
                w = to[e]
                if room[e] > tiny and level[w] < 0:
                    level[w] = level[v] + 1
                    open_ = open_ or left[w] < -tiny
                    queue.append(w)
        if not open_:
            return [x >= 0 for x in level]
        next_ = [0] * n
        for start in range(n):
            while left[start] > tiny and level[start] == 0:
                path, v = [], start
                while left[v] >= -tiny or not path:
                    moved = False
                    while next_[v] < len(out[v]):
                        e = out[v][next_[v]]
                        if room[e] > tiny and level[to[e]] == level[v] + 1:
                            path.append(e)
                            v = to[e]
                            moved = True
                            break
                        next_[v] += 1
                    if moved:
                        continue
                    if not path:
                        break
                    e = path.pop()
                    v = to[e ^ 1]
                    next_[v] += 1
                if not path:
                    break
                flow = min(left[start], -left[v], min(room[e] for e in path))
                left[start] -= flow
                left[v] += flow
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow


def labelled(page: str | None, weights: np.ndarray, rule: CutRule = CutRule()) -> tuple[list[Block], list[float], list[bool]]:
    """A page's blocks, their costs, and which of them the cut keeps."""
    blocks = blocks_of(page or "", rule)
    if not blocks:
        return [], [], []
    costs = evidence(blocks, weights, rule)
    return blocks, costs, min_cut(costs, edges_of(blocks, rule))


def main_text(page: str | None, rule: CutRule = CutRule(), weights: np.ndarray | None = None) -> str:
    blocks, _, keep = labelled(page, np.array(rule.weights) if weights is None else weights, rule)
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def discriminant(sums: np.ndarray, rule: CutRule = CutRule()) -> np.ndarray:
    """Weights from each class's count, feature sums and product sums (2 x (1 + n + n * n)): log-odds of content under equal priors,
    with one common covariance, drawn towards the rule's weights so that tables whose pages are all alike don't rest on one feature."""
    n = len(FEATURES) - 1
    if min(sums[0, 0], sums[1, 0]) < 2:
        return np.array(rule.weights)
    count = sums[:, 0]
    mean = sums[:, 2 : 2 + n] / count[:, None]
    second = sums[:, 2 + n :].reshape(2, n + 1, n + 1)[:, 1:, 1:]
    spread = (second[0] + second[1] - sum(c * np.outer(m, m) for c, m in zip(count, mean))) / count.sum()
    w = np.linalg.solve(spread + rule.shrink * np.eye(n), mean[1] - mean[0] + rule.shrink * np.array(rule.weights[1:]))
    return np.concatenate(([-w @ (mean[0] + mean[1]) / 2], w))


def fit(pages: DataFrame, rule: CutRule = CutRule()) -> np.ndarray:
    """Weights of FEATURES from the marked blocks of about ``sample`` pages at most (all of a smaller table)."""
    n = len(FEATURES)
    p = pages.select(F.col("html").cast("string").alias("html"))
    total, parts = p.count(), 1 << 20
    if total > rule.sample:
        p = p.where(F.pmod(F.xxhash64("html", F.lit(23)), F.lit(parts)) < int(parts * rule.sample / total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + n + n * n))
        for batch in small(batches):
            for page in batch.column(0).to_pylist():
                blocks = blocks_of(page or "", rule)
                state = np.array([b.at.state for b in blocks])
                x = features(blocks)
                for k, s in enumerate((-1, 1)):
                    y = x[state == s]
                    sums[k] += np.concatenate(([len(y)], y.sum(axis=0), (y.T @ y).ravel()))
        # Whole numbers of a small unit add up alike in any order.
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.round(sums.ravel()[at] * 2**20).astype(np.int64))], ["i", "v"])

    rows = p.mapInArrow(run, "i int, v long").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    sums = np.zeros(2 * (1 + n + n * n))
    sums[rows["i"].to_numpy()] = rows["v"].to_numpy() / 2**20
    return discriminant(sums.reshape(2, -1), rule)


def extract(pages: DataFrame, rule: CutRule = CutRule(), weights: np.ndarray | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row, labelled with the given weights or those that ``fit`` finds on the pages."""
    weights = fit(pages, rule) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = [main_text(x, rule, weights) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return p.mapInArrow(run, "page_id long, url string, text string, n_chars long")

"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page becomes a tree of block elements. Boosted trees score each node from its
text and link density, its subtree, its place, its attribute tokens and its
siblings. A decoder then chooses the set of nodes of highest total score in
which every chosen node has a chosen parent, so a menu inside an article can go
while the article stays, but nothing stays inside what goes.

The trees learn from pages whose own markup names the article; if no page of the
table does, from attribute names, prose and link density.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Pages that the trees are fitted on: a sample by hash of about this size.
TRAIN_PAGES = 600
TREES, DEPTH, RATE, BINS = 30, 3, 0.3, 32

# Fixed values of HTML and of usual markup.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style noscript template textarea title iframe svg select button xmp noembed noframes".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var".split()
)
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr main menu nav ol p pre section table ul".split()
)
SELF_CLOSING = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "body": {"head"},
}
NOT_TEXT = set("head form fieldset".split())
BOILER_TAGS = set("nav aside footer header form menu dialog".split())
MAIN_TAGS = set("article main".split())
BOILER_WORDS = set(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies"
    " consent dialog disqus footer form header masthead menu modal nav navbar navigation newsletter notice"
    " pagination popup privacy promo promotion related reply replies respond search share sharing shares"
    " sidebar signup social sponsor sponsored subscribe tags toolbar topbar widget".split()
)
MAIN_WORDS = set("article articlebody content entry main post story".split())
# Where no page names its article: a block of so many characters with few links is prose.
PROSE, LINKED = 80, 0.3
# What may hold a name of an article; the tree tells whether it does.
_NAMED = r"(?i)<(article|main)[\s/>]"

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)", re.DOTALL
)
# Lower case is longer than its text for some letters, so the end is looked for in the text itself.
_RAW_END = {tag: re.compile(f"</{tag}", re.IGNORECASE | re.ASCII) for tag in RAW}
_ATTRIBUTE = re.compile(r"(?:class|id|role|itemprop|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.IGNORECASE)
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_PUNCTUATION = re.compile(r"[.,;:!?]")

FEATURES = [
    "depth", "text", "own_text", "links", "density", "nodes", "children", "place", "siblings", "same_tag",
    "punctuation", "mean_run", "boiler", "boiler_above", "main", "main_above", "heading", "paragraph", "list_item",
    "sibling_text", "start",
]
_MAIN_FEATURES = [FEATURES.index("main"), FEATURES.index("main_above")]


class Page:
    """Block elements of a page as parallel lists, and its runs of text in page order."""

    def __init__(self, source: str):
        self.tags, self.parents, self.words = ["#page"], [-1], [set()]
        self.runs: list[tuple[int, list[str], int]] = []  # node, pieces, link characters
        self._parse(source)

    def _parse(self, source: str) -> None:
        stack, links, at, end = [0], 0, 0, len(source)
        pieces: list[str] = []
        linked = 0

        def flush():
            nonlocal pieces, linked
            if pieces:
                self.runs.append((stack[-1], pieces, linked))
            pieces, linked = [], 0

        def text(part: str):
            nonlocal linked
            if part:
                pieces.append(part)
                if links:
                    linked += len(part)

        while at < end:
            found = _TOKEN.search(source, at)
            if found is None:
                tail = source[at:]
                text(tail)
                break
            text(source[at : found.start()])
            at = found.end()
            tag = found[2]
            if tag is None:
                continue
            tag = tag.lower()
            if not found[1] and tag in RAW:
                close = _RAW_END[tag].search(source, at)
                close = source.find(">", close.start()) if close else -1
                at = end if close < 0 else close + 1
                continue
            if tag in INLINE:
                if tag == "a":
                    links = max(0, links - 1) if found[1] else links + 1
                continue
            if tag in ("br", "wbr"):
                if tag == "br":
                    pieces.append(" ")
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                continue
            flush()
            links = 0
            if found[1]:
                if any(self.tags[n] == tag for n in stack[1:]):
                    while self.tags[stack[-1]] != tag:
                        stack.pop()
                    stack.pop()
                continue
            if tag in CLOSES_P and self.tags[stack[-1]] == "p":
                stack.pop()
            closing = SELF_CLOSING.get(tag)
            if closing:
                while self.tags[stack[-1]] in closing:
                    stack.pop()
            self.tags.append(tag)
            self.parents.append(stack[-1])
            names: set[str] = set()
            for value in _ATTRIBUTE.findall(found[3]):
                names.update(_NAME.findall(value.lower()))
            self.words.append(names)
            stack.append(len(self.tags) - 1)
        flush()

    def block(self, run: int) -> str:
        return _SPACE.sub(" ", html.unescape("".join(self.runs[run][1]))).strip()


def features(page: Page, blocks: list[str]) -> np.ndarray:
    """One row per node."""
    n = len(page.tags)
    parents = page.parents
    depth, own, link, marks, runs = (np.zeros(n) for _ in range(5))
    start = np.full(n, np.inf)
    total = 0
    for (node, pieces, linked), block in zip(page.runs, blocks):
        if block:
            own[node] += len(block)
            link[node] += min(linked, len(block))
            marks[node] += len(_PUNCTUATION.findall(block))
            runs[node] += 1
            start[node] = min(start[node], total)
            total += len(block)
    boiler = np.array([t in BOILER_TAGS or bool(w & BOILER_WORDS) for t, w in zip(page.tags, page.words)], float)
    main = np.array([t in MAIN_TAGS or bool(w & MAIN_WORDS) for t, w in zip(page.tags, page.words)], float)
    boiler_above, main_above = boiler.copy(), main.copy()
    children, place = np.zeros(n), np.zeros(n)
    kinds: dict[tuple[int, str], int] = {}
    for i in range(1, n):
        p = parents[i]
        depth[i] = depth[p] + 1
        boiler_above[i] += boiler_above[p]
        main_above[i] += main_above[p]
        place[i] = children[p]
        children[p] += 1
        kinds[p, page.tags[i]] = kinds.get((p, page.tags[i]), 0) + 1
    size = np.ones(n)
    text, links, points, pieces_below = own.copy(), link.copy(), marks.copy(), runs.copy()
    for i in range(n - 1, 0, -1):
        p = parents[i]
        for values in (size, text, links, points, pieces_below):
            values[p] += values[i]
        start[p] = min(start[p], start[i])
    up = np.array([max(p, 0) for p in parents])
    tags = page.tags
    return np.column_stack(
        [
            depth,
            np.log1p(text),
            np.log1p(own),
            links / np.maximum(text, 1),
            text / size,
            np.log1p(size),
            children,
            place,
            children[up],
            [kinds.get((parents[i], tags[i]), 1) for i in range(n)],
            points / np.maximum(text, 1),
            text / np.maximum(pieces_below, 1),
            boiler,
            boiler_above,
            main,
            main_above,
            [t in ("h1", "h2", "h3", "h4", "h5", "h6") for t in tags],
            [t in ("p", "pre", "blockquote") for t in tags],
            [t in ("li", "td", "th", "dt", "dd", "option") for t in tags],
            text / np.maximum(text[up], 1),
            np.where(np.isinf(start), 1.0, start / max(total, 1)),
        ]
    ).astype(float)


def labels(page: Page) -> np.ndarray | None:
    """Whether each node belongs to the article that the markup names; None if it names none."""
    n = len(page.tags)
    inside, excluded = np.zeros(n, bool), np.zeros(n, bool)
    named = np.array([t in MAIN_TAGS for t in page.tags])
    if not named.any():
        return None
    for i in range(1, n):
        p = page.parents[i]
        inside[i] = inside[p] or named[i]
        excluded[i] = excluded[p] or (
            not named[i] and (page.tags[i] in BOILER_TAGS or bool(page.words[i] & BOILER_WORDS))
        )
    # What holds an article is part of the way to it.
    wanted = inside & ~excluded
    for i in range(n - 1, 0, -1):
        if wanted[i]:
            wanted[page.parents[i]] = True
    return wanted


def weak_labels(page: Page, blocks: list[str]) -> np.ndarray | None:
    """Labels of a page that names no article; None if nothing in it looks like one.

    What attributes call the main text, or else prose and the headings beside it.
    """
    n = len(page.tags)
    own, link = np.zeros(n), np.zeros(n)
    for (node, _, linked), block in zip(page.runs, blocks):
        own[node] += len(block)
        link[node] += min(linked, len(block))
    few = link <= LINKED * own
    named = np.array([bool(w & MAIN_WORDS) and t != "body" for t, w in zip(page.tags, page.words)])
    inside, excluded = named.copy(), np.zeros(n, bool)
    for i in range(1, n):
        p = page.parents[i]
        inside[i] |= inside[p]
        excluded[i] = excluded[p] or (
            not named[i]
            and (page.tags[i] in BOILER_TAGS or page.tags[i] in NOT_TEXT or bool(page.words[i] & BOILER_WORDS))
        )
    wanted = inside & ~excluded & (few | (own == 0))
    if not (own[wanted] >= PROSE).any():
        wanted = (own >= PROSE) & few & ~excluded
        beside = {page.parents[i] for i in np.flatnonzero(wanted)}
        for i in range(1, n):
            if page.tags[i] in ("h1", "h2", "h3", "h4", "h5", "h6") and page.parents[i] in beside:
                wanted[i] |= few[i] and not excluded[i]
    if not wanted.any():
        return None
    for i in range(n - 1, 0, -1):
        if wanted[i]:
            wanted[page.parents[i]] = True
    return wanted


class Boosted:
    """Boosted regression trees for two classes, on binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
        binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T)])
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.base)
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree, leaf = self._grow(binned, y - p, np.maximum(p * (1 - p), 1e-6))
            self.trees.append(tree)
            score += tree[2][leaf]

    def _grow(self, binned, gradient, hessian):
        """A whole binary tree of ``DEPTH`` splits; a node that gains nothing sends all left."""
        inner = (1 << DEPTH) - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(binned), np.int64)
        for i in range(inner):
            own = node == i
            if own.any():
                best = 1e-6
                g, h = gradient[own], hessian[own]
                whole = g.sum() ** 2 / (h.sum() + 1)
                for f in range(binned.shape[1]):
                    bins = len(self.edges[f]) + 1
                    sums = np.cumsum(np.bincount(binned[own, f], g, bins))[:-1]
                    weights = np.cumsum(np.bincount(binned[own, f], h, bins))[:-1]
                    if not len(sums):
                        continue
                    gain = sums**2 / (weights + 1) + (g.sum() - sums) ** 2 / (h.sum() - weights + 1) - whole
                    at = int(gain.argmax())
                    if gain[at] > best:
                        best, feature[i], cut[i] = gain[at], f, self.edges[f][at]
            if np.isinf(cut[i]):
                node[own] = 2 * i + 1
            else:
                right = binned[own, feature[i]] > np.searchsorted(self.edges[feature[i]], cut[i], "left")
                node[own] = 2 * i + 1 + right
        leaf = node - inner
        sums = np.bincount(leaf, gradient, inner + 1)
        weights = np.bincount(leaf, hessian, inner + 1)
        return (feature, cut, RATE * sums / (weights + 1)), leaf

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, values in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += values[node - len(feature)]
        return out


def decode(page: Page, scores: np.ndarray) -> np.ndarray:
    """The nodes chosen: of highest total score, each with a chosen parent."""
    n = len(page.tags)
    gain = scores.copy()
    for i in range(n - 1, 0, -1):
        if page.tags[i] in NOT_TEXT:
            gain[i] = -np.inf
        elif gain[i] > 0:
            gain[page.parents[i]] += gain[i]
    chosen = np.zeros(n, bool)
    chosen[0] = True
    for i in range(1, n):
        chosen[i] = chosen[page.parents[i]] and gain[i] > 0
    return chosen


def _weights(blocks: list[str], page: Page) -> np.ndarray:
    """A node counts by its own text, and a little if it has none."""
    own = np.zeros(len(page.tags))
    for (node, _, _), block in zip(page.runs, blocks):
        own[node] += len(block)
    return 0.1 + np.log1p(own)


def extract(source: str | None, model: Boosted | None) -> str:
    page = Page(source or "")
    blocks = [page.block(i) for i in range(len(page.runs))]
    if model is None or not any(blocks):
        return ""
    scores = model.score(features(page, blocks)) * _weights(blocks, page)
    chosen = decode(page, scores)
    return "\n".join(b for (node, _, _), b in zip(page.runs, blocks) if b and chosen[node])


def _sampled(rows: DataFrame, sample: int) -> list[str]:
    """About ``sample`` pages, chosen by hash."""
    total = rows.count()
    if not total:
        return []
    share = min(1.0, sample / total)
    chosen = rows.where(F.pmod(F.xxhash64("html"), F.lit(1_000_000)) < math.ceil(share * 1_000_000)).collect()
    return sorted(source for (source,) in chosen)


def _lessons(sources: list[str], label) -> tuple[list[np.ndarray], list[np.ndarray]]:
    x, y = [], []
    for source in sources:
        page = Page(source)
        blocks = [page.block(i) for i in range(len(page.runs))]
        wanted = label(page, blocks)
        if wanted is not None:
            x.append(features(page, blocks))
            y.append(wanted)
    return x, y


def _naming(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pages whose tree has an article."""
    for batch in batches:
        named = [not MAIN_TAGS.isdisjoint(Page(x).tags) for x in batch.column("html").to_pylist()]
        yield batch.filter(pa.array(named, pa.bool_()))


def _prosaic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pages that weak labels find a main text in."""
    for batch in batches:
        trees = [Page(x) for x in batch.column("html").to_pylist()]
        found = [weak_labels(t, [t.block(i) for i in range(len(t.runs))]) is not None for t in trees]
        yield batch.filter(pa.array(found, pa.bool_()))


def train(pages: DataFrame, sample: int = TRAIN_PAGES, column: str = "html") -> Boosted | None:
    """Fit the trees on about ``sample`` of the pages that name their article, chosen by hash.

    Each node teaches twice, once with the features that tell of an article's
    markup blanked, so that pages without such markup can be told too. If no page
    of the table names its article, they are fitted on weak labels. None if no
    page has any text that looks like one.
    """
    rows = pages.select(F.col(column).alias("html")).where("html IS NOT NULL")
    marked = rows.where(F.col("html").rlike(_NAMED))

    def named(page: Page, blocks: list[str]) -> np.ndarray | None:
        return labels(page)

    sources = _sampled(marked, sample)
    x, y = _lessons(sources, named)
    if sources and not x:
        # The marks of those stand in scripts and comments; others may have real ones.
        x, y = _lessons(_sampled(marked.mapInArrow(_naming, "html STRING"), sample), named)
    if not x:
        x, y = _lessons(_sampled(rows, sample), weak_labels)
    if not x:
        x, y = _lessons(_sampled(rows.mapInArrow(_prosaic, "html STRING"), sample), weak_labels)
    if not x:
        return None
    x_all, y_all = np.vstack(x), np.concatenate(y).astype(float)
    blank = x_all.copy()
    blank[:, _MAIN_FEATURES] = 0
    return Boosted(np.vstack([x_all, blank]), np.concatenate([y_all, y_all]))


def _extractor(model: Boosted | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x, model) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    return run


def extract_pages(pages: DataFrame, sample: int = TRAIN_PAGES) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Null and empty pages, and all pages if the trees could not be fitted, have an
    empty text. Repeated rows stay. Character references are decoded, white space
    within a block is one space, blocks are joined by newlines in page order.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    return rows.mapInArrow(
        _extractor(train(pages, sample)), "page_id BIGINT, url STRING, text STRING, n_chars BIGINT"
    )

"""Main text of web pages: boosted trees over DOM nodes, decoded as a tree.

A page is read into block-level nodes. Gradient-boosted trees give each node
the probability that its text belongs to the article, from its subtree's
density, links, punctuation and size, its depth, siblings and attribute
tokens, and those of its ancestors. A node is then called article, other or
mixed so that the whole page's log-likelihood is largest, where the nodes below
an article or an other node must be called the same: a choice for an ancestor
and one for its descendant cannot contradict each other.

The trees learn from a bounded sample of the given pages that mark their
article. Variants of these pages, with their marks renamed or taken away and
with common kinds of surroundings added, teach what the bare pages do not show.
"""

from __future__ import annotations

import html
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.llm.batches import map_slices, utf8

#: Pages that train the trees, at most: those of the least hashed text.
TRAINED = 300
TREES, DEPTH, BINS, RATE = 40, 4, 32, 0.3
MIXED = np.log(0.3)

INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt"
    " ruby s samp small span strike strong sub sup time tt u var wbr area input".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("head title script style template noscript iframe object svg canvas textarea".split())
RAW = set("script style title textarea noscript iframe template".split())
# a start tag of these ends an open element of the same group
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
SCOPES = {"ul", "ol", "dl", "table"}
TAGS = (
    "#text p div section article main header footer nav aside form ul ol li table td blockquote pre"
    " h1 h2 h3 h4 figure body"
).split()
AROUND = ("nav", "aside", "footer", "form", "header", "article", "main")
NEGATIVE = set(
    "ad ads advert advertisement banner nav menu navigation breadcrumb footer header sidebar aside"
    " widget cookie consent notice promo share social related recommended comment comments reply"
    " form login signup newsletter subscribe popup modal copyright tags meta toolbar sponsor".split()
)
POSITIVE = set("article content post entry main body story text page".split())
HASHED = 16

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_STOP = re.compile("[\"'>]")
_MARKED = r"(?i)<(article|main)[\s/>]"
_ATTRIBUTE = re.compile(r"(?:class|id|role|itemprop|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_PART = re.compile(r"[a-z]+")


class TagEnds:
    """Where tags end: the first ``>`` outside quotes.

    Quotes that led a search nowhere are remembered, so that all searches of a
    page together read it a bounded number of times.
    """

    def __init__(self, source: str):
        self.source = source
        self.last = source.rfind(">")
        self.dead: set[int] = set()

    def plain(self, at: int) -> int:
        return self.source.find(">", at) if at <= self.last else -1

    def after(self, at: int) -> int:
        """The end of a tag read up to ``at``; -1 without one."""
        met = []
        while at <= self.last:
            stop = _STOP.search(self.source, at).start()
            if stop in self.dead:
                break
            if self.source[stop] == ">":
                return stop
            met.append(stop)
            at = self.source.find(self.source[stop], stop + 1) + 1
            if not at:
                break
        self.dead.update(met)
        return -1


class Page:
    """Block nodes in page order: parent, tag, attribute tokens, text, link characters."""

    def __init__(self, source: str):
        self.parent: list[int] = []
        self.tag: list[str] = []
        self.tokens: list[list[str]] = []
        self.text: list[str] = []
        self.links: list[int] = []
        self._read(source)

    def _add(self, parent: int, tag: str, tokens: list[str], text: str, links: int) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.tokens.append(tokens)
        self.text.append(text)
        self.links.append(links)
        return len(self.tag) - 1

    def _read(self, source: str) -> None:
        open_ = [self._add(-1, "#page", [], "", 0)]
        unseen, anchors, run, links = 0, 0, [], 0

        def close_run() -> None:
            nonlocal run, links
            if run:
                text = " ".join("".join(run).split())
                if text:
                    self._add(open_[-1], "#text", [], text, links)
                run, links = [], 0

        def close_from(k: int) -> None:
            for node in open_[k:]:
                places[self.tag[node]].pop()
            del open_[k:]

        def last_of(tags) -> int:
            """Where in ``open_`` the innermost of these is; 0 if none is open."""
            return max((places[t][-1] for t in tags if places.get(t)), default=0)

        places: dict[str, list[int]] = {"#page": [0]}
        at, n, ends_of = 0, len(source), TagEnds(source)
        while at < n:
            start = source.find("<", at)
            text = source[at : start if start >= 0 else n]
            found = rest = None
            if start < 0:
                at = n
            elif source.startswith("<!--", start):
                at = source.find("-->", start + 4)
                at = n if at < 0 else at + 3
            elif found := _NAME.match(source, start):
                at = ends_of.after(found.end()) + 1
                rest = source[found.end() : at - 1]
            else:
                at = ends_of.plain(start + 2) + 1 if source[start + 1 : start + 2] in ("!", "?", "/") else 0
            if at == 0:  # no tag: the sign is text
                at, text, found = start + 1, text + "<", None
            if text and not unseen:
                text = html.unescape(text) if "&" in text else text
                run.append(text)
                links += len(text) * (anchors > 0)
            if not found:
                continue
            ends, name = source[start + 1] == "/", found.group(1).lower()
            if name in RAW and not ends:
                stop = re.compile(f"</{re.escape(name)}", re.I).search(source, at)
                at = source.find(">", stop.start()) + 1 if stop else 0
                at = at or n
                continue
            if name in UNSEEN:
                unseen = max(0, unseen + (-1 if ends else not rest.endswith("/")))
                if name == "head" and ends:
                    unseen = 0
                continue
            if name in INLINE or name in VOID:
                if name == "a":
                    anchors = max(0, anchors + (-1 if ends else 1))
                elif name in ("br", "img", "hr"):
                    run.append(" ")
                continue
            if name == "body":
                unseen = 0
            close_run()
            anchors = 0
            if ends:
                k = last_of((name,))
                if k:
                    close_from(k)
                continue
            stops = ENDS.get(name, ())
            k = last_of(("p", *stops))
            if k and not (stops and last_of(SCOPES) > k):
                close_from(k)
            tokens = []
            if "=" in rest:
                for value in _ATTRIBUTE.findall(rest):
                    tokens += _PART.findall(value.lower())
            places.setdefault(name, []).append(len(open_))
            open_.append(self._add(open_[-1], name, tokens, "", 0))
        close_run()


def node_features(page: Page) -> np.ndarray:
    """One row of numbers per node."""
    n = len(page.tag)
    parent, tag = page.parent, page.tag
    size = [len(t) for t in page.text]
    marks = [sum(map(t.count, ".,;:!?")) if t else 0 for t in page.text]
    before, total = [0] * n, 0
    for i in range(n):
        before[i] = total
        total += size[i]
    own, links, below = size[:], page.links[:], [1] * n
    paragraphs = [int(t == "p") for t in tag]
    items = [int(t == "li") for t in tag]
    children = [0] * n
    kinds: list[dict] = [{} for _ in range(n)]
    for i in range(n - 1, 0, -1):
        p = parent[i]
        size[p] += size[i]
        marks[p] += marks[i]
        links[p] += links[i]
        below[p] += below[i]
        paragraphs[p] += paragraphs[i]
        items[p] += items[i]
        children[p] += 1
        kinds[p][tag[i]] = kinds[p].get(tag[i], 0) + 1
    depth, place, seen = [0] * n, [0] * n, [0] * n
    around = [0] * n
    negative = [sum(t in NEGATIVE for t in ts) for ts in page.tokens]
    positive = [sum(t in POSITIVE for t in ts) for ts in page.tokens]
    above_negative, above_positive = [0] * n, [0] * n
    out = np.zeros((n, 20 + len(TAGS) + len(AROUND) + HASHED), np.float32)
    flags = {t: 1 << k for k, t in enumerate(AROUND)}
    for i in range(1, n):
        p = parent[i]
        depth[i] = depth[p] + 1
        place[i] = seen[p]
        seen[p] += 1
        around[i] = around[p] | flags.get(tag[p], 0)
        above_negative[i] = above_negative[p] + negative[p]
        above_positive[i] = above_positive[p] + positive[p]
    total = max(1, total)
    p = np.array(parent)
    length = np.array(size, np.float32)
    floor = np.maximum(length, 1)
    n_below = np.array(below, np.float32)
    siblings = np.array(children)[np.maximum(p, 0)]
    alike = [kinds[max(0, parent[i])].get(tag[i], 1) for i in range(n)]
    for k, column in enumerate(
        (
            depth, length, own, np.array(links) / floor, length / n_below, length / total, children,
            place, siblings, np.array(place) / np.maximum(siblings, 1), alike, paragraphs, items,
            np.array(marks) / floor, negative, positive, above_negative, above_positive,
            np.array(before) / total, length[np.maximum(p, 0)],
        )
    ):
        out[:, k] = column
    tags = {t: 20 + k for k, t in enumerate(TAGS)}
    bits = np.array(around)
    for k in range(len(AROUND)):
        out[:, 20 + len(TAGS) + k] = bits >> k & 1
    first = 20 + len(TAGS) + len(AROUND)
    for i in range(n):
        at = tags.get(tag[i])
        if at:
            out[i, at] = 1
        for token in page.tokens[i]:
            out[i, first + zlib.crc32(token.encode()) % HASHED] = 1
    return out


class Trees:
    """Boosted regression trees of fixed depth on binned features, logistic loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        ranks = np.linspace(0, 1, BINS + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(column, ranks)) for column in x.T]
        binned = self._binned(x)
        self.start = float(np.log((y.sum() + 1) / ((1 - y).sum() + 1)))
        self.feature = np.zeros((TREES, (1 << DEPTH) - 1), np.int64)
        self.bin = np.full((TREES, (1 << DEPTH) - 1), BINS)
        self.leaf = np.zeros((TREES, 1 << DEPTH))
        odds = np.full(len(y), self.start)
        for t in range(TREES):
            odds += RATE * self._grow(t, binned, y - 1 / (1 + np.exp(-odds)), odds)

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack(
            [np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, x.T)]
        ).astype(np.int64)

    def _grow(self, t: int, binned: np.ndarray, slope: np.ndarray, odds: np.ndarray) -> np.ndarray:
        p = 1 / (1 + np.exp(-odds))
        curve = np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(slope), np.int64)
        for level in range(DEPTH):
            width = 1 << level
            best = np.full(width, 1e-6)
            for f, bins in enumerate(binned):
                if not len(self.cuts[f]):
                    continue
                at = node * BINS + bins
                g = np.bincount(at, slope, width * BINS).reshape(width, BINS).cumsum(axis=1)
                h = np.bincount(at, curve, width * BINS).reshape(width, BINS).cumsum(axis=1)
                gt, ht = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + 1) + (gt - g) ** 2 / (ht - h + 1) - gt**2 / (ht + 1)
                cut = gain.argmax(axis=1)
                value = gain[np.arange(width), cut]
                better = value > best
                best[better] = value[better]
                heap = width - 1 + np.flatnonzero(better)
                self.feature[t, heap], self.bin[t, heap] = f, cut[better]
            heap = width - 1 + node
            right = binned[self.feature[t, heap], np.arange(len(node))] > self.bin[t, heap]
            node = 2 * node + right
        g, h = np.bincount(node, slope, 1 << DEPTH), np.bincount(node, curve, 1 << DEPTH)
        self.leaf[t] = g / (h + 1)
        return self.leaf[t][node]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x).ravel()
        n = len(x)
        rows = np.arange(n)
        out = np.full(n, self.start)
        for t in range(TREES):
            node = np.zeros(n, np.int64)
            for level in range(DEPTH):
                heap = (1 << level) - 1 + node
                node = 2 * node + (binned[self.feature[t][heap] * n + rows] > self.bin[t][heap])
            out += RATE * self.leaf[t][node]
        return out


def decode(parent: list[int], log_odds: np.ndarray) -> np.ndarray:
    """Which nodes are article, by the most likely consistent calls."""
    n = len(parent)
    yes = -np.logaddexp(0, -log_odds)
    no = -np.logaddexp(0, log_odds)
    yes[0] = no[0] = 0.0
    yes, no = yes.tolist(), no.tolist()
    free = [0.0] * n
    has = [False] * n
    best = [0.0] * n
    for i in range(n - 1, -1, -1):
        best[i] = max(yes[i], no[i], MIXED + free[i] if has[i] else -np.inf)
        if i:
            p = parent[i]
            yes[p] += yes[i]
            no[p] += no[i]
            free[p] += best[i]
            has[p] = True
    call = [0] * n  # 1 article, 0 other, 2 mixed
    for i in range(n):
        above = call[parent[i]] if i else 2
        if above != 2:
            call[i] = above
        elif has[i] and MIXED + free[i] >= max(yes[i], no[i]):
            call[i] = 2
        else:
            call[i] = int(yes[i] > no[i])
    return np.array(call) == 1


def marked_article(page: Page) -> np.ndarray | None:
    """Per node: 1 inside the page's marked article, 0 outside, -1 both; None without one."""
    n = len(page.tag)
    inside = [0] * n
    for i in range(1, n):
        state = inside[page.parent[i]]
        tag, tokens = page.tag[i], page.tokens[i]
        if state == 0 and tag in ("article", "main"):
            state = 1
        if tag in ("nav", "aside", "footer", "form") or any(t in NEGATIVE for t in tokens):
            state = 2
        inside[i] = state
    own = [int(s == 1) for s in inside]
    if not any(o and t for o, t in zip(own, page.text)):
        return None
    least, most = [2] * n, [-1] * n
    for i in range(n - 1, -1, -1):
        if page.text[i]:
            least[i], most[i] = min(least[i], own[i]), max(most[i], own[i])
        if i:
            p = page.parent[i]
            least[p], most[p] = min(least[p], least[i]), max(most[p], most[i])
    return np.array([a if a == b else -1 for a, b in zip(least, most)])


def variant(page: Page, kind: int, words: list[str]) -> Page:
    """The page with other marks (labels stay those of the tree) and surroundings."""
    rng = np.random.default_rng(kind * 7919 + len(page.tag))
    other = object.__new__(Page)
    other.parent, other.tag = page.parent[:], page.tag[:]
    other.tokens, other.text, other.links = [t[:] for t in page.tokens], page.text[:], page.links[:]
    names = [[], ["content"], ["post", "body"], ["entry"], ["story"], ["main", "text"]]
    mains = ["div", "section", "main", "div"]
    roles = {"nav": ["menu", "navigation", "nav"], "footer": ["footer", "copyright"], "aside": ["sidebar"]}
    for i, tag in enumerate(page.tag):
        if tag in ("article", "main"):
            other.tag[i], other.tokens[i] = mains[rng.integers(4)], names[rng.integers(6)][:]
        elif tag in roles and kind % 2:
            other.tag[i] = "div"
            other.tokens[i] = [roles[tag][rng.integers(len(roles[tag]))]] * int(rng.random() < 0.8)
    return other


def surroundings(page: Page, labels: np.ndarray, kind: int, words: list[str]) -> tuple[Page, np.ndarray]:
    """Append boxes of common kinds, at the page's end or inside the article."""
    rng = np.random.default_rng(kind * 104729 + len(page.tag))
    labels = labels.tolist()
    roots = [i for i in range(len(labels)) if labels[i] == -1][-1:] or [0]
    inside = [i for i, y in enumerate(labels) if y == 1 and page.tag[i] != "#text"][:1] or roots

    def text(n: int) -> str:
        start = int(rng.integers(max(1, len(words) - n)))
        return " ".join(words[start : start + n])

    def box(tag: str, token: str, parts: list[tuple[str, int, bool]], where: int) -> None:
        top = page._add(where, tag, [token] if token else [], "", 0)
        labels.append(0)
        for part, n, link in parts:
            node = page._add(top, part, [], "", 0)
            labels.append(0)
            said = text(n)
            page._add(node, "#text", [], said, len(said) * link)
            labels.append(0)

    boxes = [
        ("section", "comments", [("p", int(rng.integers(5, 60)), False) for _ in range(4)]),
        ("div", "comment", [("p", int(rng.integers(5, 60)), False)]),
        ("aside", "sidebar", [("h3", 3, False), ("p", 25, False), ("li", 4, True)]),
        ("div", "sidebar", [("li", 5, True) for _ in range(5)]),
        ("div", "cookie", [("p", 20, False)]),
        ("div", "notice", [("p", 15, False)]),
        ("form", "newsletter", [("p", 8, False)]),
        ("form", "", [("p", 5, False), ("div", 2, False)]),
        ("header", "", [("p", 4, True), ("p", 6, False)]),
        ("div", "related", [("li", 6, True) for _ in range(4)]),
        ("div", "ads", [("p", 12, False)]),
        ("div", "share", [("li", 1, True) for _ in range(4)]),
        ("footer", "", [("p", 10, False)]),
    ]
    for k in rng.permutation(len(boxes))[:5]:
        tag, token, parts = boxes[k]
        where = inside[0] if rng.random() < 0.25 and token else roots[0]
        box(tag, token, parts, where)
        if where != roots[0]:
            while where >= 0 and labels[where] == 1:
                labels[where] = -1
                where = page.parent[where]
    return page, np.array(labels)


def train(sources: list[str]) -> Trees | None:
    """Trees from pages that mark their article, and from variants of them."""
    rows, goals = [], []
    for source in sources:
        page = Page(source)
        labels = marked_article(page)
        if labels is None:
            continue
        words = " ".join(page.text).split() or ["."]
        for kind in range(4):
            shown, goal = page, labels
            if kind:
                shown, goal = surroundings(variant(page, kind, words), labels, kind, words)
            used = (goal == 0) | (goal == 1)
            rows.append(node_features(shown)[used])
            goals.append(goal[used])
    if not rows:
        return None
    x, y = np.concatenate(rows), np.concatenate(goals).astype(np.float64)
    return Trees(x, y) if 0 < y.sum() < len(y) else None


def by_rule(page: Page) -> list[bool]:
    """Per node: not within menus, headers and the like, by tags and attributes."""
    kept = [True] * len(page.tag)
    for i in range(1, len(page.tag)):
        other = page.tag[i] in AROUND[:5] or any(t in NEGATIVE for t in page.tokens[i])
        kept[i] = kept[page.parent[i]] and not other
    return kept


def main_texts(sources: list[str], trees: Trees | None) -> list[str]:
    """Main text of each page; without trees by tags and attributes alone."""
    pages = [Page(source) for source in sources]
    if trees is None or not pages:
        calls = map(by_rule, pages)
    else:
        rows = [node_features(page) for page in pages]
        ends = np.cumsum([len(r) for r in rows])
        odds = np.split(trees.log_odds(np.concatenate(rows)), ends[:-1])
        calls = (decode(page.parent, o) for page, o in zip(pages, odds))
    out = []
    for page, kept in zip(pages, calls):
        out.append("\n\n".join([t for t, k in zip(page.text, kept) if k and t]))
    return out


def fit_pages(pages: DataFrame, html_: str = "html", trained: int = TRAINED) -> Trees | None:
    """Trees from at most ``trained`` different pages that mark an article, the
    least by hash; None where no page does."""
    marked = pages.where(F.col(html_).cast("string").rlike(_MARKED))
    chosen = marked.select(F.xxhash64(F.col(html_)).alias("h")).distinct().orderBy("h").limit(trained)
    sample = marked.select(F.xxhash64(F.col(html_)).alias("h"), utf8(html_).alias("html"))
    sample = sample.join(F.broadcast(chosen), "h").dropDuplicates(["h"]).orderBy("h")
    return train([bytes(r.html).decode("utf-8", "replace") for r in sample.select("html").collect()])


def extract_main(
    pages: DataFrame,
    trees: Trees | None,
    key: str = "page_id",
    url: str = "url",
    html_: str = "html",
) -> DataFrame:
    """(key, url, text, n_chars), one row per row of ``pages``.

    Null and empty pages, and pages without an article, have an empty text.
    Without ``trees`` (no page of the sample marks an article) what tags and
    attributes do not name as menu, header, footer, sidebar, notice, advert,
    form or comment is the text. Pages are read in time in proportion to their
    length; repeated rows and null keys are rows like any other; pages are read whole;
    other columns are dropped; an empty table gives an empty one.
    """
    spread = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"), utf8(html_).alias("html")
    )

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sources = [h.decode("utf-8", "replace") for h in batch.column("html").to_pylist()]
            text = main_texts(sources, trees)
            columns = [batch.column("key"), batch.column("url"), pa.array(text, pa.string())]
            columns.append(pa.array(list(map(len, text)), pa.int64()))
            return pa.RecordBatch.from_arrays(columns, ["key", "url", "text", "n_chars"])

        return work

    kinds = [f"{c} {spread.schema[c].dataType.simpleString()}" for c in ("key", "url")]
    schema = ", ".join([*kinds, "text string, n_chars long"])
    found = map_slices(spread, "html", schema, make)
    return found.toDF(key, url, "text", "n_chars")

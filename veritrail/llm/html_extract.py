"""Main text of web pages by a tree-structured graphical model.

A page is cut into a tree of elements and runs of text. Each node has a label: content or not. A node's own potential is
a linear score of its features (its own tag, words of its class and id, length, links and marks of the text below), and an edge's
a table for parent and child labels, one for each kind of child. A node's features say nothing of the elements around it: what is in an advert is known to
be so by messages alone. Sum-product messages go from the leaves to the root and back, and a run of text is
kept if its marginal of content is above one half. All potentials are learned together from labelled pages, by the gradient of the
trees' log-likelihood.

The labelled pages are written by a generator (html_training.py) with known roles.

Edge cases: a null or empty html gives an empty text. Unclosed and stray tags, comments, CDATA, attributes with
">" in quotes, quotes within unquoted values, script and style with tags in strings are read as browsers do, roughly; the text of script and style is
never kept. A page of text without any markup is judged as one block. Pages of any depth take time in proportion to their length.
Repeated rows get the same text each. An empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import exp, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritrail.llm.common import small_batches

#: Comments, declarations, tags (a quote counts as one only after "="), or text up to the next tag.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))?)*+)(?:>|\Z)|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
SPACES = re.compile(r"\s+")
#: Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())  # tags in these are text
CODE = frozenset("script style".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var math mrow mi mo mn ms mtext msup msub msubsup mfrac msqrt svg canvas object picture".split())
FOREIGN = frozenset("svg math canvas object".split())  #: "/>" ends these
#: An opening tag of the key ends an open element of these.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BLOCKS = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Word stems in classes, ids and roles, by what they hint at.
HINTS = {
    "advert": ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "banner", "outbrain", "taboola"),
    "menu": ("nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "toolbar", "pagination", "pager", "tabs", "toc", "skip"),
    "frame": ("footer", "header", "masthead", "sidebar", "side", "aside", "copyright", "legal", "widget", "related", "recommended", "more", "tags", "share", "social"),
    "notice": ("cookie", "cookies", "consent", "notice", "gdpr", "popup", "modal", "alert", "newsletter", "subscribe", "signup", "login"),
    "comment": ("comment", "comments", "reply", "replies", "respond", "discussion", "disqus"),
    "main": ("article", "content", "main", "post", "entry", "story", "body", "text", "page", "paragraph"),
}
TAGS = ("nav", "header", "footer", "aside", "form", "button", "select", "script", "style", "title", "noscript", "article", "main", "section", "div", "p", "li", "ul", "ol", "a", "h1", "h2", "h3", "h4", "h5", "h6", "table", "tr", "td", "th", "blockquote", "pre", "figure", "figcaption", "span", "b", "em", "body", "head", "html", "label", "option", "textarea", "iframe", "dl", "dt", "dd", "address", "menu", "#text")
TAG_INDEX = {t: i for i, t in enumerate(TAGS)}
HINT_INDEX = {w: i for i, words in enumerate(HINTS.values()) for w in words}
N_HINTS = len(HINTS)
NUMBERS = 5  #: length of the text below, its share in links, marks, whether it is text, bias
N_FEATURES = len(TAGS) + 1 + N_HINTS + NUMBERS
KINDS = 3  #: of edges, by child: text, inline element, other element
KEEP = 0.5


class Tree:
    """Nodes in page order: parent, tag, words of class and id; text of the leaves."""

    def __init__(self, page: str):
        self.parent: list[int] = [-1]
        self.tag: list[str] = ["html"]
        self.hints: list[tuple[int, ...]] = [()]
        self.text: list[str | None] = [None]
        self.block: list[int] = [0]  # number of the block that a leaf's text belongs to
        self.read(page)

    def add(self, parent: int, tag: str, hints: tuple[int, ...], text: str | None, block: int) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.hints.append(hints)
        self.text.append(text)
        self.block.append(block)
        return len(self.parent) - 1

    def read(self, page: str) -> None:
        open_: list[int] = [0]
        floor: list[int] = [0]  # for each open element, the place of the innermost that isn't inline, up to itself
        names: Counter[str] = Counter()  # of the open elements
        block, at, end = 0, 0, len(page)

        def close(k: int) -> None:
            for i in open_[k:]:
                names[self.tag[i]] -= 1
            del open_[k:], floor[k:]

        while at < end:
            m = TOKEN.match(page, at)
            at = m.end()
            name = m.group(2)
            if name is None:
                s = m.group(0)
                if s[:2] not in ("<!", "<?"):
                    self.add(open_[-1], "#text", (), s, block)
                continue
            name = name.lower()
            if m.group(1):  # a closing tag ends the nearest such element, and all in it
                if names[name]:
                    k = len(open_) - 1
                    while self.tag[open_[k]] != name:
                        k -= 1
                    close(k)
                block += name not in INLINE
                continue
            if name not in INLINE:
                block += 1
            if name in VOID or name in ("html", "body", "head") and names[name]:
                continue
            if name in BLOCKS and floor[-1] and self.tag[open_[floor[-1]]] == "p":  # a block ends an open paragraph
                close(floor[-1])
            stop = CLOSES.get(name)
            if stop and len(open_) > 1 and self.tag[open_[-1]] in stop:
                close(len(open_) - 1)
                if name == "tr" and len(open_) > 1 and self.tag[open_[-1]] == "tr":
                    close(len(open_) - 1)
            node = self.add(open_[-1], name, hints_of(m.group(3)) if m.group(3) else (), None, block)
            if name in RAW:  # its end is the next closing tag of that name
                done = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                self.add(node, "#text", (), page[at : done.start() if done else end], block)
                at = done.end() if done else end
                continue
            if not m.group(0).endswith("/>") or name in BLOCKS or name in INLINE and name not in FOREIGN:
                open_.append(node)
                floor.append(floor[-1] if name in INLINE else len(open_) - 1)
                names[name] += 1


def hints_of(attributes: str) -> tuple[int, ...]:
    out = set()
    for name, *values in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role", "itemprop"):
            for word in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", "".join(values)).lower()):
                if word in HINT_INDEX:
                    out.add(HINT_INDEX[word])
    return tuple(sorted(out))


def numbers(tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """(index of the tag, (nodes, NUMBERS) of numeric features) of each node."""
    n = len(tree.parent)
    parent = tree.parent
    size, link, marks = [0] * n, [0] * n, [0] * n
    linked = [False] * n
    tag = [TAG_INDEX.get(t, len(TAGS)) for t in tree.tag]
    for i in range(1, n):
        linked[i] = linked[parent[i]] or tree.tag[i] == "a"
        s = tree.text[i]
        if s is not None:
            size[i] = len(s)
            marks[i] = s.count(".") + s.count(",")
            link[i] = len(s) if linked[i] else 0
    for i in range(n - 1, 0, -1):  # children come after their parents
        p = parent[i]
        size[p] += size[i]
        link[p] += link[i]
        marks[p] += marks[i]
    sizes = np.array(size, float)
    out = np.ones((n, NUMBERS))
    out[:, 0] = np.log1p(sizes) / 5
    out[:, 1] = np.array(link) / np.maximum(sizes, 1)
    out[:, 2] = np.minimum(np.array(marks) * 50 / np.maximum(sizes, 50), 2)
    out[:, 3] = [t is not None for t in tree.text]
    return np.array(tag), out


def features(tree: Tree) -> np.ndarray:
    """(nodes, N_FEATURES): tag, hints of its own class and id, numbers."""
    tag, rest = numbers(tree)
    x = np.zeros((len(tag), N_FEATURES))
    x[np.arange(len(tag)), tag] = 1
    for i, hints in enumerate(tree.hints):
        for h in hints:
            x[i, len(TAGS) + 1 + h] = 1
    x[:, -NUMBERS:] = rest
    return x


def kinds(tree: Tree) -> list[int]:
    """Of each node's edge to its parent."""
    return [0 if s is not None else 1 if t in INLINE else 2 for t, s in zip(tree.tag, tree.text, strict=True)]


class Model:
    """weights: of the features; edge[kind, parent label, child label]: log potentials."""

    def __init__(self, weights: np.ndarray, edge: np.ndarray):
        self.weights, self.edge = weights, edge

    def own(self, tree: Tree) -> list[float]:
        """Scores of the nodes' own features, without their matrix: a deep page has many nodes."""
        tag, rest = numbers(tree)
        out = (self.weights[tag] + rest @ self.weights[-NUMBERS:]).tolist()
        of = self.weights[len(TAGS) + 1 :].tolist()
        for i, hints in enumerate(tree.hints):
            for h in hints:
                out[i] += of[h]
        return out

    def marginals(self, tree: Tree) -> np.ndarray:
        """Probability of content of each node, by messages up and down in log space."""
        up1 = self.own(tree)
        n = len(up1)
        edge = self.edge.reshape(-1, 4).tolist()
        kind = kinds(tree)
        up0 = [0.0] * n
        to0, to1 = [0.0] * n, [0.0] * n  # the message of each node to its parent
        parent = tree.parent
        add = log_add
        for i in range(n - 1, 0, -1):
            p = parent[i]
            e00, e01, e10, e11 = edge[kind[i]]
            to0[i] = add(e00 + up0[i], e01 + up1[i])
            to1[i] = add(e10 + up0[i], e11 + up1[i])
            up0[p] += to0[i]
            up1[p] += to1[i]
        full0, full1 = up0[:], up1[:]
        for i in range(1, n):
            p = parent[i]
            e00, e01, e10, e11 = edge[kind[i]]
            a0, a1 = full0[p] - to0[i], full1[p] - to1[i]  # what the parent knows without this child
            full0[i] += add(a0 + e00, a1 + e10)
            full1[i] += add(a0 + e01, a1 + e11)
        return 1 / (1 + np.exp(np.clip(np.array(full0) - np.array(full1), -500, 500)))


def log_add(a: float, b: float) -> float:
    return a + log1p(exp(b - a)) if a > b else b + log1p(exp(a - b))


def train(pages: list[str], rounds: int = 150, rate: float = 0.1, decay: float = 1e-4) -> Model:
    """From pages whose content carries the generator's marks: expected less observed features and label pairs, all pages at once, level by level."""
    from veritrail.llm.html_training import labelled_tree

    xs, ys, parents, edges, depths = [], [], [], [], []
    at = 0
    for page in pages:
        tree, labels = labelled_tree(page)
        depth = np.zeros(len(labels), np.int64)
        for i in range(1, len(labels)):
            depth[i] = depth[tree.parent[i]] + 1
        xs.append(features(tree))
        ys.append(labels)
        parents.append(np.array(tree.parent) + at)
        edges.append(kinds(tree))
        depths.append(depth)
        at += len(labels)
    x, y, parent, kind, depth = (np.concatenate(v) for v in (xs, ys, parents, edges, depths))
    levels = [np.flatnonzero(depth == d) for d in range(1, int(depth.max()) + 1)]
    child = np.flatnonzero(depth > 0)
    seen = np.zeros((KINDS, 2, 2))
    np.add.at(seen, (kind[child], y[parent[child]], y[child]), 1)
    observed = x.T @ y
    params = np.zeros(x.shape[1] + seen.size)
    first, second = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, rounds + 1):
        w, edge = params[: x.shape[1]], params[x.shape[1] :].reshape(seen.shape)
        up = np.stack([np.zeros(len(y)), x @ w], axis=1)
        to = np.zeros_like(up)
        for at in reversed(levels):
            to[at] = np.logaddexp.reduce(edge[kind[at]] + up[at][:, None, :], axis=2)
            np.add.at(up, parent[at], to[at])
        full = up.copy()
        for at in levels:
            full[at] += np.logaddexp.reduce(edge[kind[at]] + (full[parent[at]] - to[at])[:, :, None], axis=1)
        p = 1 / (1 + np.exp(full[:, 0] - full[:, 1]))
        pair = edge[kind[child]] + (full[parent[child]] - to[child])[:, :, None] + up[child][:, None, :]
        pair = np.exp(pair - np.logaddexp.reduce(pair.reshape(len(child), 4), axis=1)[:, None, None])
        expected = np.stack([pair[kind[child] == k].sum(axis=0) for k in range(KINDS)])
        gradient = np.concatenate([x.T @ p - observed, (expected - seen).ravel()]) / len(y) + decay * params
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2  # Adam
        params = params - rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return Model(params[: x.shape[1]], params[x.shape[1] :].reshape(seen.shape))


def extract(page: str | None, model: Model) -> str:
    if not page:
        return ""
    tree = Tree(page)
    keep = model.marginals(tree) > KEEP
    parts: list[str] = []
    last, held = -1, []
    for i, s in enumerate(tree.text):
        if s is None or not keep[i] or tree.tag[tree.parent[i]] in CODE:
            continue
        if tree.block[i] != last and held:
            parts.append("".join(held))
            held = []
        last = tree.block[i]
        held.append(s)
    parts.append("".join(held))
    blocks = (SPACES.sub(" ", html.unescape(p)).strip() for p in parts)
    return " ".join(b for b in blocks if b)


@lru_cache(1)
def default_model() -> Model:
    from veritrail.llm.html_training import generate

    return train(generate())


def extract_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    model = model or default_model()
    weights, edge = model.weights, model.edge
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(weights, edge)
        for batch in batches:
            texts = [extract(p, own) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")

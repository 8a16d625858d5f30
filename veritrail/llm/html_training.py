"""Labelled pages for html_extract: a generator that knows which runs of text it wrote as content.

Pages vary in their layout, tags, class names, order and clutter. Content text begins with KEEP_MARK, anything else does
not; the mark is taken out before features are made, so it is known only to the labels.
"""

from __future__ import annotations

import random

import numpy as np

from veritrail.llm import html_extract

KEEP_MARK = ""  #: a private character that no page has
PAGES, SEED = 240, 3


def words(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice(("ba", "ke", "lor", "mi", "nu", "sta", "ter", "vi", "on", "de")) for _ in range(r.randint(1, 4))) for _ in range(n))


def sentence(r: random.Random) -> str:
    return words(r, r.randint(4, 16)).capitalize() + r.choice((". ", ". ", "! ", "? "))


def paragraph(r: random.Random) -> str:
    return "".join(sentence(r) for _ in range(r.randint(1, 7)))


def inline(r: random.Random, text: str) -> str:
    """Some words of the text in inline elements; every run of text keeps its mark."""
    out = []
    for word in text.split(" "):
        if word and r.random() < 0.04:
            tag = r.choice(("b", "em", "i", "strong", "span", 'a href="/x"', "code"))
            out.append(f"<{tag}>{KEEP_MARK}{word}</{tag.split()[0]}>{KEEP_MARK}")
        else:
            out.append(word)
    return KEEP_MARK + " ".join(out)


def content(r: random.Random) -> str:
    out = []
    if r.random() < 0.85:
        h = r.choice(("h1", "h1", "h1", "h2"))
        out.append(f"<{h}>{inline(r, words(r, r.randint(2, 12)))}</{h}>")
    for _ in range(r.randint(1, 12)):
        k = r.random()
        if k < 0.66:
            out.append(f"<p>{inline(r, paragraph(r))}" + ("</p>" if r.random() < 0.85 else ""))
        elif k < 0.72:
            out.append(f"<p><b>{inline(r, paragraph(r))}<br>")
        elif k < 0.8:
            tag = r.choice(("ul", "ol"))
            out.append(f"<{tag}>" + "".join(f"<li>{inline(r, sentence(r))}</li>" for _ in range(r.randint(2, 5))) + f"</{tag}>")
        elif k < 0.86:
            out.append(f"<h2>{inline(r, words(r, r.randint(1, 8)))}</h2>")
        elif k < 0.9:
            out.append(f"<blockquote><p>{inline(r, paragraph(r))}</p></blockquote>")
        elif k < 0.93:
            out.append(f"<pre>{KEEP_MARK}{words(r, 9)}</pre>")
        elif k < 0.96:
            cells = "".join(f"<tr><td>{inline(r, words(r, 2))}</td><td>{inline(r, words(r, 3))}</td></tr>" for _ in range(r.randint(1, 4)))
            out.append(f"<table>{cells}</table>")
        else:
            out.append(f"<figure><img src=x><figcaption>{inline(r, sentence(r))}</figcaption></figure>")
    return "".join(out)


def links(r: random.Random, n: int) -> str:
    return "".join(f'<li><a href="/{k}">{words(r, r.randint(1, 3))}</a></li>' for k in range(n))


def clutter(r: random.Random) -> str:
    kind = r.randrange(11)
    if kind == 0:
        return f"<nav><ul>{links(r, r.randint(2, 9))}</ul></nav>"
    if kind == 1:
        return f'<div class="{r.choice(("menu", "navbar", "site-navigation", "breadcrumbs"))}"><ul>{links(r, r.randint(2, 9))}</ul></div>'
    if kind == 2:
        return f'<div class="{r.choice(("ad", "ads", "advert", "sponsored", "promo banner"))}">{paragraph(r)}</div>'
    if kind == 3:
        return f'<aside class="{r.choice(("sidebar", "related", "widget"))}"><h3>{words(r, 2)}</h3><p>{paragraph(r)}</p><ul>{links(r, 3)}</ul></aside>'
    if kind == 4:
        return f'<div id="{r.choice(("cookie-notice", "consent", "newsletter", "popup"))}"><p>{paragraph(r)}</p><button>{words(r, 1)}</button></div>'
    if kind == 5:
        return f"<form action=/x><label>{words(r, 2)}</label><input name=q><select><option>{words(r, 1)}<option>{words(r, 1)}</select><button>{words(r, 1)}</button></form>"
    if kind == 6:
        each = "".join(f'<div class="{r.choice(("comment", "reply", "comment-body"))}"><b>{words(r, 1)}</b><p>{paragraph(r)}</p></div>' for _ in range(r.randint(1, 5)))
        tag = r.choice(("section", "div"))
        return f'<{tag} class="{r.choice(("comments", "discussion", "comment-list"))}"><h3>{words(r, 1)}</h3>{each}</{tag}>'
    if kind == 7:
        return f"<script>var a=\"<p>{words(r, 3)}</p>\";</script><style>p{{x:{r.randint(1, 9)}}}</style>"
    if kind == 8:
        return f'<div class="{r.choice(("sidebar", "share social", "related more", "tags"))}">{paragraph(r)}<a href=/z>{words(r, 2)}</a></div>'
    if kind == 9:
        return f"<noscript>{sentence(r)}</noscript>"
    return f"<!-- {words(r, 3)} --><div class=\"{r.choice(('notice', 'alert', 'login'))}\">{sentence(r)}</div>"


def page(r: random.Random) -> str:
    head = f"<!DOCTYPE html><html><head><meta charset=utf-8><title>{words(r, 5)}</title><style>p{{a:b}}</style><script>x('</p>')</script></head><body>"
    top = f'<{r.choice(("header", "header", 'div class="header"'))}><p>{sentence(r)}</p>'
    top = (top + ("</header>" if top.startswith("<header") else "</div>")) if r.random() < 0.6 else ""
    foot = f"<footer>&copy; {sentence(r)} &middot; {paragraph(r)}</footer>" if r.random() < 0.75 else f'<div class="footer">{sentence(r)}</div>'
    wrap = r.choice(("article", "article", "article", "main", 'div class="content"', 'div id="main"', 'div class="post-body entry"', "div"))
    body = f"<{wrap}>{content(r)}</{wrap.split()[0]}>"
    if r.random() < 0.5:
        around = r.choice(("main", "main", 'div class="content"', 'div id="page"', "div", "article"))
        body = f"<{around}>{clutter(r) if r.random() < 0.5 else ''}{body}{clutter(r)}</{around.split()[0]}>"
    parts = [top, *(clutter(r) for _ in range(r.randint(0, 4))), body, *(clutter(r) for _ in range(r.randint(0, 4))), foot]
    return head + "".join(parts) + ("</body></html>" if r.random() < 0.8 else "")


def generate(n: int = PAGES, seed: int = SEED) -> list[str]:
    r = random.Random(seed)
    return [page(r) for _ in range(n)]


def labelled_tree(marked: str) -> tuple[html_extract.Tree, np.ndarray]:
    """The page's tree without marks, and the label of each node: an element is content if half its text is."""
    tree = html_extract.Tree(marked)
    n = len(tree.parent)
    size, kept = np.zeros(n), np.zeros(n)
    for i, s in enumerate(tree.text):
        if s is not None:
            tree.text[i] = s.replace(KEEP_MARK, "")
            size[i] = max(1, len(tree.text[i]))
            kept[i] = size[i] * (KEEP_MARK in s)
    for i in range(n - 1, 0, -1):
        size[tree.parent[i]] += size[i]
        kept[tree.parent[i]] += kept[i]
    return tree, (2 * kept > size).astype(np.int64)


def expected(marked: str) -> tuple[str, str]:
    """(the page as it would be served, its content)."""
    tree, labels = labelled_tree(marked)
    served = marked.replace(KEEP_MARK, "")

    class Known:
        def marginals(self, _: html_extract.Tree) -> np.ndarray:
            return labels.astype(float)

    return served, html_extract.extract(served, Known())

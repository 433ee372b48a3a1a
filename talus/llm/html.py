"""Main text of pages: gradient-boosted trees over DOM-node features, decoded over the tree.

A page becomes a tree of block nodes.  Trees score for each node the log-odds that its subtree
holds article text.  Decoding is exact over the whole tree: a node can only be kept inside kept
ancestors and a dropped node drops all below it, and of all such choices the likeliest is taken.
The model is fitted on pages that a generator writes, whose article nodes are known.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from talus.llm.common import batches, sliced

UNSEEN = {"script", "style", "noscript", "template", "head", "title", "iframe", "svg", "object", "canvas", "math", "audio", "video", "datalist"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
#: Elements that may stand in a head; anything else begins the body.
HEADED = {"base", "link", "meta", "noscript", "script", "style", "template", "title"}
#: Foreign content ends where one of these begins.
BREAKS = {"blockquote", "body", "center", "div", "dl", "h1", "h2", "h3", "h4", "h5", "h6", "li", "main", "nav", "ol", "p", "pre", "section", "article", "aside", "footer", "header", "table", "ul"}
GROUPS = (
    ("nav", "menu"), ("header",), ("footer",), ("aside", "dialog"), ("button", "select", "textarea", "label", "fieldset", "option", "legend", "output"),
    ("article", "main"), ("section", "div", "center"), ("p",), ("h1", "h2", "h3", "h4", "h5", "h6"), ("li", "ul", "ol", "dl", "dt", "dd"),
    ("table", "tr", "td", "th", "tbody", "thead", "caption"), ("blockquote", "pre", "figure", "figcaption", "address"), ("html", "body", "#run"), ("form",),
)
TOKENS = (
    ("ad", "ads", "advert", "advertisement", "adbox", "sponsor", "sponsored", "promo", "promotion", "banner", "adsense"),
    ("nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "tabs", "pager", "pagination", "toc", "skip"),
    ("header", "masthead", "topbar", "logo", "footer", "copyright", "legal", "bottom", "contentinfo"),
    ("sidebar", "side", "aside", "widget", "related", "share", "social", "recommended", "more", "complementary", "tags", "byline", "meta"),
    ("comment", "comments", "disqus", "reply", "replies", "respond", "discussion", "reader", "feedback"),
    ("cookie", "cookies", "consent", "notice", "alert", "popup", "modal", "newsletter", "subscribe", "gdpr", "signup", "login", "paywall", "search", "overlay"),
    ("article", "content", "main", "post", "entry", "story", "text", "body", "articlebody"),
)
#: An opened block closes an open paragraph; these close their own kind too.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = {"div", "article", "section", "main", "td", "table", "ul", "ol", "dl", "aside", "nav", "body", "blockquote"}


@dataclass(slots=True)
class Node:
    tag: str
    attrs: str = ""
    parent: Node | None = None
    children: list = field(default_factory=list)
    parts: list = field(default_factory=list)
    linked: int = 0
    truth: int = 0
    at: int = 0

    def text(self) -> str:
        return " ".join("".join(self.parts).split()) if self.parts else ""


class Builder(HTMLParser):
    """The tree of block nodes; loose text between blocks stands in ``#run`` nodes."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.stack: list[tuple[str, Node]] = [("html", self.root)]
        self.open: Counter[str] = Counter()
        self.hidden: list[str] = []
        self.links, self.ended = 0, False

    @property
    def block(self) -> Node:
        return self.stack[-1][1]

    def updatepos(self, i, j):  # line numbers are not asked for
        return j

    def parse_html_declaration(self, i):
        """Past a declaration, comment or marked section of any kind (one without an end hides the rest);
        -1 if more of the page may end it."""
        raw = self.rawdata
        if raw.startswith("<!--", i):
            at = self.parse_comment(i)
            return len(raw) if at < 0 and self.ended else at
        end = "]]>" if raw.startswith("<![CDATA[", i) else ">"
        at = raw.find(end, i)
        return at + len(end) if at >= 0 else len(raw) if self.ended else -1

    def close(self):
        self.ended = True
        super().close()

    def handle_starttag(self, tag, attrs):
        if self.hidden:
            top = self.hidden[-1]
            if top == "head" and tag not in HEADED and tag != "head" or tag == "body" or top in ("svg", "math") and tag in BREAKS:
                self.hidden.clear()
            else:
                if tag not in VOID and (tag == top or top == "head" and tag in UNSEEN):
                    self.hidden.append(tag)
                return
        if tag in UNSEEN:
            self.hidden.append(tag)
            return
        if tag in VOID:
            if tag in ("br", "hr", "wbr", "img", "input"):
                self._text(" ")
            return
        if tag == "html":
            return
        if tag in INLINE:
            self.links += tag == "a"
            self._push(tag, self.block)
            return
        own = CLOSES.get(tag)
        self._close({"p"} | own if own else {"p"}, STOPS - own if own else STOPS)
        while self.stack[-1][0] in INLINE:  # a block ends what is left open of inline marks
            self._pop()
        words = " ".join(v for k, v in attrs if v and k in ("class", "id", "role", "itemprop", "aria-label"))
        node = Node(tag, words, self.block)
        self.block.children.append(node)
        self._push(tag, node)

    def handle_startendtag(self, tag, attrs):
        """A slash closes foreign elements only; elsewhere it says nothing."""
        if not (tag in ("svg", "math") or self.hidden and self.hidden[-1] in ("svg", "math")):
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.hidden:
            if tag == self.hidden[-1]:
                self.hidden.pop()
            elif tag in self.hidden:
                del self.hidden[self.hidden.index(tag) :]
            elif self.open[tag] and tag not in INLINE:  # what hides was left open inside this element
                self.hidden.clear()
                self.handle_endtag(tag)
            return
        if self.open[tag]:
            while self.stack[-1][0] != tag:
                self._pop()
            self._pop()

    def _push(self, tag: str, node: Node):
        self.stack.append((tag, node))
        self.open[tag] += 1

    def _pop(self):
        tag, _ = self.stack.pop()
        self.open[tag] -= 1
        self.links -= tag == "a"

    def _close(self, tags: set[str], stop: set[str]):
        if not any(self.open[t] for t in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] in tags:
                while len(self.stack) > i:
                    self._pop()
                return
            if self.stack[i][0] in stop:
                return

    def handle_data(self, data):
        if self.hidden == ["head"] and data.strip():  # text begins the body
            self.hidden.clear()
        if not self.hidden:
            self._text(data)

    def _text(self, data: str):
        at = self.block
        if at.children and at.children[-1].tag == "#run":
            at = at.children[-1]
        elif at.children or at.tag in ("html", "body"):
            if not data.strip():
                return
            at.children.append(Node("#run", "", at))
            at = at.children[-1]
        at.parts.append(data)
        if self.links > 0:
            at.linked += len(data.strip())


def tree(html: str | None) -> list[Node]:
    """The page's nodes in page order; parents before children."""
    b = Builder()
    b.feed(html or "")
    b.close()
    out, todo = [], [b.root]
    while todo:
        node = todo.pop()
        if node.children and any(x.strip() for x in node.parts) and node.tag != "#run":
            run = Node("#run", "", node, parts=node.parts, linked=node.linked, truth=node.truth)
            node.parts, node.linked = [], 0
            node.children.insert(0, run)
        node.at = len(out)
        out.append(node)
        todo += reversed(node.children)
    return out


_GROUP = {t: i for i, g in enumerate(GROUPS) for t in g}
_TOKEN = {t: i for i, g in enumerate(TOKENS) for t in g}
BAD_TAGS, GOOD_TAGS = {0, 1, 2, 3, 4}, {5}
NONE = (0,) * len(TOKENS)
WIDTH = len(GROUPS) + 2 * len(TOKENS) + 17


@lru_cache(maxsize=4096)
def _tokens(attrs: str) -> tuple[int, ...]:
    out = [0] * len(TOKENS)
    for w in "".join(c if c.isalnum() else " " for c in attrs.lower()).split():
        if w in _TOKEN:
            out[_TOKEN[w]] += 1
    return tuple(out)


def features(nodes: list[Node], own: list[str] | None = None) -> np.ndarray:
    """A row for each node (its text in ``own``): tag, attribute tokens (own and of ancestors),
    depth, subtree and sibling statistics."""
    n = len(nodes)
    own = [x.text() for x in nodes] if own is None else own
    up = [-1 if x.parent is None else x.parent.at for x in nodes]
    sub = np.array(
        [(len(t), min(x.linked, len(t)), t.count(" ") + 1, t.count(".") + t.count(",") + t.count("!") + t.count("?") + t.count(";"), 1, x.tag == "p") if t else (0, 0, 0, 0, 1, 0) for x, t in zip(nodes, own)],
        float,
    )
    chars = sub[:, 0].copy()
    for i in range(n - 1, 0, -1):  # children stand after their parents
        sub[up[i]] += sub[i]
    out = np.zeros((n, WIDTH))
    g, t = len(GROUPS), len(TOKENS)
    depth, bad, good = [0] * n, [0] * n, [0] * n
    place, count, same = [0] * n, [1] * n, [1] * n
    group, tokens = [0] * n, [NONE] * n
    above = [NONE] * n
    for i, x in enumerate(nodes):
        j = up[i]
        k = group[i] = _GROUP.get(x.tag, 6)
        tok = tokens[i] = _tokens(x.attrs) if x.attrs else NONE
        if j >= 0:
            depth[i], bad[i], good[i], above[i] = depth[j] + 1, bad[j], good[j], above[j]
        if tok is not NONE:
            above[i] = tuple(map(sum, zip(above[i], tok)))
            bad[i] += sum(tok[:6])
            good[i] += tok[6]
        bad[i] += k in BAD_TAGS
        good[i] += k in GOOD_TAGS
        if x.children:
            tags = [c.tag for c in x.children]
            held = {a: tags.count(a) for a in set(tags)}
            for a, c in enumerate(x.children):
                place[c.at], count[c.at], same[c.at] = a, len(tags), held[c.tag]
    out[np.arange(n), group] = 1
    out[:, g : g + t], out[:, g + t : g + 2 * t] = tokens, above
    depth, bad, good, place, count, same = (np.array(v, float) for v in (depth, bad, good, place, count, same))
    top = np.maximum(np.array(up), 0)
    c = sub[:, 0]
    rest = [
        depth, np.log1p(c), np.log1p(chars), sub[:, 1] / np.maximum(c, 1), c / np.maximum(sub[:, 4], 1), sub[:, 3] / np.maximum(sub[:, 2], 1), np.log1p(sub[:, 2]),
        c / max(c[0], 1), place / count, np.log1p(count), same / count, np.log1p(sub[:, 5]), np.log1p(sub[top, 0]), sub[top, 1] / np.maximum(sub[top, 0], 1), bad, good, np.log1p(sub[top, 5]),
    ]
    out[:, g + 2 * t :] = np.stack(rest, axis=1)
    return out


# --- boosted trees ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Trees:
    """Full trees of one depth: feature and threshold of the inner nodes, values of the leaves."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def odds(self, x: np.ndarray) -> np.ndarray:
        out, rows, inner = np.full(len(x), self.base), np.arange(len(x)), self.feature.shape[1]
        for f, t, v in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), np.int64)
            while at.size and at[0] < inner:
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - inner]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.25) -> Trees:
    """Logistic boosting with second-order splits over up to 32 thresholds of a feature."""
    cuts = [np.unique(np.quantile(np.unique(x[:, j]), np.linspace(0, 1, 33)[1:-1], method="nearest")) for j in range(x.shape[1])]
    cuts = [c[c < x[:, j].max()] for j, c in enumerate(cuts)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    base = float(np.log(max(y.mean(), 1e-6) / max(1 - y.mean(), 1e-6)))
    odds, trees = np.full(len(y), base), []
    inner = 2**depth - 1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-odds))
        grad, hess = y - p, p * (1 - p)
        feature, threshold, value = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(inner + 1)
        at = np.zeros(len(y), np.int64)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            best = (1e-9, 0, np.inf)
            if len(rows):
                g, h = grad[rows], hess[rows]
                total = g.sum() ** 2 / (h.sum() + 1)
                for j, c in enumerate(cuts):
                    if len(c):
                        b = binned[rows, j]
                        gl = np.cumsum(np.bincount(b, g, len(c) + 1))[:-1]
                        hl = np.cumsum(np.bincount(b, h, len(c) + 1))[:-1]
                        gain = gl**2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - total
                        k = int(gain.argmax())
                        if gain[k] > best[0]:
                            best = (float(gain[k]), j, float(c[k]))
                at[rows] = 2 * node + 1 + (x[rows, best[1]] > best[2])
            feature[node], threshold[node] = best[1], best[2]
        leaf = at - inner
        value = rate * np.bincount(leaf, grad, inner + 1) / (np.bincount(leaf, hess, inner + 1) + 1)
        odds += value[leaf]
        trees.append((feature, threshold, value))
    return Trees(base, *(np.stack(z) for z in zip(*trees)))


# --- training pages --------------------------------------------------------------------------


def _words(r: random.Random, lo: int, hi: int) -> str:
    words = ["".join(r.choice("aeiounrstldmé") for _ in range(r.randint(2, 9))) for _ in range(r.randint(lo, hi))]
    out = " ".join(w + r.choice(["", "", "", "", ",", ".", ".", "***", "&amp;"]) for w in words)
    return out[:1].upper() + out[1:] + r.choice([".", ".", "!", ""])


def _mark(r: random.Random, kind: int) -> str:
    if r.random() < 0.15:
        return f' data-n="{r.randint(1, 9)}"'
    word = r.choice(TOKENS[kind])
    return f' {r.choice(["class", "class", "id"])}="{word}{r.choice(["", "-box", " x1", "-" + str(r.randint(1, 9))])}"'


def _framed(r: random.Random) -> str:
    """A page with an article element, or a block in its place, among menus, notices and the like."""
    main = ' data-main="1"'

    def para() -> str:
        lo, hi = r.choice([(1, 3), (4, 20), (20, 60), (30, 120)])
        body = _words(r, lo, hi)
        if r.random() < 0.2:
            body = f"<b>{_words(r, 1, 6)}</b> {body}"
        if r.random() < 0.2:
            body += f' <a href="/x">{_words(r, 1, 4)}</a>'
        if r.random() < 0.1:
            return f"<p{main}><b>{body}<br>"
        return f"<p{main}>{body}" + ("</p>" if r.random() < 0.95 else "")

    def items(inside: str = "") -> str:
        return "<ul>" + "".join(f"<li{inside}>{_words(r, 2, 20) if inside else f'<a href=#>{_words(r, 1, 2)}</a>'}</li>" for _ in range(r.randint(2, 7))) + "</ul>"

    def junk(kind: int) -> str:
        tag = r.choice({0: ["div", "aside", "div"], 1: ["nav", "div", "nav"], 2: ["header", "footer", "div"], 3: ["aside", "div", "section"], 4: ["section", "div"], 5: ["div", "section", "p"]}[kind])
        mark = _mark(r, kind) if tag in ("div", "section", "p") or r.random() < 0.4 else ""
        if tag in ("div", "section", "p") and "data-n" in mark:
            mark = f' class="{TOKENS[kind][0]}"'
        body = r.choice([lambda: items(), lambda: _words(r, 3, 25), lambda: f"<p>{_words(r, 3, 40)}</p>", lambda: f"<h3>{_words(r, 1, 3)}</h3><p>{_words(r, 5, 40)}</p><p>{_words(r, 5, 40)}</p>"])
        inner = _words(r, 3, 12) if tag == "p" else items() if kind == 1 and r.random() < 0.8 else body()
        return f"<{tag}{mark}>{inner}</{tag}>"

    def form() -> str:
        return f'<form{_mark(r, 5)}><label>{_words(r, 1, 3)}</label><input name="q"><button>{_words(r, 1, 2)}</button></form>'

    body = [f"<h1{main}>{_words(r, 2, 10)}</h1>"] if r.random() < 0.9 else []
    for _ in range(r.choice([1, 2, 4, 8, 14])):
        body.append(r.choices([para(), f"<h2{main}>{_words(r, 1, 8)}</h2>", items(main), f"<blockquote{main}>{_words(r, 5, 40)}</blockquote>", f"<pre{main}>{_words(r, 5, 30)}</pre>", f"<table><tr><td{main}>{_words(r, 1, 6)}</td><td{main}>{_words(r, 1, 6)}</td></tr></table>", junk(0), junk(3), junk(5)], [12, 1.5, 0.8, 0.5, 0.3, 0.3, 0.5, 0.4, 0.4])[0])
    if r.random() < 0.2:
        body.append(junk(4))
    holder, mark = r.choice([("article", ""), ("article", ""), ("main", ""), ("div", f' class="{r.choice(TOKENS[6])}"'), ("div", f' id="{r.choice(TOKENS[6])}"'), ("section", f' class="{r.choice(TOKENS[6])}"'), ("div", ""), ("article", f' class="{r.choice(TOKENS[6])}"')])
    article = f"<{holder}{mark}>" + "".join(body) + f"</{holder}>"
    if r.random() < 0.4:
        article = f"<{r.choice(['main', 'div'])}{r.choice(['', ' class=wrap', ' id=page'])}>{junk(3) if r.random() < 0.4 else ''}{article}{junk(3) if r.random() < 0.4 else ''}{junk(4) if r.random() < 0.4 else ''}"
        article += "</div>" if article.startswith("<div") else "</main>"
    if r.random() < 0.03:
        article = ""
    before = [f() for f in (lambda: junk(1), lambda: junk(2), lambda: junk(0), lambda: junk(5), form) if r.random() < 0.55]
    after = [f() for f in (lambda: junk(4), lambda: junk(3), lambda: junk(0), lambda: junk(2), form, lambda: junk(5)) if r.random() < 0.45]
    r.shuffle(before)
    return "<!DOCTYPE html><html><head><title>x</title><script>var t='</p>';</script></head><body>" + "".join(before) + article + "".join(after) + ("</body></html>" if r.random() < 0.9 else "")


def _bare(r: random.Random) -> str:
    """Pages without an article element: loose paragraphs, text parted by line ends, tables as layout,
    blocks whose names say nothing, a form around all, plain text."""
    main = ' data-main="1"'
    name = lambda: r.choice(["", f' class="{r.choice("cxzjk")}{r.randint(1, 99)}"', f' id="b{r.randint(1, 99)}"', ' class="row"', ' class="col wrap"'])
    links = lambda sep, n: sep.join(f'<a href="/{i}">{_words(r, 1, 3)}</a>' for i in range(n))
    para = lambda: f"<p{main}>{_words(r, *r.choice([(2, 6), (8, 30), (30, 90)]))}</p>"
    lines = lambda: "<br><br>".join(_words(r, 10, 60) for _ in range(r.randint(1, 5)))
    title = f"<h1{main}>{_words(r, 2, 9)}</h1>" if r.random() < 0.7 else ""
    item = lambda: r.choices([para(), f"<h2{main}>{_words(r, 1, 6)}</h2>", f"<ul{main}>" + "".join(f"<li{main}>{_words(r, 3, 15)}</li>" for _ in range(r.randint(2, 5))) + "</ul>", f"<blockquote{main}>{_words(r, 8, 30)}</blockquote>", f"<figure{main}><figcaption{main}>{_words(r, 4, 14)}</figcaption></figure>"], [10, 1, 1, 0.5, 0.3])[0]
    text = title + "".join(item() for _ in range(r.randint(2, 10)))
    menu = r.choice([f"<div{name()}>{links(' | ', r.randint(3, 8))}</div>", f"<ul{name()}>" + "".join(f"<li>{links('', 1)}</li>" for _ in range(r.randint(3, 8))) + "</ul>", f"<p>{links(' - ', 4)}</p>", "", f"<div{_mark(r, 1)}>{links(' ', 5)}</div>"])
    end = r.choice(["", f"<div{name()}>&copy; 20{r.randint(10, 30)} {_words(r, 1, 4)} {links(' ', 3)}</div>", f"<div{_mark(r, 2)}>{_words(r, 3, 12)}</div>", f"<footer>{_words(r, 3, 12)}</footer>", f"<div{_mark(r, 4)}><p>{_words(r, 5, 30)}</p><p>{_words(r, 5, 30)}</p></div>"])
    kind = r.randrange(7)
    if kind == 0:
        inner = menu + text + end
    elif kind == 1:
        inner = f"{menu}<div{name()}{main}>{lines()}</div>{end}"
    elif kind == 2:
        inner = f"<table><tr><td{name()} width=150>{links('<br>', r.randint(4, 9))}</td><td{name()}{main}>{r.choice([text, lines()])}</td></tr></table>{end}"
    elif kind == 3:
        inner = f"<div{name()}>{menu}<div{name()}><div{name()}>{text}</div></div>{end}</div>"
    elif kind == 4:
        inner = f'<form method="post" action="./{name()[1:2]}" id="form1"><input type="hidden" name="s" value="x">{menu}<div{name()}>{text}</div><label>{_words(r, 1, 2)}</label><button>{_words(r, 1, 2)}</button>{end}</form>'
    elif kind == 5:
        inner = text
    else:
        return r.choice([f"<div{main}>{lines()}</div>", text, f"<body{main}><pre{main}>{_words(r, 10, 80)}</pre>"])
    return r.choice(["<html><head><title>x</title></head><body>", "<title>x</title>", "<!DOCTYPE html><html><head><meta charset=utf-8><title>x</title><body>"]) + inner


def training_page(seed: int) -> str:
    """A page whose article blocks carry ``data-main``: many layouts, one article or none."""
    r = random.Random(seed)
    return _bare(r) if seed % 3 == 2 else _framed(r)


class _Known(Builder):
    """A builder that notes which nodes the generator marked."""

    def handle_starttag(self, tag, attrs):
        super().handle_starttag(tag, attrs)
        if ("data-main", "1") in attrs and not self.hidden:
            self.block.truth = 1


@lru_cache(maxsize=2)
def model(pages: int = 1200) -> Trees:
    """The fitted trees (the same at every call): ``pages`` generated pages, a bounded sample."""
    xs, ys = [], []
    for seed in range(pages):
        b = _Known()
        b.feed(training_page(seed))
        b.close()
        nodes, todo = [], [b.root]
        while todo:
            nodes.append(todo.pop())
            nodes[-1].at = len(nodes) - 1
            todo += reversed(nodes[-1].children)
        for node in reversed(nodes):
            if node.truth and node.parent is not None:
                node.parent.truth = 1
        xs.append(features(nodes))
        ys.append(np.array([x.truth for x in nodes], float))
    return boost(np.concatenate(xs), np.concatenate(ys))


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """The likeliest choice in which every kept node's ancestors are kept."""
    gain = odds.tolist()  # of keeping, over dropping the whole subtree
    for i in range(len(nodes) - 1, 0, -1):
        if gain[i] > 0:
            gain[nodes[i].parent.at] += gain[i]
    keep = [gain[0] > 0] * len(nodes)
    for i, n in enumerate(nodes[1:], 1):
        keep[i] = gain[i] > 0 and keep[n.parent.at]
    return keep


def texts(pages: list[str | None], trees: Trees) -> list[str]:
    """The main text of each page."""
    forest = [tree(h) for h in pages]
    words = [[n.text() for n in nodes] for nodes in forest]
    rows = [features(nodes, own) for nodes, own in zip(forest, words)]
    odds = trees.odds(np.concatenate(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for nodes, own in zip(forest, words):
        keep = decode(nodes, odds[at : at + len(nodes)])
        at += len(nodes)
        out.append("\n".join([t for t, k in zip(own, keep) if k and t]))
    return out


def extract(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """A row for each page row: page_id, url, text, n_chars.

    A null or empty html, and a page without an article, have an empty text.
    """
    batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(trees or model())

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(parts, "html"):
            found = texts(b.column("html").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")

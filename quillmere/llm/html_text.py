"""Main-text extraction by a tree-structured graphical model over DOM nodes.

Each block-level node has a hidden label, content or not. A node's own evidence (tag, words of class
and id, text and link shares) and potentials between parent and child give a tree-shaped
conditional random field; sum-product messages up and then down yield each node's content
marginal. Weights are learned by gradient on labelled pages: the empirical less the expected statistics, which
the same messages give. All pages of a batch are one forest, passed level by level in numpy.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillmere.llm.common import arrow_map, keep, text_list

#: HTML's void elements, elements whose text isn't markup, elements never shown as text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER = frozenset("head script style title textarea noscript template svg math iframe object select option datalist button canvas audio video map noembed noframes xmp".split())
#: Elements within a line of text; all others begin and end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
#: Elements whose start ends an open paragraph, and what else ends an open element of the same sort.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}
SCOPE = frozenset("td th table button caption object html body".split())

#: Words of class, id and role by what they speak of.
SAYS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toc tabs pagination pager toolbar skip",
    "edge": "header head masthead top footer foot bottom copyright legal colophon banner contentinfo",
    "side": "sidebar side aside rail widget widgets secondary complementary column",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted dfp adsense teaser",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay banner warning message toast disclaimer privacy",
    "form": "form search searchbox login signin signup register newsletter subscribe subscription contact poll",
    "social": "share sharing social follow related recommended recommendations more tags tag meta byline author trending popular",
    "comment": "comment comments commentlist disqus reply replies respond discussion thread responses reviews",
    "content": "article content post entry story main body text page single hentry prose blog news paragraph",
}
WORD_SAYS = {w: k for k, words in reversed(SAYS.items()) for w in words.split()}
TAGS = {t: i for i, t in enumerate("other p div section article main header footer nav aside form ul ol li h1 h2 h3 table td blockquote pre figure figcaption dl body html".split())}
SAY = {s: i for i, s in enumerate(SAYS)}
EDGES = {"article": 1, "main": 1, "section": 2, "div": 2, "body": 2, "html": 2, "td": 2, "tr": 2, "table": 2, "p": 3, "h1": 3, "h2": 3, "h3": 3, "h4": 3, "blockquote": 3, "pre": 3}

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z][^>]*>""", re.S)
#: One attribute: its whole name, and its value if there is one.
ATTR = re.compile(r"""(=?[^\s/>=]++|=)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s>]++))?""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Elements nested deeper than this become siblings there, as in browsers; their text stays in its place.
MAX_DEPTH = 512
_close = {t: re.compile(f"</{t}(?=[\\s/>])", re.I) for t in RAW}


class Page:
    """Nodes in page order: tag, parent (-1: none), words of class and id, label if the page has labels; pieces of text as
    (node, text, within a link). A break between blocks is a piece without text. Labels (data-y) are read for training only."""

    def __init__(self, source: str, labelled: bool = True):
        self.labelled = labelled
        self.tag, self.parent, self.says, self.never, self.label = ["#page"], [-1], [()], [False], [-1]
        self.depth = [0]
        self.pieces: list[tuple[int, str | None, bool]] = []
        stack: list[tuple[str, int, bool]] = [("#page", 0, False)]
        self._open: dict[str, list[int]] = {}  # places in the stack by name, and of blocks other than paragraphs
        self._blocks: list[int] = []
        # beyond the last end of a tag there is none, and nothing to look for
        at, n, tags_end = 0, len(source), source.rfind(">")
        while at < n:
            if at > tags_end:
                open_ = source.find("<!--", at)
                self._text(stack, source[at : open_ if open_ >= 0 else n])
                break
            m = TAG.search(source, at)
            to = m.start() if m else n
            if to > at:
                self._text(stack, source[at:to])
            if not m:
                break
            at = m.end()
            if m[0].startswith("<![CDATA["):
                self._text(stack, html.escape(m[0][9:-3], False))
                continue
            if m[2] is None:
                continue
            name = m[2].lower()
            if m[1]:
                self._end(stack, name)
                continue
            self._start(stack, name, m[3])
            if name in RAW:
                c = _close[name].search(source, at)
                to = c.start() if c else n
                at = n if not c else source.find(">", to) + 1 or n
                if stack[-1][0] == name:
                    self._off(stack)

    def _text(self, stack, text: str) -> None:
        self.pieces.append((stack[-1][1], text, stack[-1][2]))

    def _break(self, stack) -> None:
        self.pieces.append((stack[-1][1], None, False))

    def _start(self, stack, name: str, attrs: str) -> None:
        if name in ENDS_P:
            self._close_to(stack, {"p"}, SCOPE)
        if name in ENDS:
            self._close_to(stack, *ENDS[name])
        if name in VOID:
            if name in ("br", "hr"):
                self._break(stack)
            return
        words, hidden, label = [], False, -1
        for a in ATTR.finditer(attrs) if attrs.strip() else ():
            key, value = a[1].lower(), a[2] or ""
            if value[:1] in ("'", '"') and value[-1] == value[0]:
                value = value[1:-1]
            if key == "hidden" or key == "style" and re.search(r"display\s*:\s*none", value):
                hidden = True
            elif key == "data-y" and self.labelled:
                label = int(value)
            elif key in ("class", "id", "role", "itemprop"):
                words += [w.lower() for w in WORDS.findall(value)]
        says = {WORD_SAYS[w] for w in words if w in WORD_SAYS}
        block = name not in INLINE
        link = stack[-1][2] or name == "a"
        if block:
            self._break(stack)
        node = stack[-1][1]
        if block or says or hidden:
            up = node if self.depth[node] < MAX_DEPTH else self.parent[node]
            # what is never shown stays so for all below it, however deep
            self.tag.append(name), self.parent.append(up), self.says.append(tuple(says)), self.depth.append(self.depth[up] + 1)
            self.never.append(name in NEVER or hidden or self.never[node]), self.label.append(label)
            node = len(self.tag) - 1
        self._open.setdefault(name, []).append(len(stack))
        if block and name != "p":
            self._blocks.append(len(stack))
        stack.append((name, node, link))
        if block:
            self._break(stack)

    def _off(self, stack) -> tuple[str, int, bool]:
        """Takes the last element off the stack."""
        top = stack.pop()
        self._open[top[0]].pop()
        if self._blocks and self._blocks[-1] == len(stack):
            self._blocks.pop()
        return top

    def _to(self, stack, place: int) -> None:
        """Ends the elements from this place in the stack on."""
        while len(stack) > place:
            name, node, _ = self._off(stack)
            if name not in INLINE:
                self.pieces.append((node, None, False))

    def _last(self, names) -> int:
        """The last place in the stack of an element of one of these names; 0 if none is open."""
        return max((self._open[n][-1] for n in names if self._open.get(n)), default=0)

    def _close_to(self, stack, names, stops) -> None:
        """Ends the last element of these names, unless a stop has begun since."""
        if (i := self._last(names)) and i >= self._last(stops):
            self._to(stack, i)

    def _end(self, stack, name: str) -> None:
        if name == "br":
            self._break(stack)
        elif (i := self._last((name,))) and not (name in INLINE and self._blocks and self._blocks[-1] > i):
            self._to(stack, i)


N_FEATURES = len(TAGS) + len(SAY) + 5 + 4 + 4 + 3 + 3


def evidence(page: Page) -> np.ndarray:
    """Rows of features of a page's nodes."""
    n = len(page.tag)
    own, stops, linked, copy = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n, bool)
    for node, text, link in page.pieces:
        if text and not page.never[node]:
            size = len(text.strip())
            own[node] += size
            stops[node] += text.count(". ") + text.endswith(".") + text.count(", ")
            if link:
                linked[node] += size
            if "©" in text or "&copy" in text:
                copy[node] = True
    total, links = own.copy(), linked.copy()
    for i in range(n - 1, 0, -1):
        total[page.parent[i]] += total[i]
        links[page.parent[i]] += links[i]
    x = np.zeros((n, N_FEATURES), np.float32)
    rows, k = np.arange(n), 0
    x[rows, [TAGS.get(t, 0) for t in page.tag]] = 1
    k += len(TAGS)
    for i, says in enumerate(page.says):
        for s in says:
            x[i, k + SAY[s]] = 1
    k += len(SAY)
    x[rows, k + np.digitize(own, [1, 25, 80, 250])] = 1
    k += 5
    x[rows, k + np.digitize(links / np.maximum(total, 1), [0.01, 0.3, 0.6])] = 1
    k += 4
    x[rows, k + np.digitize(total / max(1.0, total[0]), [0.05, 0.2, 0.5])] = 1
    k += 4
    x[rows, k + np.digitize(stops, [1, 4])] = 1
    k += 3
    x[:, k], x[:, k + 1], x[:, k + 2] = copy, total == 0, 1
    return x


class Forest:
    """Pages as one forest: evidence rows, parents, depths and edge kinds."""

    def __init__(self, pages: list[Page]):
        parent, base = [], 0
        for p in pages:
            parent += [q + base if q >= 0 else -1 for q in p.parent]
            base += len(p.parent)
        self.parent = np.array(parent, np.int64)
        self.x = np.concatenate([evidence(p) for p in pages]) if pages else np.zeros((0, N_FEATURES), np.float32)
        self.never = np.array([v for p in pages for v in p.never], bool)
        self.edge = np.array([EDGES.get(t, 0) for p in pages for t in p.tag], np.int64)
        depth = np.array([d for p in pages for d in p.depth], np.int64)
        by_depth = np.argsort(depth, kind="stable")
        self.levels = np.split(by_depth, np.searchsorted(depth[by_depth], np.arange(1, int(depth.max(initial=0)) + 1)))

    def marginals(self, weights: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(P(content) of each node, P(parent's label, own label) of each node that has a parent)."""
        n = len(self.parent)
        up = np.zeros((n, 2))
        up[:, 1] = self.x @ weights
        up[self.never, 1] = -30.0
        sent = np.zeros((n, 2))
        phi = pair[self.edge]  # [node, parent's label, own label]
        for at in reversed(self.levels[1:]):
            t = phi[at] + up[at][:, None, :]
            sent[at] = np.logaddexp(t[:, :, 0], t[:, :, 1])
            np.add.at(up, self.parent[at], sent[at])
        belief, joint = up.copy(), np.zeros((n, 2, 2))
        for at in self.levels[1:]:
            out = belief[self.parent[at]] - sent[at]
            t = phi[at] + up[at][:, None, :] + out[:, :, None]
            m = t.reshape(-1, 4).max(1)[:, None, None]
            e = np.exp(t - m)
            joint[at] = e / e.sum((1, 2), keepdims=True)
            belief[at] = m[:, :, 0] + np.log(e.sum(1))
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -60, 60))), joint


def fit(pages: list[Page], steps: int = 150, rate: float = 0.15, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """(weights, pair potentials) by Adam on the likelihood of the labels of whole trees.

    Nodes without a label take the label that most of the text below them has.
    """
    f = Forest(pages)
    y = np.array([v for p in pages for v in p.label])
    size, good = np.zeros(len(y)), np.zeros(len(y))
    base = 0
    for p in pages:
        for node, text, _ in p.pieces:
            if text:
                size[base + node] += len(text.strip())
        base += len(p.tag)
    for i in range(len(y)):  # a node without a label of its own starts from its parent's
        if y[i] < 0 and f.parent[i] >= 0 and y[f.parent[i]] >= 0:
            y[i] = y[f.parent[i]]
    good = size * (y == 1)
    for i in range(len(y) - 1, -1, -1):
        if f.parent[i] >= 0:
            size[f.parent[i]] += size[i]
            good[f.parent[i]] += good[i]
    y = np.where(y >= 0, y, 2 * good > size).astype(int)
    y[f.never] = 0
    use = ~f.never
    par = [np.zeros(N_FEATURES), np.zeros((4, 2, 2))]
    one, two = [np.zeros_like(v) for v in par], [np.zeros_like(v) for v in par]
    child = np.flatnonzero((f.parent >= 0) & use)
    seen = np.zeros((4, 2, 2))
    np.add.at(seen, (f.edge[child], y[f.parent[child]], y[child]), 1)
    for step in range(1, steps + 1):
        p, joint = f.marginals(*par)
        expected = np.zeros((4, 2, 2))
        np.add.at(expected, f.edge[child], joint[child])
        grad = [(f.x[use].T @ (y - p)[use]) / len(y) - ridge * par[0], (seen - expected) / len(y) - ridge * par[1]]
        for v, g, a, b in zip(par, grad, one, two):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            v += rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return par[0], par[1]


def labelled_pages(n: int = 500, seed: int = 5) -> list[str]:
    """Pages made for training; data-y marks blocks as content (1) or not (0). Layouts, names and texts vary."""
    rng = np.random.default_rng(seed)
    pick = lambda *a: a[int(rng.integers(len(a)))]

    def words(k: int) -> str:
        return " ".join("".join(pick("ka", "lo", "mi", "ren", "tas", "u", "vor", "si", "é") for _ in range(int(rng.integers(1, 4)))) for _ in range(k))

    def sentence() -> str:
        s = words(int(rng.integers(3, 16)))
        return s.capitalize() + pick(".", ".", ".", "!", "?", ", " + words(4) + ".")

    def text(lo: int, hi: int) -> str:
        return " ".join(sentence() for _ in range(int(rng.integers(lo, hi))))

    def links(k: int) -> str:
        return "".join(f'<li><a href="/{i}">{words(int(rng.integers(1, 4)))}</a></li>' for i in range(k))

    def attr(*names: str) -> str:
        return pick("", f' class="{pick(*names)}"', f' class="{pick(*names)} x{int(rng.integers(9))}"', f' id="{pick(*names)}"') if rng.random() < 0.9 else ""

    def boiler() -> list[str]:
        named = lambda *names: f' class="{pick(*names)}"' if rng.random() < 0.6 else f' id="{pick(*names)}"'
        return [
            f'<nav data-y="0"{attr("nav", "menu", "navigation")}><ul>{links(int(rng.integers(3, 9)))}</ul></nav>',
            f'<div data-y="0"{named("menu", "navbar", "breadcrumbs", "top-nav")}><ul>{links(int(rng.integers(2, 8)))}</ul></div>',
            f'<header data-y="0"{attr("header", "site-header", "masthead")}>{pick("<h1>", "<p>", "<div>")}{words(3)}<ul>{links(int(rng.integers(0, 4)))}</ul></header>',
            f'<aside data-y="0"{attr("sidebar", "aside", "widget")}><h3>{words(2)}</h3><p>{text(1, 5)}</p><ul>{links(int(rng.integers(0, 5)))}</ul></aside>',
            f'<div data-y="0"{named("sidebar", "side", "right-rail", "widget-area")}><p>{text(1, 6)}</p></div>',
            f'<div data-y="0"{named("ad", "ads", "advert", "sponsored", "promo", "ad-slot")}>{pick("", "<p>")}{text(1, 3)}</div>',
            f'<div data-y="0"{named("cookie", "cookie-notice", "consent", "notice", "alert", "popup")}>{pick("", "<p>")}{text(1, 4)}<button>{words(1)}</button></div>',
            f'<form data-y="0"{attr("search", "newsletter", "login")}><label>{words(2)}</label><p>{text(0, 3)}</p><input type="text"><button>{words(1)}</button></form>',
            f'<div data-y="0"{named("newsletter", "subscribe", "signup")}><p>{text(1, 3)}</p><form><input></form></div>',
            f'<div data-y="0"{named("related", "share", "social", "recommended", "tags")}><ul>{links(int(rng.integers(2, 7)))}</ul></div>',
            f'<footer data-y="0"{attr("footer", "site-footer")}>{pick("&copy; ", "", "© ")}{text(1, 3)}</footer>',
            f'<div data-y="0"{named("footer", "copyright", "bottom")}><p>&copy; {text(1, 3)}</p></div>',
        ]

    def comments() -> str:
        one = lambda: pick(f'<div class="comment"><p>{text(1, 6)}</p></div>', f'<li class="comment"><b>{words(1)}</b><p>{text(1, 5)}</p></li>', f'<article class="comment"><p>{text(1, 5)}</p></article>', f"<p>{text(1, 4)}</p>")
        body = "".join(one() for _ in range(int(rng.integers(1, 7))))
        return f'<{(t := pick("section", "div", "ol", "ul"))} data-y="0" {pick("class", "id")}="{pick("comments", "comment-list", "discussion", "responses", "reader-comments")}"><h3>{words(2)}</h3>{body}</{t}>'

    out = []
    for _ in range(n):
        parts = [f"<{pick('h1', 'h1', 'h2')}>{words(int(rng.integers(2, 9)))}</h1>"] if rng.random() < 0.8 else []
        parts[:] = [p.replace("</h1>", f"</{p[1:3]}>") for p in parts]
        for _ in range(int(rng.integers(1, 12))):
            r = rng.random()
            parts.append(
                f"<ul>{''.join(f'<li>{sentence()}</li>' for _ in range(int(rng.integers(1, 5))))}</ul>" if r < 0.08
                else f"<blockquote><p>{text(1, 4)}</p></blockquote>" if r < 0.14
                else f"<h{int(rng.integers(2, 5))}>{words(4)}</h3>".replace("</h3>", "") + f"<p>{text(1, 5)}</p>" if r < 0.22
                else f"<table><tr><td>{words(2)}</td><td>{sentence()}</td></tr></table>" if r < 0.26
                else f"<pre>{words(8)}</pre>" if r < 0.29
                else f"<div>{text(1, 5)}</div>" if r < 0.36
                else f"<p><b>{text(1, 3)}<br><p>{text(1, 6)}</p>" if r < 0.45
                else f'<p>{text(1, 3)} <a href="#">{words(3)}</a> {text(0, 3)}</p>' if r < 0.6
                else f"<p>{text(1, 9)}</p>"
            )
        if rng.random() < 0.3:  # a short article, perhaps of odd words without stops
            odd = pick(sentence(), sentence(), (words(1) + " ") * int(rng.integers(2, 90)), " | ".join(words(2) for _ in range(9)), words(int(rng.integers(1, 40))))
            parts = [*parts[: int(rng.integers(0, 2))], pick("<p>", "<p><b>") + odd + pick("", "</p>", f"<br><p>{words(3)}</p>")]
        if rng.random() < 0.15:  # verse, or a list without marks: many short paragraphs, perhaps the same again
            own = [words(int(rng.integers(1, 4))) + pick("", ".") for _ in range(int(rng.integers(1, 4)))]
            parts.insert(int(rng.integers(len(parts) + 1)), "".join(f"<p>{pick(*own)}</p>" for _ in range(int(rng.integers(5, 120)))))
        inside = boiler()
        for _ in range(int(rng.integers(0, 3))):
            parts.insert(int(rng.integers(len(parts) + 1)), inside[int(rng.choice([5, 6, 8, 9, 3]))])
        if rng.random() < 0.2:
            parts.append(comments())
        kind = rng.random()
        body = "".join(parts)
        body = (f'<article data-y="1"{attr("post", "entry", "article")}>{body}</article>' if kind < 0.5
                else f'<main data-y="1"{attr("content", "main")}>{body}</main>' if kind < 0.65
                else f'<main><article data-y="1">{body}</article></main>' if kind < 0.75
                else f'<div data-y="1" {pick("class", "id")}="{pick("content", "article-body", "post", "entry-content", "story", "main-content")}">{body}</div>' if kind < 0.92
                else f'<div data-y="1">{body}</div>')
        around = boiler()
        before = [around[i] for i in rng.choice([0, 1, 2, 5, 6, 7], int(rng.integers(1, 4)), False)]
        after = [around[i] for i in rng.choice([3, 4, 5, 8, 9, 10, 11, 10], int(rng.integers(1, 4)), False)]
        if rng.random() < 0.4:
            after.insert(0, comments())
        page = "".join(before) + body + "".join(after)
        if rng.random() < 0.3:
            page = f"<div{attr('wrapper', 'page', 'container')}>{page}</div>"
        out.append(f"<!DOCTYPE html><html><head><title>{words(3)}</title><style>p{{}}</style></head><body>{page}<script>var a=1;</script></body></html>")
    return out


@lru_cache(maxsize=1)
def trained() -> tuple[np.ndarray, np.ndarray]:
    """The model, trained where it is first needed; the same everywhere."""
    return fit([Page(s) for s in labelled_pages()])


def extract(sources: list[str], model: tuple[np.ndarray, np.ndarray], threshold: float = 0.5) -> list[tuple[str, float]]:
    """(main text, its lowest block marginal) of each page."""
    out: list[tuple[str, float]] = []
    for lo in range(0, len(sources), 100):
        pages = [Page(s, labelled=False) for s in sources[lo : lo + 100]]
        f = Forest(pages)
        p, _ = f.marginals(*model)
        base = 0
        for page in pages:
            blocks, now, least = [], [], 1.0
            for node, text, _ in page.pieces:
                if text is None:
                    if now:
                        blocks.append("".join(now))
                        now = []
                elif p[base + node] >= threshold:
                    now.append(text)
                    if not text.isspace():
                        least = min(least, float(p[base + node]))
            if now:
                blocks.append("".join(now))
            base += len(page.tag)
            text = " ".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
            out.append((text, least if text else 0.0))
    return out


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """page_id, url, text, n_chars, least_marginal of each row of pages.

    text: blocks of nodes whose content marginal is at least one half, in page order, white space made one space; a marginal of
    exactly one half is content. Null or empty html, and pages without content, give an empty text; pages of any length and depth are
    read whole. Null ids and urls stay; repeated rows give a row each; other
    columns are left out; an empty table gives none.
    """
    model = model or trained()

    def run(b: pa.RecordBatch) -> dict:
        got = extract(text_list(b.column("html")), model)
        return {"page_id": b.column("page_id"), "url": b.column("url"), "text": [t for t, _ in got], "n_chars": [len(t) for t, _ in got], "least_marginal": [m for _, m in got]}

    return arrow_map(keep(pages, page_id=id_col, url=url_col, html=html_col), run, "page_id long, url string, text string, n_chars long, least_marginal double")

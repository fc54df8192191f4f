"""Main text of web pages by a tree-structured graphical model over their DOM.

Each block element of a page is a binary variable: content or not. Its own
features (element name, words in class and id, whether it holds text, share of
linked text) give a unary potential, and each parent-child pair a pairwise potential
by the kind of the child. Messages are passed from the leaves to the root and
back (sum-product), which on a tree gives exact marginals; a block belongs to
the main text if its marginal is above one half. The potentials are trained by
maximum likelihood (the same message passing gives the gradient) on labelled
pages composed from common page layouts.

Text: character references decoded, white space inside a block turned into one
space, trimmed, blocks joined in page order by one line feed. Scripts, styles,
form controls and the head never hold text.

Defined results: null or empty html gives the empty text and 0 characters;
html without any tag is one content block; broken or cut markup is read as far
as it goes: a skipped element (one that never holds text, or a hidden one) that
closes itself is empty, one whose end tag HTML lets out ends where HTML ends
it, and of one that just has no end only the start tag is skipped (of a script
or style sheet what comes before the next block); repeated rows get equal results; an empty table gives an empty
result; other columns are not read. Nesting is followed without recursion.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from clientele.llm.common import as_text, with_long

_BLOCKS = frozenset(  # fixed values: block elements of HTML
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table "
    "caption tbody td tfoot th thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())  # fixed values
_RAW = frozenset("script style textarea title noscript template iframe object svg math select option button canvas audio "
                 "video head".split())  # no text of the page
_CLOSED_BY = {  # an open element on the left ends where one on the right starts
    "p": _BLOCKS - {"body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
_ENDS_BY = _CLOSED_BY | {"option": {"option", "optgroup"}, "optgroup": {"optgroup"}}  # likewise, for elements that are skipped
_END_LEFT_OUT = frozenset("option optgroup p li dt dd tr td th thead tbody tfoot caption".split())  # they end with their parent
_HOLDERS = _BLOCKS | _RAW | {"datalist", "optgroup"}  # their end tags end all that is open in them
_TEXT_ONLY = frozenset("script style textarea title iframe".split())  # markup inside is text
_LEXER = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>]+))?")
_MAYBE_HIDDEN = re.compile("hidden|display", re.I)
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_OPEN_VALUE = re.compile(r"=\s*[^\s\"'][^\s\"']*\Z")  # a slash at its end belongs to the value
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_KNOWN = {  # words in class, id or role, by what they tell
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toc pagination pager tabs toolbar skip links",
    "frame": "header masthead banner footer foot copyright colophon topbar logo branding contentinfo",
    "side": "sidebar side aside complementary widget widgets rail related recommended popular trending archive tags tagcloud",
    "ad": "ad ads advert advertisement adverts adsense sponsor sponsored promo promoted promotion teaser outbrain",
    "notice": "notice cookie cookies consent gdpr alert warning popup modal overlay newsletter subscribe subscription signup login",
    "talk": "comment comments commentlist reply replies discussion disqus respond reviews thread",
    "form": "form search searchbox share sharing social buttons feedback poll survey",
    "main": "content article main post entry story text body page prose markdown column",
}
_MEANS = {w: k for k, words in _KNOWN.items() for w in words.split()}


class Node:
    __slots__ = ("name", "kinds", "parent", "blocks", "chars", "linked")

    def __init__(self, name: str, kinds: tuple[str, ...], parent: int):
        self.name, self.kinds, self.parent = name, kinds, parent
        self.blocks: list[int] = []
        self.chars = self.linked = 0


def _kinds(rest: str) -> tuple[str, ...]:
    found = {_MEANS[t.lower()] for m in _NAMED.finditer(rest) for t in _TOKEN.findall(m[1]) if t.lower() in _MEANS}
    return tuple(sorted(found))


def _hidden(rest: str) -> bool:
    """Whether the attributes hide an element from readers."""
    if not _MAYBE_HIDDEN.search(rest):
        return False
    for m in _ATTRIBUTE.finditer(rest):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if (name == "hidden" or name == "style" and _NO_DISPLAY.search(html.unescape(value))
                or name == "aria-hidden" and value.strip().lower() == "true"):
            return True
    return False


def _closes_itself(rest: str) -> bool:
    return rest.endswith("/") and not _OPEN_VALUE.search(rest)


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block elements in page order (parents first) and the text runs as (node, text)."""
    nodes, runs = [Node("root", (), -1)], []
    open_: list[tuple[str, int]] = [("root", 0)]  # every open element with its block node
    count: dict[str, int] = {}  # open elements by name, the root left out
    blocks: list[int] = []  # places of the open blocks in open_
    parts: list[str] = []
    at = 0
    text_ends = _TextEnds(page)
    ends: dict[int, int] | None = None

    def pop() -> str:
        name = open_.pop()[0]
        count[name] -= 1
        if name in _BLOCKS:
            blocks.pop()
        return name

    def push(name: str, node: int) -> None:
        if name in _BLOCKS:
            blocks.append(len(open_))
        open_.append((name, node))
        count[name] = count.get(name, 0) + 1

    def flush() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            nodes[open_[-1][1]].chars += len(text)
            runs.append((open_[-1][1], text))

    def add(raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if count.get("a"):
            nodes[open_[-1][1]].linked += len(text.strip())

    while at < len(page):
        m = _LEXER.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        rest = m["rest"] or m["rest2"] or ""
        if not name:
            continue
        if m["close"] or m["close2"]:
            if count.get(name):
                if name in _BLOCKS:
                    flush()
                while pop() != name:
                    pass
            elif name == "p":
                flush()
        elif name in _RAW or name not in _VOID and name != "body" and name != "html" and _hidden(rest):
            if name in _TEXT_ONLY or name == "head":
                at = _skip(text_ends, at, name, _closes_itself(rest))
            elif not _closes_itself(rest):
                if ends is None:
                    ends = _ends(text_ends)
                at = ends.get(at, at)
        elif name in _VOID:
            if name == "hr":
                flush()
            elif name in ("br", "wbr"):
                parts.append(" " if name == "br" else "")
        else:
            if name in _BLOCKS:
                flush()
                while blocks and name in _CLOSED_BY.get(open_[blocks[-1]][0], ()):
                    inner = blocks[-1]
                    while len(open_) > inner:
                        pop()
                nodes.append(Node(name, _kinds(rest), open_[-1][1]))
                push(name, len(nodes) - 1)
            elif not rest.endswith("/"):
                push(name, open_[-1][1])
    flush()
    return nodes, runs


class _TextEnds:
    """Finds the end tags of elements whose content is text alone. Each search is remembered, as the next element of
    the name often ends at the same tag or, as that one, nowhere.
    """

    def __init__(self, page: str):
        self.page = page
        self.found: dict[str, tuple[int, int, int]] = {}  # searched from, start of the tag, place after it

    def after(self, at: int, name: str) -> int:
        """The place after the first end tag from ``at`` on; -1 if there is none."""
        begin, start, end = self.found.get(name, (0, -1, -1))
        if not begin <= at <= start:
            m = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(self.page, at)
            start, end = m.span() if m else (len(self.page), -1)
            self.found[name] = at, start, end
        return end


_BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(_BLOCKS - {'html'}))}|head)(?=[\s/>])", re.I)


def _skip(text_ends: _TextEnds, at: int, name: str, closed: bool) -> int:
    """The place after the end of an element whose content is text alone or the head's; ``at`` if it has no end."""
    if closed and name not in ("script", "style"):
        return at
    page, end = text_ends.page, text_ends.after(at, name)
    if end >= 0 and (closed or name == "iframe"):  # HTML overlooks the slash, XHTML does not: the next start tag tells
        start = re.compile(rf"<{name}(?=[\s/>])", re.I).search(page, at, end)
        end = -1 if start else end
    if end >= 0 or closed or name not in ("script", "style"):
        return end if end >= 0 else at
    block = _BLOCK_TAG.search(page, at)  # code is never text of the page
    return block.start() if block else len(page)


def _ends(text_ends: _TextEnds) -> dict[int, int]:
    """For each element by the place after its start tag, where it ends: its own end tag or where HTML implies it.
    Elements without an end are left out. One pass over the tags.
    """
    page = text_ends.page
    out: dict[int, int] = {}
    open_: list[tuple[str, int] | None] = []  # None where an inline element ended before those opened after it
    places: dict[str, list[int]] = {}  # places of the open elements in open_, by name
    holders: list[int] = []  # those of the holders

    def pop(place: int) -> None:
        last = open_.pop()
        if last is None:
            return
        name, begin = last
        places[name].pop()
        if name in _HOLDERS:
            holders.pop()
        if name in _END_LEFT_OUT:
            out[begin] = place

    at = 0
    while m := _LEXER.search(page, at):
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        rest = m["rest"] or m["rest2"] or ""
        if not name or name in _VOID:
            continue
        if m["close"] or m["close2"]:
            if not places.get(name):
                continue
            i = places[name][-1]
            begin = open_[i][1]
            if name in _HOLDERS:
                while len(open_) > i:
                    pop(m.start())
            else:  # inline elements may overlap
                places[name].pop()
                open_[i] = None
            out[begin] = at
            continue
        if name in _TEXT_ONLY:
            at = _skip(text_ends, at, name, _closes_itself(rest))
            continue
        if _closes_itself(rest) and (name in _RAW or _hidden(rest)):
            continue
        while holders and name in _ENDS_BY.get(open_[holders[-1]][0], ()):
            inner = holders[-1]
            while len(open_) > inner:
                pop(m.start())
        places.setdefault(name, []).append(len(open_))
        if name in _HOLDERS:
            holders.append(len(open_))
        open_.append((name, at))
    while open_:
        pop(len(page))
    return out


_NAMES = ("article main section div p h1 h2 h3 h4 h5 h6 li ul ol dl dd dt nav header footer aside form fieldset table tr td th blockquote pre "
          "figure figcaption address body html root details summary").split()
_UNARY = {f: i for i, f in enumerate(
    [f"name:{n}" for n in _NAMES] + ["name:other"] + [f"kind:{k}" for k in _KNOWN] +
    [f"chars:{i}" for i in range(2)] + [f"links:{i}" for i in range(3)] + ["bias"])}
_CHILD_KINDS = ("block", "list", "frame", "named")


def _unary(node: Node) -> list[int]:
    found = [f"name:{node.name if node.name in _NAMES else 'other'}", "bias", *(f"kind:{k}" for k in node.kinds)]
    found.append(f"chars:{min(1, node.chars)}")
    found.append(f"links:{0 if not node.linked else 1 if 2 * node.linked < node.chars else 2}")
    return [_UNARY[f] for f in found]


def _child_kind(node: Node) -> int:
    if node.kinds:
        return 3
    return 2 if node.name in ("nav", "header", "footer", "aside", "form") else 1 if node.name in ("ul", "ol", "li", "dl", "dd", "dt", "tr", "td") else 0


class TreeModel:
    """unary: weight of content per feature; pair: log potential [kind of child, state of parent, state of child]."""

    def __init__(self, unary: np.ndarray, pair: np.ndarray):
        self.unary, self.pair = unary, pair

    def infer(self, nodes: list[Node]) -> tuple[list[float], list[list[float]], float]:
        """Marginal of content per node, pairwise marginals per node and its parent, log of the partition sum."""
        n = len(nodes)
        w, psi = self.unary, np.exp(self.pair).tolist()
        own = [[1.0, float(np.exp(min(30.0, max(-30.0, sum(w[f] for f in _unary(node))))))] for node in nodes]
        log_z = 0.0
        up: list[list[float]] = [[1.0, 1.0]] * n
        below = [list(o) for o in own]
        for i in range(n - 1, 0, -1):  # parents come first, so from the back children are done
            p, b = psi[_child_kind(nodes[i])], below[i]
            m0, m1 = p[0][0] * b[0] + p[0][1] * b[1], p[1][0] * b[0] + p[1][1] * b[1]
            s = m0 + m1
            log_z += float(np.log(s))
            up[i] = [m0 / s, m1 / s]
            q = below[nodes[i].parent]
            q[0] *= up[i][0]
            q[1] *= up[i][1]
            t = q[0] + q[1]
            log_z += float(np.log(t))
            q[0] /= t
            q[1] /= t
        log_z += float(np.log(below[0][0] + below[0][1]))
        belief = [list(b) for b in below]
        pairs: list[list[float]] = [[0.0] * 4] * n
        for i in range(n):
            if i:
                parent, p = belief[nodes[i].parent], psi[_child_kind(nodes[i])]
                rest = [parent[0] / max(up[i][0], 1e-300), parent[1] / max(up[i][1], 1e-300)]
                joint = [rest[a] * p[a][c] * below[i][c] for a in (0, 1) for c in (0, 1)]
                s = sum(joint)
                pairs[i] = [x / s for x in joint]
                belief[i] = [pairs[i][0] + pairs[i][2], pairs[i][1] + pairs[i][3]]
            else:
                s = belief[0][0] + belief[0][1]
                belief[0] = [belief[0][0] / s, belief[0][1] / s]
        return [b[1] for b in belief], pairs, log_z


def fit(pages: list[tuple[list[Node], list[int]]], steps: int = 80, rate: float = 0.3, penalty: float = 1e-3) -> TreeModel:
    """Maximum likelihood by Adam; the gradient is observed minus expected features."""
    model = TreeModel(np.zeros(len(_UNARY)), np.zeros((len(_CHILD_KINDS), 2, 2)))
    moments = [np.zeros(len(_UNARY)), np.zeros(len(_UNARY)), np.zeros((4, 2, 2)), np.zeros((4, 2, 2))]
    feats = [[_unary(node) for node in nodes] for nodes, _ in pages]
    for step in range(1, steps + 1):
        gu, gp = -penalty * model.unary * len(pages), -penalty * model.pair * len(pages)
        for (nodes, labels), unary in zip(pages, feats):
            belief, pairs, _ = model.infer(nodes)
            for i, node in enumerate(nodes):
                for f in unary[i]:
                    gu[f] += labels[i] - belief[i]
                if i:
                    k = _child_kind(node)
                    gp[k] -= np.array(pairs[i]).reshape(2, 2)
                    gp[k][labels[node.parent]][labels[i]] += 1
        for x, g, a, b in ((model.unary, gu, *moments[:2]), (model.pair, gp, *moments[2:])):
            a[...] = 0.9 * a + 0.1 * g
            b[...] = 0.99 * b + 0.01 * g * g
            x += rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return model


# --- composed labelled pages -----------------------------------------------------------------------------------------

_MARK = "\u0001"  # starts each text that belongs to the article


def _words(rng: random.Random, low: int, high: int) -> str:
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(low, high)))


def _labelled_page(rng: random.Random) -> str:
    w = lambda a=1, b=8: _words(rng, a, b)
    links = lambda n: "".join(f'<li><a href="/{w(1, 1)}">{w(1, 3)}</a></li>' for _ in range(n))
    para = lambda: f"<p>{_MARK}{(w(1, 120) + ' ') * rng.choice([1, 1, 1, 1, 8, 90])}{rng.choice(['', ' <a href=x>' + w(1, 3) + '</a> ' + w(1, 30)])}</p>"
    inner = [f"<h1>{_MARK}{w(2, 10)}</h1>"]
    for _ in range(rng.randint(1, 8)):
        inner.append(rng.choice([
            para, para, para, lambda: f"<h2>{_MARK}{w(1, 6)}</h2>", lambda: f"<blockquote><p>{_MARK}{w(3, 40)}</p></blockquote>",
            lambda: f"<ul><li>{_MARK}{w(1, 15)}</li><li>{_MARK}{w(1, 15)}</li></ul>", lambda: f"<pre>{_MARK}{w(3, 30)}</pre>",
            lambda: f"<table><tr><td>{_MARK}{w(1, 4)}</td><td>{_MARK}{w(1, 4)}</td></tr></table>",
            lambda: f"<div><p>{_MARK}{w(5, 60)}</p></div>", lambda: f"<div>{_MARK}{w(5, 60)}</div>",
            lambda: f"<figure><figcaption>{_MARK}{w(2, 12)}</figcaption></figure>",
            lambda: f'<div class="ad">{w(2, 12)}</div>', lambda: f'<aside><p>{w(3, 20)}</p></aside>',
            lambda: f'<div class="share"><a href=s>{w(1, 2)}</a></div>',
            lambda: f'<div class="{rng.choice(["related", "promo", "newsletter"])}"><h3>{w(1, 3)}</h3><ul>{links(3)}</ul></div>'])())
    comment = lambda: f'<div class="comment"><p>{w(3, 40)}</p></div>'
    talk = rng.choice(["", "", f'<section class="comments" id="comments"><h3>{w(1, 2)}</h3>{comment()}{comment()}</section>',
                       f'<div id="comments"><ol class="commentlist"><li><p>{w(3, 40)}</p></li></ol></div>'])
    body = "".join(inner)
    article = rng.choice([f"<article>{body}</article>", f"<article>{body}{talk}</article>", body,
                          f"<main><article>{body}</article>{talk}</main>", f"<main>{body}</main>",
                          f'<div class="{rng.choice(["content", "post", "entry-content", "article-body", "story"])}">{body}</div>',
                          f'<div id="main"><div class="post">{body}</div>{talk}</div>'])
    before = [rng.choice([f"<nav><ul>{links(rng.randint(2, 8))}</ul></nav>", f'<div class="menu"><ul>{links(4)}</ul></div>',
                          f'<ul id="nav">{links(4)}</ul>']),
              rng.choice(["", f"<header><h2>{w(1, 4)}</h2><p>{w(2, 8)}</p></header>", f'<div id="header"><a href="/">{w(1, 3)}</a></div>']),
              rng.choice(["", f'<div class="ad">{w(2, 30)}</div>', f'<div class="cookie-notice"><p>{w(5, 25)}</p></div>',
                          f'<form action="s"><p>{w(1, 4)}</p></form>', f'<div class="banner">{w(2, 14)}</div>'])]
    after = [rng.choice(["", f"<aside><h3>{w(1, 3)}</h3><ul>{links(5)}</ul></aside>", f'<div class="sidebar"><p>{w(4, 40)}</p></div>']),
             rng.choice(["", talk if "comments" not in article else ""]),
             rng.choice(["", f'<div class="notice">{w(4, 20)}</div>', f'<div class="advert"><p>{w(3, 20)}</p></div>']),
             rng.choice([f"<footer>{w(2, 20)}</footer>", f"<footer><p>{w(2, 20)}</p></footer>", f'<div id="footer">{w(2, 12)}</div>'])]
    rng.shuffle(before)
    if rng.random() < 0.15:  # a fragment without html and body
        return "".join([before[1], article, *after[:2]])
    return f"<html><head><title>{w(2, 8)}</title></head><body>{''.join(before)}{article}{''.join(after)}</body></html>"


def labelled_pages(n: int, seed: int) -> list[tuple[list[Node], list[int]]]:
    """Composed pages with the label of each node: inside the smallest element that holds the whole article, and with article text at or below it."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        nodes, runs = parse(_labelled_page(rng))
        good = [0] * len(nodes)
        for at, text in runs:
            good[at] += text.startswith(_MARK)
        everything = sum(good)
        for i in range(len(nodes) - 1, 0, -1):
            good[nodes[i].parent] += good[i]
        whole = max(i for i, g in enumerate(good) if g == everything)
        out.append((nodes, [int(g > 0 and i >= whole) for i, g in enumerate(good)]))
    return out


@lru_cache(1)
def train(n: int = 150, seed: int = 5) -> TreeModel:
    return fit(labelled_pages(n, seed))


def main_text(page: str | None, model: TreeModel) -> str:
    if not page:
        return ""
    nodes, runs = parse(page)
    if len(nodes) == 1:
        return "\n".join(t for _, t in runs)
    content = model.infer(nodes)[0]
    return "\n".join(text for at, text in runs if content[at] > 0.5)


def extract(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) per page."""
    handle = pages.sparkSession.sparkContext.broadcast(model or train())  # a few hundred numbers

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [main_text(h, handle.value) for h in frame.html]
            yield pd.DataFrame({"page_id": frame.page_id, "url": frame.url, "text": texts,
                                "n_chars": [len(t) for t in texts]})

    schema = "page_id string, url string, text string, n_chars long"
    return with_long(pages.select(*as_text("page_id"), "url", "html").mapInPandas(batches, schema), "page_id")

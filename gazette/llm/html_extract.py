"""Main text of web pages by a tree-structured graphical model over the DOM.

Block-level elements and text blocks are nodes with a binary variable: a text block is main text, an element holds some.
Node potentials come from features (tag, words in class, id and role, camelCase split, text length, share of linked text in the block
and in the element's whole subtree, punctuation); every edge has a parent-child potential.  The graph is a tree, so one upward and one
downward sum-product pass give exact marginals; a block is kept when its marginal is one half or more.
Weights are trained by gradient ascent on the likelihood of labelled pages (``html_labelled``), with
the same two passes giving the expected feature counts.

A block is the text between block-level tags; inline tags and ``<br>`` stay inside it.  Character references are decoded, runs of
white space become one space, blocks are trimmed, and empty ones drop out.  Unclosed and misnested tags are taken the
way browsers do in the common cases (a new ``<p>`` ends the last one, stray end tags are ignored).

Defined cases: null or empty html, or a page without main text, gives an empty string and 0 characters; repeated rows give
repeated results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from typing import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.html_labelled import pages as labelled_pages

TOKEN = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*+>|(/?)([a-zA-Z][^\s/>]*+)(?:((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|([^>]*+)>))", re.S)
NAMED = re.compile(r"""\b(class|id|role|hidden|style|y)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
# fixed values: elements whose content is no text of the page, up to their end tag; inline elements, and void elements
RAW = frozenset("script style template textarea title iframe head".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var wbr br img input button noscript object "
                   "math semantics mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup "
                   "munder mover munderover mmultiscripts mprescripts none mtable mtr mtd maction".split())
# elements whose text is left out while they are open; a block-level start tag or the end of an element around them ends them as well
LEFT_OUT = frozenset("svg select annotation annotation-xml".split())
FOREIGN = frozenset("svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# a start tag of the key ends an open element of the values, up to the nearest of the stops
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
        "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
        "option": (("option",), ("select",))}

TAGS = {t: g for g, ts in {
    "article": "article", "main": "main", "nav": "nav menu", "header": "header", "footer": "footer address", "aside": "aside",
    "form": "form fieldset", "list": "ul ol dl", "item": "li dt dd", "para": "p pre blockquote", "head": "h1 h2 h3 h4 h5 h6",
    "box": "div section center figure", "cell": "table tbody thead tr td th", "page": "html body"}.items() for t in ts.split()}
WORDS = {
    "w_menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc skip tabs",
    "w_head": "header masthead logo tagline topbar",
    "w_foot": "footer copyright legal contentinfo imprint colophon",
    "w_side": "sidebar aside related widget complementary recommended popular trending mostread",
    "w_ad": "ad ads advert advertisement adverts banner sponsor sponsored promo promotion",
    "w_note": "notice cookie cookies consent alert popup modal dialog gdpr warning message",
    "w_form": "form search login newsletter subscribe signup",
    "w_talk": "comment comments commentlist respond reply replies discussion disqus feedback",
    "w_share": "share social sharing follow tags",
    "w_text": "article content post entry story text main body prose",
}
WORD = {w: g for g, ws in WORDS.items() for w in ws.split()}
FEATURES = (["bias_text", "bias_box"] + [f"t_{g}" for g in dict.fromkeys(TAGS.values())] + ["t_other"] + list(WORDS)
            + ["hidden", "len_0", "len_20", "len_80", "len_200", "linked", "half_linked", "ends", "comma", "copyright",
               "in_main", "out_main", "in_head", "in_item", "in_para", "linked_main", "b_linked", "b_prose", "b_short"])
INDEX = {f: k for k, f in enumerate(FEATURES)}
_SPLIT = re.compile(r"[^a-z]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_UNQUOTED = re.compile(r"=\s*[^\s\"'=]+/\Z")


class Node:
    __slots__ = ("parent", "feats", "text", "y", "main", "size", "linked")

    def __init__(self, parent: int, feats: list[int], text: str | None, y: int = 0, main: bool = False, linked: int = 0):
        self.parent, self.feats, self.text, self.y, self.main = parent, feats, text, y, main
        self.size, self.linked = len(text or ""), linked         # characters, of the whole subtree once a page is parsed


def _named(attrs: str) -> tuple[list[int], int]:
    """Feature numbers of class, id and role words and hidden attributes, and the training mark."""
    feats, y = set(), 0
    for name, *values in NAMED.findall(attrs):
        name, value = name.lower(), next((v for v in values if v), "")
        if name in ("class", "id", "role"):
            for w in _SPLIT.split(_HUMP.sub(" ", value).lower()):
                if w in WORD:
                    feats.add(INDEX[WORD[w]])
        elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value):
            feats.add(INDEX["hidden"])
        elif name == "y":
            y = 1
    return sorted(feats), y


def parse(page: str) -> list[Node]:
    """Nodes in page order, every parent before its children; text blocks are leaves with ``text``.

    A box without a telling name, like ``<div>``, is no node: what it holds hangs on the element around it.
    """
    nodes = [Node(-1, [INDEX["bias_box"]], None)]
    stack = [("", 0, 0)]                             # open elements: tag, node, training mark
    pieces: list[str] = []
    linked, in_link = 0, False
    has_main = False
    out, depth = "", 0                               # open element of LEFT_OUT, and how often it is open

    def flush():
        nonlocal linked
        if pieces:
            raw = "".join(pieces)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                tag, own, y = stack[-1]
                n = len(text)
                feats = [INDEX["bias_text"], INDEX["len_0" if n < 20 else "len_20" if n < 80 else "len_80" if n < 200 else "len_200"]]
                if linked * 2 > n:
                    feats.append(INDEX["linked" if linked * 10 >= n * 9 else "half_linked"])
                if text[-1] in ".!?:\"'”»)…":
                    feats.append(INDEX["ends"])
                if "," in text:
                    feats.append(INDEX["comma"])
                if "©" in text or "opyright" in text:
                    feats.append(INDEX["copyright"])
                group = TAGS.get(tag)
                if group in ("head", "item", "para"):
                    feats.append(INDEX[f"in_{group}"])
                nodes.append(Node(own, feats, text, y, nodes[own].main, min(linked, n)))
            pieces.clear()
        linked = 0

    at, size = 0, len(page)
    for m in iter(_tokens(page)):
        start, end, close, tag, attrs = m
        if start > at and not out:
            piece = page[at:start]
            pieces.append(piece)
            if in_link:
                linked += len(piece.strip())
        at = end
        if not tag:
            continue
        if out:
            if tag == out:
                depth += -1 if close else 0 if out != "select" and _empty(attrs) else 1
                out = out if depth else ""
                continue
            if tag not in TAGS or close and all(tag != t for t, _, _ in stack):
                continue
            out = ""
        elif tag in LEFT_OUT:
            if not close and (tag == "select" or not _empty(attrs)):
                out, depth = tag, 1
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = not close
            elif tag == "br":
                pieces.append(" ")
            elif tag == "button" and not close:
                pieces.append(" ")
            continue
        if tag in RAW:
            continue
        flush()
        if tag in VOID:
            continue
        if close:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    in_link = False
                    break
            continue
        if stack[-1][0] == "p" or tag in ENDS:
            ends, stops = ENDS.get(tag, ((), ()))
            for k in range(len(stack) - 1, 0, -1):
                t = stack[k][0]
                if t == "p" or t in ends:
                    del stack[k:]
                elif t in stops or not ends:
                    break
        in_link = False
        feats, y = _named(attrs) if attrs else ([], 0)
        group, above = TAGS.get(tag, "other"), stack[-1][1]
        if feats or group != "box":
            main = nodes[above].main or tag in ("article", "main")
            has_main = has_main or main
            nodes.append(Node(above, [INDEX["bias_box"], INDEX[f"t_{group}"], *feats], None, y, main))
            above = len(nodes) - 1
        stack.append((tag, above, y))
    if at < size and not out:
        pieces.append(page[at:])
    flush()
    for k in range(len(nodes) - 1, 0, -1):
        n, above = nodes[k], nodes[nodes[k].parent]
        above.size += n.size
        above.linked += n.linked
        if n.text is None and n.size:
            n.feats.append(INDEX["b_linked" if n.linked * 10 >= n.size * 7 else "b_prose" if n.size >= 200 else "b_short"])
    if has_main:
        for n in nodes:
            if n.text is not None:
                n.feats.append(INDEX["in_main" if n.main else "out_main"])
                if n.main and n.linked * 2 > n.size:
                    n.feats.append(INDEX["linked_main"])
    return nodes


def _empty(attrs: str) -> bool:
    """Does a start tag end in ``/>``, its slash no part of an unquoted value?"""
    return attrs.endswith("/") and not _UNQUOTED.search(attrs)


def _tokens(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(start, end, is end tag, name or '' for a comment, attributes); raw elements come as one token.

    Raw elements without an end tag go on to the end of the page, but head and template do not; inside svg and math ``/>`` ends them.
    """
    at, foreign = 0, False
    while True:
        m = TOKEN.search(page, at)
        if m is None:
            return
        tag, attrs = (m[2] or "").lower(), m[3] or m[4] or ""
        at = m.end()
        if tag in FOREIGN:
            foreign = not m[1] and not _empty(attrs)
        elif tag in TAGS:
            foreign = False
        elif tag in RAW and not m[1] and not (foreign and _empty(attrs)):
            stop = re.compile(rf"</{tag}\s*>" if tag != "head" else r"</head\s*>|<body\b", re.I).search(page, at)
            if stop is not None:
                at = stop.end() if not stop[0].lower().startswith("<body") else stop.start()
            elif tag not in ("head", "template"):
                at = len(page)
        yield m.start(), at, bool(m[1]), tag, attrs


EDGES = ("box", "text")                          # a child is an element or a text block


class Model:
    """Node weights (log odds per feature) and a 2 x 2 table of log potentials per edge kind."""

    def __init__(self):
        self.w = np.zeros(len(FEATURES))
        self.pair = np.zeros((2, 2, 2))
        self.pair[:, 0, 1] = -3.0                # main text inside an element that holds none

    def marginals(self, nodes: Sequence[Node], w: list[float] | None = None, edges: np.ndarray | None = None):
        """P(y = 1) of every node; with ``edges`` (2, 2, 2), adds the expected edge counts to it."""
        w = w or self.w.tolist()
        exp, log = math.exp, math.log
        n = len(nodes)
        up = [0.0] * n                           # log odds of a node from its own potential and its subtree
        msg = [0.0] * n                          # message to the parent
        tables = [[[exp(v) for v in row] for row in self.pair[k].tolist()] for k in range(2)]
        kind = [0 if v.text is None else 1 for v in nodes]
        for i in range(n - 1, -1, -1):
            v = nodes[i]
            a = up[i]
            for f in v.feats:
                a += w[f]
            up[i] = a = -30.0 if a < -30.0 else 30.0 if a > 30.0 else a
            if v.parent >= 0:
                (p00, p01), (p10, p11) = tables[kind[i]]
                e = exp(a)
                msg[i] = m = log((p10 + p11 * e) / (p00 + p01 * e))
                up[v.parent] += m
        total = up[:]                            # with the message from above
        out = [0.0] * n
        for i, v in enumerate(nodes):
            if v.parent >= 0:
                (p00, p01), (p10, p11) = tables[kind[i]]
                x = total[v.parent] - msg[i]
                x = -30.0 if x < -30.0 else 30.0 if x > 30.0 else x
                e = exp(x)
                if edges is not None:
                    c = exp(up[i])
                    cells = (p00, p01 * c, p10 * e, p11 * e * c)
                    z = sum(cells)
                    for cell, q in zip(((0, 0), (0, 1), (1, 0), (1, 1)), cells):
                        edges[kind[i]][cell] += q / z
                total[i] += log((p01 + p11 * e) / (p00 + p10 * e))
            a = total[i]
            out[i] = 1 / (1 + exp(-a)) if a > -700 else 0.0
        return out

    def train(self, pages: Sequence[str], rounds: int = 60, rate: float = 0.5, decay: float = 0.01) -> "Model":
        """Adagrad on the log likelihood; an element's label is whether it holds a marked block."""
        trees = []
        for page in pages:
            nodes = parse(page)
            y = [v.y if v.text is not None else 0 for v in nodes]
            for i in range(len(nodes) - 1, 0, -1):
                y[nodes[i].parent] |= y[i]
            trees.append((nodes, y))
        sum_w, sum_p = np.full(len(self.w), 1e-8), np.full((2, 2, 2), 1e-8)
        for _ in range(rounds):
            grad, seen, expected = np.zeros(len(self.w)), np.zeros((2, 2, 2)), np.zeros((2, 2, 2))
            for nodes, y in trees:
                p = self.marginals(nodes, edges=expected)
                for i, v in enumerate(nodes):
                    d = y[i] - p[i]
                    for f in v.feats:
                        grad[f] += d
                    if v.parent >= 0:
                        seen[0 if v.text is None else 1][y[v.parent], y[i]] += 1
            grad = grad / len(trees) - decay * self.w
            gp = (seen - expected) / len(trees) - decay * self.pair
            sum_w += grad ** 2
            sum_p += gp ** 2
            self.w += rate * grad / np.sqrt(sum_w)
            self.pair += rate * gp / np.sqrt(sum_p)
        return self

    def main_text(self, page: str | None, least: float = 0.5, w: list[float] | None = None) -> str:
        if not page:
            return ""
        nodes = parse(page)
        p = self.marginals(nodes, w)
        return "\n".join(v.text for v, q in zip(nodes, p) if v.text is not None and q >= least)


def trained_model() -> Model:
    return Model().train(labelled_pages())


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    model = model or trained_model()

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = model.w.tolist()
        for col in batches:
            yield pd.Series([model.main_text(v, w=w) for v in col], dtype=object)

    return pages.select("page_id", "url", text_of("html").alias("text")).withColumn("n_chars", F.length("text").cast("long"))

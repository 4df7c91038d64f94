"""Main text of web pages by gradient-boosted trees over DOM nodes (dealt operator 6).

A page is parsed into a tree. Each element has features: its tag's kind, the kinds of its attribute tokens and of its
ancestors', depth, place among its siblings, and of its subtree the text length, the shares of links, markup and
punctuation, and its part of the page's text. Boosted trees (numpy, three classes, logistic loss) say how likely an element is wholly
main text, wholly not, or holds both. Decoding is hierarchical: the best choice for the whole tree, where below an
element that is out all is out, and below a main element none is undecided, found by one pass from the leaves up.

Fitted on ``SAMPLE`` pages, a documented bound, drawn among those of the table that have one article element, which is their
main text (on all of them, where there are no more), and on ``ELEMENTS`` drawn elements of those that have more. Each is
also put into ``VARIANTS`` random layouts whose truth is known by construction: the article and the other parts under other
tags and class names, and notices, sidebars, forms, adverts and reader comments made of other text of the page put in
before, after and inside. So the trees can't rely on one site's layout. Only without any such page in the whole table a fixed
rule decides: text within article or main elements, else all text outside elements of a known kind.

Text is what the parser finds outside scripts, styles, titles and text areas (which run to the end of the page where they
are not closed), with character references decoded.
Block elements and line breaks separate; white space (as Unicode has it) becomes one space.
Nothing is dropped by size. Rules for odd input: null or empty html, or html without text, gives the empty text; html without elements is all main text; cut-off
tags at the end are dropped, unclosed elements end with their parents; equal pages give equal texts; further columns are ignored.
"""

from __future__ import annotations

import heapq
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SAMPLE = 150
ELEMENTS = 2_000  # drawn of a sampled page in one layout
VARIANTS = 4
ROUNDS = 20
DEPTH = 4
BINS = 24
RATE = 0.3
LEAST_WEIGHT = 4.0
OUT, MAIN, BOTH = 0, 1, 2

#: Fixed lists: elements of HTML by their role in parsing.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
ENDS_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Elements that an opening tag of the same group ends, up to the elements that hold them.
ITEM_OF = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"})}
#: Kinds of tags and of attribute tokens.
TAG_KINDS = {
    "nav": "nav menu", "edge": "header footer", "aside": "aside", "form": "form button input fieldset select datalist optgroup option", "article": "article main",
    "section": "section", "div": "div", "p": "p blockquote pre figure figcaption", "list": "ul ol li dl dt dd", "heading": "h1 h2 h3 h4 h5 h6",
    "table": "table tbody thead tr td th", "a": "a", "inline": "b i em strong span small u s code q",
}
TOKEN_KINDS = {
    "ad": "ad ads adv advert adverts advertisement banner sponsor sponsored promo promotion outbrain taboola dfp",
    "nav": "nav navbar navigation menu menus breadcrumb breadcrumbs pager pagination toc tabs skip links",
    "side": "sidebar side aside rail widget widgets related recommended popular trending",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay subscribe newsletter signup paywall",
    "comment": "comment comments commentlist reply replies respond disqus discussion feedback",
    "social": "share sharing social follow tags meta byline author",
    "edge": "header footer masthead topbar bottom copyright legal top foot head site",
    "form": "form search login register input",
    "content": "article content post entry story main body text page maincontent articlebody",
}
_TAG = {t: i for i, names in enumerate(TAG_KINDS.values()) for t in names.split()}
_TOKEN = {t: i for i, names in enumerate(TOKEN_KINDS.values()) for t in names.split()}
_BAD_TAGS = frozenset("nav menu header footer aside form button select datalist".split())
#: A quote delimits only where it begins a value; elsewhere, and without a second one, it is a character like others.
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*+)|=)*+)(>|\Z)|<[!?][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|itemprop|aria-label|hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_ENDING = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in RAW}


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    depth: int
    tokens: int  # kinds of its attribute tokens, as bits
    parts: list = field(default_factory=list)  # strings, and numbers of children


def _token_kinds(attributes: str) -> int:
    kinds = 0
    if "=" in attributes:
        for _, a, b, c in _ATTRIBUTE.findall(attributes):
            for word in _PART.findall(a or b or c):
                kind = _TOKEN.get(word.lower())
                if kind is not None:
                    kinds |= 1 << kind
    return kinds


_GROUPS = list(ITEM_OF)
_NO_ITEMS = (-1,) * len(_GROUPS)
_OF_ITEMS = frozenset(t for ended, holders in ITEM_OF.values() for t in ended | holders)


class _Open:
    """The elements open at a place of the page. Whatever the page holds, work is in proportion to its elements: an element is
    closed once, and what an opening tag ends is told by notes made when the elements above it were opened."""

    def __init__(self, nodes: list[Node]):
        self.nodes, self.at, self.count = nodes, 0, {}
        self.block = [0]  # of each node the innermost element around it, itself included, that is not inline
        self.items = [_NO_ITEMS]  # and by group of items the outermost open one that the next of the group ends

    def close(self, upto: int) -> None:
        """Closes what is open below element ``upto``."""
        while self.at != upto:
            node = self.nodes[self.at]
            self.count[node.tag] -= 1
            self.at = node.parent

    def end(self, tag: str) -> None:
        """An end tag: closes the innermost element of its name, if one is open."""
        if self.count.get(tag):
            while self.nodes[self.at].tag != tag:
                self.close(self.nodes[self.at].parent)
            self.close(self.nodes[self.at].parent)

    def make_room(self, tag: str) -> None:
        """Closes what an opening tag ends."""
        if tag in ENDS_P and self.nodes[self.block[self.at]].tag == "p":
            self.close(self.nodes[self.block[self.at]].parent)
        if tag in ITEM_OF:
            last = self.items[self.at][_GROUPS.index(tag)]
            if last >= 0:
                self.close(self.nodes[last].parent)

    def add(self, tag: str, tokens: int, stays: bool) -> None:
        nodes, parent, i = self.nodes, self.at, len(self.nodes)
        nodes.append(Node(tag, parent, nodes[parent].depth + 1, tokens))
        nodes[parent].parts.append(i)
        self.block.append(self.block[parent] if tag in INLINE else i)
        above = self.items[parent]
        if tag in _OF_ITEMS:
            above = tuple(-1 if tag in holders else i if a < 0 and tag in ended else a for a, (ended, holders) in zip(above, ITEM_OF.values()))
        self.items.append(above)
        if stays:
            self.count[tag] = self.count.get(tag, 0) + 1
            self.at = i


def parse(page: str) -> list[Node]:
    """Elements in the order of their opening tags; the first is the page."""
    nodes = [Node("#page", -1, 0, 0)]
    open_, at, end = _Open(nodes), 0, len(page)
    while at < end:
        m = _MARKUP.search(page, at)
        if m is None:
            nodes[open_.at].parts.append(page[at:])
            break
        if m.start() > at:
            nodes[open_.at].parts.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        if not m[4]:  # cut off
            break
        tag = tag.lower()
        if m[1]:
            open_.end(tag)
            continue
        if tag in RAW and not m[3].endswith("/"):
            closing = _ENDING[tag].search(page, at)
            rest = page.find(">", closing.end()) if closing else -1
            at = rest + 1 if rest >= 0 else end
            nodes[open_.at].parts.append(" " if tag not in INLINE else "")
            continue
        open_.make_room(tag)
        if tag in VOID:
            nodes[open_.at].parts.append(" " if tag in ("br", "hr") else "")
            continue
        open_.add(tag, _token_kinds(m[3]), not m[3].endswith("/"))
    return nodes


N_TAGS, N_TOKENS = len(TAG_KINDS), len(TOKEN_KINDS)
_PUNCTUATION = re.compile(r"[.,;:!?]")


def describe(nodes: list[Node]) -> np.ndarray:
    """A row of features for each element."""
    n = len(nodes)
    own, marks, links, below, paragraphs = (np.zeros(n) for _ in range(5))
    tag, parent, depth = np.full(n, N_TAGS), np.zeros(n, np.int64), np.zeros(n)
    kinds, order, siblings = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
    above_tokens, above_tags = [0] * n, [0] * n
    for i, node in enumerate(nodes):
        tag[i], parent[i], depth[i], kinds[i] = _TAG.get(node.tag, N_TAGS), node.parent, node.depth, node.tokens
        if i:
            p = node.parent
            above_tokens[i] = above_tokens[p] | nodes[p].tokens
            above_tags[i] = above_tags[p] | (1 << int(tag[p]))
        k = 0
        for part in node.parts:
            if isinstance(part, int):
                order[part], k = k, k + 1
            elif part and not part.isspace():
                own[i] += len(part)
                marks[i] += len(_PUNCTUATION.findall(part))
        for part in node.parts:
            if isinstance(part, int):
                siblings[part] = k
    text, marked = own.copy(), marks.copy()
    a = _TAG["a"]
    for i in range(n - 1, 0, -1):  # children come after their parents
        p = parent[i]
        if tag[i] == a:
            links[i] = text[i]
        text[p] += text[i]
        marked[p] += marked[i]
        links[p] += links[i]
        below[p] += below[i] + 1
        paragraphs[p] += paragraphs[i] + (nodes[i].tag == "p")
    whole = max(1.0, text[0])
    start = np.zeros(n)  # of its text on the page
    seen = np.zeros(n)
    for i in range(1, n):
        p = parent[i]
        start[i] = start[p] + seen[p]
        seen[p] += text[i]
    size = np.maximum(1.0, text)
    columns = [
        depth, order, siblings, order / np.maximum(1, siblings - 1), np.log1p(text), np.log1p(own), links / size, below / size * 100,
        marked / size, np.log1p(paragraphs), text / whole, start / whole, (start + text) / whole, text / np.maximum(1.0, text[np.maximum(parent, 0)]),
        np.log1p(text[np.maximum(parent, 0)]), tag == N_TAGS,
    ]
    columns += [tag == k for k in range(N_TAGS)]
    bits, up, up_tags = kinds, np.array(above_tokens, np.int64), np.array(above_tags, np.int64)
    columns += [(bits >> k) & 1 for k in range(N_TOKENS)] + [(up >> k) & 1 for k in range(N_TOKENS)]
    columns += [(up_tags >> k) & 1 for k in range(N_TAGS)]
    return np.column_stack([np.asarray(c, np.float32) for c in columns])


def _text(nodes: list[Node], keep) -> str:
    """Text of the elements for which ``keep(number)``, block elements and breaks as blanks."""
    out: list[str] = []
    stack: list = [(0, iter(nodes[0].parts))]
    while stack:
        i, parts = stack[-1]
        for part in parts:
            if not isinstance(part, int):
                if keep(i):
                    out.append(part)
                elif part:
                    out.append(" " if part.isspace() else "\0")
                continue
            if nodes[part].tag not in INLINE:
                out.append(" ")
            stack.append((part, iter(nodes[part].parts)))
            break
        else:
            stack.pop()
            if nodes[i].tag not in INLINE:
                out.append(" ")
    # what is left out separates what stands around it
    return " ".join(entities.unescape("".join(out).replace("\0", " ")).split())


@dataclass
class Tree:
    feature: np.ndarray  # by inner node of a full binary tree
    cut: np.ndarray
    value: np.ndarray  # by leaf

    def __call__(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(DEPTH):
            at = 2 * at + 1 + (x[rows, self.feature[at]] > self.cut[at])
        return self.value[at - (1 << DEPTH) + 1]


@dataclass
class Model:
    trees: list[list[Tree]]  # by round and class
    base: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Logarithms of the class probabilities."""
        z = np.tile(self.base, (len(x), 1))
        for trees in self.trees:
            for k, tree in enumerate(trees):
                z[:, k] += tree(x)
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def _grow(binned: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, features: np.ndarray) -> tuple[Tree, np.ndarray]:
    """A tree over some features for gradients and curvatures by histograms, and its values for the rows."""
    n = len(binned)
    inner = (1 << DEPTH) - 1
    feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
    at = np.zeros(n, np.int64)
    for level in range(DEPTH):
        first, width = (1 << level) - 1, 1 << level
        key = (at - first) * BINS
        best = np.full(width, 1e-6)
        for f in features.tolist():
            if not len(cuts[f]):
                continue
            where = key + binned[:, f]
            gs = np.bincount(where, g, width * BINS).reshape(width, BINS).cumsum(axis=1)
            hs = np.bincount(where, h, width * BINS).reshape(width, BINS).cumsum(axis=1)
            gt, ht = gs[:, -1:], hs[:, -1:]
            gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
            gain[(hs < LEAST_WEIGHT) | (ht - hs < LEAST_WEIGHT)] = -1
            top = gain[:, : len(cuts[f])].argmax(axis=1)
            value = gain[np.arange(width), top]
            better = value > best
            best[better] = value[better]
            feature[first : first + width][better] = f
            cut[first : first + width][better] = cuts[f][top[better]]
        chosen = feature[at]
        bin_of = np.array([np.searchsorted(cuts[f], c) if np.isfinite(c) else BINS for f, c in zip(feature, cut)])
        at = 2 * at + 1 + (binned[np.arange(n), chosen] > bin_of[at])
    leaf = at - inner
    value = -RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
    return Tree(feature, cut, value), value[leaf]


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Model:
    """Boosted trees of three classes."""
    cuts = []
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        middle = (values[1:] + values[:-1]) / 2
        cuts.append(middle if len(middle) < BINS else np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])))
    binned = np.column_stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)])
    binned = np.asfortranarray(binned, np.int64)  # one feature after the other
    rng = np.random.default_rng(17)
    share = np.bincount(y, weight, 3) + 1
    model = Model([], np.log(share / share.sum()))
    z = np.tile(model.base, (len(x), 1))
    for _ in range(ROUNDS):
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        trees = []
        for k in range(3):
            tree, step = _grow(binned, cuts, weight * (p[:, k] - (y == k)), weight * np.maximum(p[:, k] * (1 - p[:, k]), 1e-3), rng.permutation(x.shape[1])[: x.shape[1] // 2])
            z[:, k] += step
            trees.append(tree)
        model.trees.append(trees)
    return model


def _joined(nodes: list[Node], owns: np.ndarray) -> list[bool]:
    """Inline elements amid text, which go with the element that holds the text."""
    joined = [False] * len(nodes)
    for i, node in enumerate(nodes):
        joined[i] = i > 0 and node.tag in INLINE and bool(owns[node.parent] or joined[node.parent])
    return joined


def decode(nodes: list[Node], scores: np.ndarray) -> list[int]:
    """The likeliest choice for the whole tree: below OUT all is OUT, below MAIN is MAIN or OUT. An element with text
    of its own is not BOTH: that text must be one or the other."""
    n = len(nodes)
    owns = np.array([any(isinstance(p, str) and p and not p.isspace() for p in node.parts) for node in nodes], bool)
    joined = _joined(nodes, owns)
    total = scores.copy()
    total[owns, BOTH] = -1e9
    total[joined] = 0
    total[joined, BOTH] = -1e9
    best_main, best_any = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(n - 1, -1, -1):
        # children are added before their parent is read, as they come after it
        best_main[i] = MAIN if joined[i] or total[i, MAIN] > total[i, OUT] else OUT
        best_any[i] = int(total[i].argmax())
        p = nodes[i].parent
        if p >= 0:
            total[p, OUT] += total[i, OUT]
            total[p, MAIN] += total[i, best_main[i]]
            total[p, BOTH] += total[i, best_any[i]]
    state = [0] * n
    for i in range(n):
        p = nodes[i].parent
        above = BOTH if p < 0 else state[p]
        state[i] = above if above == OUT or joined[i] else int(best_main[i] if above == MAIN else best_any[i])
    return state


def _by_rule(nodes: list[Node]) -> str:
    """Without a model: text within article or main elements, else outside elements of a known other kind."""
    content = 1 << list(TOKEN_KINDS).index("content")
    bad = [False] * len(nodes)
    inside = [False] * len(nodes)
    for i, node in enumerate(nodes):
        if i:
            bad[i] = bad[node.parent] or node.tag in _BAD_TAGS or bool(node.tokens & ~content)
            inside[i] = inside[node.parent] or node.tag in ("article", "main")
    narrow = any(inside)
    return _text(nodes, lambda i: not bad[i] and (inside[i] or not narrow))


def main_texts(pages: list[str | None], model: Model | None) -> list[str]:
    """Main texts of some pages."""
    trees = [parse(page or "") for page in pages]
    if model is None:
        return [_by_rule(nodes) for nodes in trees]
    rows = [describe(nodes) for nodes in trees]
    scores = model.scores(np.concatenate(rows)) if rows else np.zeros((0, 3))
    out, at = [], 0
    for nodes, x in zip(trees, rows):
        state = decode(nodes, scores[at : at + len(x)])
        at += len(x)
        out.append(_text(nodes, lambda i: state[i] == MAIN or len(nodes) == 1))  # a page without elements is all text
    return out


# --- training pages -----------------------------------------------------------------------------


def _render(nodes: list[Node], i: int) -> str:
    """The markup within element ``i``, without attributes."""
    out: list[str] = []
    todo: list = [(nodes[i].parts, 0, "")]
    while todo:
        parts, k, ending = todo.pop()
        while k < len(parts) and isinstance(parts[k], str):
            out.append(parts[k])
            k += 1
        if k == len(parts):
            out.append(ending)
            continue
        child = nodes[parts[k]]
        out.append(f"<{child.tag}>")
        todo += [(parts, k + 1, ending), (child.parts, 0, f"</{child.tag}>")]
    return "".join(out)


def layouts(page: str, seed: int) -> list[str]:
    """The page and random layouts of it; main text is what stands in elements marked ``data-main``."""
    nodes = parse(page)
    articles = [i for i, node in enumerate(nodes) if node.tag == "article"]
    if len(articles) != 1:
        return []
    body = next((i for i, node in enumerate(nodes) if node.tag == "body"), 0)
    out = []
    for variant in range(VARIANTS + 1):
        rng = np.random.default_rng([seed, variant])

        def pick(*options: str) -> str:
            return options[int(rng.integers(len(options)))]

        def words(n: int) -> str:
            at = int(rng.integers(max(1, len(pool) - n)))
            return " ".join(pool[at : at + n]) or "more"

        inner = _render(nodes, articles[0])
        pool = re.sub(r"<[^>]*>", " ", inner).split() or ["more"]
        around = {p: f"<{nodes[p].tag}{' class=ad' if nodes[p].tokens else ''}>{_render(nodes, p)}</{nodes[p].tag}>" for p in nodes[body].parts if isinstance(p, int) and p != articles[0]}
        before = [v for p, v in around.items() if p < articles[0]]
        after = [v for p, v in around.items() if p > articles[0]]
        if not variant:
            out.append("<html><body>" + "".join(before) + f"<article data-main>{inner}</article>" + "".join(after) + "</body></html>")
            continue

        def sentences(k: int) -> str:
            return "".join(f"<p>{words(int(rng.integers(4, 40)))}.</p>" for _ in range(k))

        def links(k: int) -> str:
            return "<ul>" + "".join(f"<li><a>{words(int(rng.integers(1, 4)))}</a></li>" for _ in range(k)) + "</ul>"

        def wrap(tag: str, name: str, content: str) -> str:
            return f"<{tag}{f' {pick('class', 'id')}="{name}"' if name else ''}>{content}</{tag}>"

        k = int(rng.integers(1, 6))
        extra = {
            "nav": wrap(*pick("nav,", "div,menu", "div,navbar", "ul,nav", "div,breadcrumbs").split(","), links(k + 1)),
            "header": wrap(*pick("header,", "div,header", "div,masthead", "header,site-header").split(","), f"<h2>{words(3)}</h2>" + pick("", links(k))),
            "side": wrap(*pick("aside,", "aside,sidebar", "div,sidebar", "div,widget", "section,related").split(","), pick(sentences(k), links(k), f"<h3>{words(2)}</h3>" + sentences(k))),
            "notice": wrap(*pick("div,cookie-notice", "div,consent", "div,notice", "div,newsletter", "section,popup").split(","), pick(sentences(1), words(12) + " <button>OK</button>")),
            "ad": wrap(*pick("div,ad", "div,advert", "div,sponsored", "aside,ad-banner", "div,ads").split(","), pick(words(8), sentences(1), sentences(2))),
            "form": wrap(*pick("form,", "form,search", "div,login-form").split(","), f"<label>{words(2)}</label><input><button>{words(1)}</button>"),
            "comments": wrap(*pick("section,comments", "div,comments", "ol,commentlist", "div,discussion").split(","), "".join(wrap("div", pick("comment", "reply", "comment-body"), pick(sentences(1), sentences(2))) for _ in range(k))),
            "share": wrap("div", pick("share", "social", "tags"), links(k)),
            "footer": wrap(*pick("footer,", "div,footer", "footer,site-footer").split(","), pick(words(6), sentences(1), links(k))),
        }
        use = {name: rng.random() < 0.5 for name in extra}
        top = [extra[n] for n in ("header", "nav", "notice", "ad", "form") if use[n]]
        end = [extra[n] for n in ("share", "comments", "side", "ad", "form", "notice", "footer") if use[n] and rng.random() < 0.7]
        mid = [extra[n] for n in ("ad", "side", "share", "notice", "comments") if use[n] and rng.random() < 0.35]
        # within the article between its blocks
        blocks = re.split(r"(?=<p>)", inner)
        if rng.random() < 0.5:  # paragraphs of other lengths, some with links
            blocks, at = [f"<{(h := pick('h1', 'h2'))}>{words(int(rng.integers(1, 12)))}</{h}>"], 0
            while at < len(pool) and len(blocks) < 40:
                size = int(rng.integers(3, 60))
                part = pool[at : at + size]
                if rng.random() < 0.3:
                    part[len(part) // 2] = f"<a>{part[len(part) // 2]}</a>"
                blocks.append(f"<p>{' '.join(part)}</p>")
                at += size
        if rng.random() < 0.3:
            blocks = [f"<{pick('h1', 'h2')}>{words(5)}</{'h2'}>", *blocks]
        for part in mid:
            blocks.insert(len(blocks) if "comment" in part[:40] or rng.random() < 0.5 else int(rng.integers(1, len(blocks) + 1)), part)
        tag, name = pick("article,", "article,post", "main,", "div,content", "div,article-body", "section,story", "div,entry-content", "div,").split(",")
        inner = "".join(blocks)
        if rng.random() < 0.3:
            inner = f"<{pick('div', 'section')}>{inner}</div>"
        attribute = f' class="{name}"' if name else ""
        main = f"<{tag}{attribute} data-main>{inner}</{tag}>"
        kept_before, kept_after = (before, after) if rng.random() < 0.6 else ([], [])
        if rng.random() < 0.3:
            main = f"<div{pick('', ' class=wrapper', ' id=page')}>{''.join(top)}{main}{''.join(end)}</div>"
            top, end = [], []
        out.append("<html><body>" + "".join([*kept_before, *top, main, *end, *kept_after]) + "</body></html>")
    return out


_INSERTED = re.compile(r"data-main")


def truth(page: str) -> tuple[list[Node], np.ndarray]:
    """The elements of a training page, and the class of each: by the text below it that is main."""
    nodes = parse(page)
    opened = [m for m in _MARKUP.finditer(page) if m[2] and not m[1] and m[4] and m[2].lower() not in VOID and m[2].lower() not in RAW]
    marked = next(i for i, m in enumerate(opened, 1) if _INSERTED.search(m[3]))
    inside = [False] * len(nodes)
    content = 1 << list(TOKEN_KINDS).index("content")
    for i, node in enumerate(nodes):
        if i:
            other = node.tag in _BAD_TAGS or node.tokens & ~content
            inside[i] = i == marked or (inside[node.parent] and not other)
    own = np.array([sum(len(p.strip()) for p in node.parts if isinstance(p, str)) for node in nodes], float)
    total, main = own.copy(), own * np.array(inside)
    for i in range(len(nodes) - 1, 0, -1):
        total[nodes[i].parent] += total[i]
        main[nodes[i].parent] += main[i]
    # an element with text of its own goes with that text
    y = np.where(own > 0, np.where(inside, MAIN, OUT), np.where(main <= 0, OUT, np.where(main >= total, MAIN, BOTH)))
    y[marked] = MAIN
    return nodes, y


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        xs, ys, plain = [], [], []
        for key, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            texts = layouts(page or "", key & 0xFFFFFFFF)
            for text in texts:
                nodes, y = truth(text)
                x = describe(nodes).astype(np.float32)
                if len(y) > ELEMENTS:
                    some = np.sort(np.random.default_rng(key & 0xFFFFFFFF).choice(len(y), ELEMENTS, replace=False))
                    x, y = x[some], y[some]
                xs.append(x.tobytes())
                ys.append(y.astype(np.int8).tobytes())
                plain.append(text is texts[0])
        yield pa.RecordBatch.from_arrays([pa.array(xs, pa.binary()), pa.array(ys, pa.binary()), pa.array(plain, pa.bool_())], names=["x", "y", "plain"])


def _first(rows: int):
    """Of a partition's (place, html) rows the ``rows`` first places of pages with one article element. Only pages that
    come before those found so far are parsed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[int] = []  # a heap of the negative places
        held: set[int] = set()
        for batch in batches:
            for i, place in enumerate(batch.column(0).to_pylist()):
                if place in held or (len(last) == rows and place >= -last[0]):
                    continue
                if sum(node.tag == "article" for node in parse(batch.column(1)[i].as_py())) == 1:
                    held.add(place)
                    heapq.heappush(last, -place)
                    if len(last) > rows:
                        held.remove(-heapq.heappop(last))
        yield pa.RecordBatch.from_arrays([pa.array(sorted(held), pa.int64())], names=["place"])

    return run


def fit(pages: DataFrame, rows: int = SAMPLE) -> Model | None:
    """A model of ``rows`` different pages that have one article element, or of all such pages, where there are fewer;
    chosen by a hash of their text: the same in every run. None without any."""
    key, place = F.xxhash64("html"), F.xxhash64(F.lit(3), "html")
    with_article = pages.where(F.col("html").rlike("(?i)<article")).select(place.alias("place"), "html")
    drawn = with_article.mapInArrow(_first(rows), "place long").distinct().orderBy("place").limit(rows)
    places = [r["place"] for r in drawn.collect()]
    if not places:
        return None
    some = pages.where(F.col("html").isNotNull() & place.isin(places)).select(key.alias("key"), "html").dropDuplicates(["key"])
    got = some.mapInArrow(_training, "x binary, y binary, plain boolean").toArrow()
    if not got.num_rows:
        return None
    ys = [np.frombuffer(v.as_buffer(), np.int8) for v in got["y"]]
    xs = [np.frombuffer(v.as_buffer(), np.float32).reshape(len(y), -1) for v, y in zip(got["x"], ys)]
    order = sorted(range(len(xs)), key=lambda i: (len(ys[i]), xs[i].tobytes()))
    x, y = np.concatenate([xs[i] for i in order]), np.concatenate([ys[i] for i in order]).astype(np.int64)
    # a page counts as one, however many elements it has, and in its own layout as much as its variants
    plain = got["plain"].to_numpy()
    weight = np.concatenate([np.full(len(ys[i]), 20.0 * (VARIANTS if plain[i] else 1) / len(ys[i])) for i in order])
    return boost(x, y, weight)


def extract(pages: DataFrame, model: Model | None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    kinds = dict(pages.dtypes)
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column(2).to_pylist()
            texts: list[str] = []
            for a in range(0, len(html), 256):
                texts.extend(main_texts(html[a : a + 256], shared.value))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op6_html(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages, fit(pages))

"""A forgiving HTML tree: block elements, their text and the features of each node."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Fixed lists of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math object select button xmp noframes noembed".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
#: An element on the left ends an open one on the right, up to the nearest bounding element.
ENDS: dict[str, tuple[set[str], set[str]]] = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"datalist"}),
}
SCOPE = frozenset("table td th caption html body".split())
TAGS = ("html", "body", "div", "p", "article", "main", "section", "nav", "header", "footer", "aside", "form", "ul", "ol", "li", "h1", "h2", "h3", "table", "tr", "td", "blockquote", "figure", "pre")
#: Groups of attribute words, matched as beginnings of the tokens of class, id and role.
GROUPS = {
    "menu": "nav menu breadcrumb pagination pager tabs toolbar skip".split(),
    "top": "header masthead banner topbar logo branding head".split(),
    "bottom": "footer foot copyright legal colophon bottom".split(),
    "side": "sidebar side aside widget rail complementary secondary".split(),
    "notice": "cookie consent notice alert gdpr popup modal overlay banner message warning paywall".split(),
    "advert": "ad ads advert sponsor promo promoted adsense dfp outbrain taboola".split(),
    "form": "form subscribe newsletter signup login search contact".split(),
    "comment": "comment disqus reply replies respond discussion reader".split(),
    "more": "related recommend share social more tags meta byline author trending popular".split(),
    "content": "article content post entry story text body main page prose".split(),
}
_BOXES = {"article": 1, "main": 2, "nav": 4, "header": 8, "footer": 16, "aside": 32, "form": 64, "td": 128}
_QUOTED = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_NAME = re.compile(r"</?[a-zA-Z]")
_ATTR = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
#: Tags whose quotes run to the end of the page, after which quotes are no longer looked at.
UNCLOSED = 16
_EXACT: dict[str, int] = {}
_START: dict[str, int] = {}
for _k, _words in enumerate(GROUPS.values()):
    for _w in _words:
        _EXACT[_w] = _EXACT.get(_w, 0) | 1 << _k
        if len(_w) > 3:
            _START[_w] = _START.get(_w, 0) | 1 << _k
_LENGTHS = sorted({len(w) for w in _START})


class Node:
    __slots__ = ("at", "chars", "depth", "first", "flags", "links", "parent", "sentences", "tag", "under", "upper")

    def __init__(self, tag: str, parent: int, depth: int, flags: int, upper: int, under: int, first: int, at: int) -> None:
        self.tag, self.parent, self.depth, self.flags, self.upper, self.under, self.first, self.at = tag, parent, depth, flags, upper, under, first, at
        self.chars = self.links = self.sentences = 0


@lru_cache(4096)
def _flags(attributes: str) -> int:
    """The groups of the words in class, id and role."""
    found = 0
    if "=" in attributes:
        for m in _ATTR.finditer(attributes):
            for t in set(_SPLIT.split(m[2] or m[3] or m[4] or "")):
                t = t[:40].lower()
                found |= _EXACT.get(t, 0)
                for n in _LENGTHS:
                    if n > len(t):
                        break
                    found |= _START.get(t[:n], 0)
    return found


class _Open:
    """The open elements and where each tag stands among them, so that no search walks over them."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = [("html", 0)]  # with the block node of each
        self.where: dict[str, list[int]] = defaultdict(list)
        self.walls: list[int] = []  # places of elements that are neither inline nor p
        self.blocks = self.links = 0  # open block elements, open links

    def top(self, tags) -> int:
        """The place of the innermost of the tags; 0 if none is open."""
        return max((p[-1] for t in tags if (p := self.where.get(t))), default=0)

    def push(self, tag: str, node: int) -> None:
        self.where[tag].append(len(self.stack))
        if tag not in INLINE:
            self.blocks += 1
            if tag != "p":
                self.walls.append(len(self.stack))
        self.links += tag == "a"
        self.stack.append((tag, node))

    def cut(self, place: int) -> bool:
        """Close everything from the place on; whether a block was among it."""
        before = self.blocks
        while len(self.stack) > place:
            tag, _ = self.stack.pop()
            self.where[tag].pop()
            if tag not in INLINE:
                self.blocks -= 1
                if tag != "p":
                    self.walls.pop()
            self.links -= tag == "a"
        return self.blocks < before


def _tokens(page: str) -> Iterator[tuple[str, str, str, int]]:
    """(kind, tag or text, attributes, offset), kind: text, open or close. The caller may send an offset to go on at.

    Every character is passed over a bounded number of times, whatever is left unclosed.
    """
    at, size, last, tries = 0, len(page), page.rfind(">"), UNCLOSED
    text_from = 0
    while at < size:
        if page[at] != "<":
            at = page.find("<", at)
            at = size if at < 0 else at
            continue
        named = _NAME.match(page, at)
        m, skip = None, 0
        if named and last > at:
            m = _QUOTED.match(page, at) if tries else None
            if not m:
                tries -= tries > 0
                m = _PLAIN.match(page, at)
        elif page.startswith("<!--", at):
            skip = page.find("-->", at + 4) + 3
            skip = size if skip < 3 else skip
        elif page[at + 1 : at + 2] in ("!", "?", "/") and last > at and not named:
            skip = page.find(">", at) + 1
        if not m and not skip:
            at += 1  # a sign in the text
            continue
        if at > text_from:
            yield "text", page[text_from:at], "", text_from
        start, at = at, m.end() if m else skip
        if m:
            moved = yield ("close" if m[1] else "open"), m[2].lower(), m[3], start
            at = max(at, moved or 0)
        text_from = at
    if size > text_from:
        yield "text", page[text_from:], "", text_from


def parse(page: str) -> tuple[list[Node], list[tuple[int, int, str]]]:
    """Block nodes in page order (0 is the root) and text leaves (node, block number, text).

    Inline elements belong to the node around them; raw elements and comments leave no text. Time is
    linear in the page.
    """
    nodes = [Node("html", -1, 0, 0, 0, 0, 0, 0)]
    leaves: list[tuple[int, int, str]] = []
    held = _Open()
    stack, where = held.stack, held.where
    block = seen = 0
    endless: set[str] = set()  # raw elements without an end tag in the rest of the page
    tokens = _tokens(page)
    moved = None
    while True:
        try:
            kind, tag, attributes, at = tokens.send(moved)
        except StopIteration:
            return nodes, leaves
        moved = None
        if kind == "text":
            text = tag
            if text.isspace() and not leaves:
                continue
            if "&" in text:
                text = html.unescape(text)
            node = stack[-1][1]
            leaves.append((node, block, text))
            n = 0 if text.isspace() else len(text)
            x = nodes[node]
            x.chars += n
            x.links += n if held.links else 0
            x.sentences += text.count(".") + text.count(",") + text.count("!") + text.count("?")
            seen += n
        elif kind == "close":
            if (places := where.get(tag)) and not (tag in INLINE and held.walls and held.walls[-1] > places[-1]):
                block += held.cut(places[-1])  # a stray inline end tag ends no block
        elif tag in RAW:
            inside = at + 1 + len(tag)
            end = None if tag in endless else re.compile(f"</{re.escape(tag)}\\b", re.I).search(page, inside)
            if end:
                to = page.find(">", end.end())
                moved = to + 1 if to >= 0 else len(page)
            else:
                endless.add(tag)
                moved = len(page) if tag in ("script", "style") else None
        elif tag in ("br", "img"):
            leaves.append((stack[-1][1], block, " "))
        elif tag in VOID:
            block += tag == "hr"
        elif tag in ("html", "body", "head") and (tag == "html" or where.get(tag)):
            continue
        else:
            ends, bound = ({"p"}, SCOPE) if tag in CLOSES_P else ENDS.get(tag, ((), ()))
            if ends:
                limit = held.top(bound)
                while (place := held.top(ends)) > limit:
                    held.cut(place)
                    if tag != "tr":
                        break
            if tag in INLINE:
                held.push(tag, stack[-1][1])
                continue
            block += 1
            above = stack[-1][1]
            p = nodes[above]
            nodes.append(Node(tag, above, p.depth + 1, _flags(attributes), p.upper | p.flags, p.under | _BOXES.get(tag, 0), seen, at))
            held.push(tag, len(nodes) - 1)


_TAG = {t: k for k, t in enumerate(TAGS)}
_N_GROUPS = len(GROUPS)
_HEADS = ("h1", "h2", "h3")
WIDTH = 26 + len(TAGS) + 3 * _N_GROUPS + len(_BOXES)


def features(pages: list[list[Node]]) -> np.ndarray:
    """One row a node of all pages: text, link and tag density of its subtree, place, siblings, tag, attributes around and within.

    Nodes of a page stand in page order, so a subtree is a stretch of rows and its sums are differences of running sums.
    """
    every = [x for nodes in pages for x in nodes]
    n = len(every)
    if not n:
        return np.zeros((0, WIDTH), np.float32)
    column = lambda f, t=np.int64: np.fromiter((f(x) for x in every), t, n)
    sizes = np.array([len(nodes) for nodes in pages if nodes])
    root = np.repeat(np.cumsum(sizes) - sizes, sizes)
    parent = column(lambda x: x.parent)
    is_root = parent < 0
    up = np.where(is_root, np.arange(n), parent + root)
    above, size = up.tolist(), [1] * n
    for i in range(n - 1, -1, -1):
        if above[i] != i:
            size[above[i]] += size[i]
    end = np.arange(n) + np.array(size)

    def within(v: np.ndarray) -> np.ndarray:
        running = np.concatenate([np.zeros((1, *v.shape[1:]), np.int64), v.astype(np.int64).cumsum(0)])
        return running[end] - running[:n]

    tag = column(lambda x: _TAG.get(x.tag, -1))
    own, own_links, own_dots, depth, first = (column(f) for f in (lambda x: x.chars, lambda x: x.links, lambda x: x.sentences, lambda x: x.depth, lambda x: x.first))
    flags, upper = column(lambda x: x.flags), column(lambda x: x.upper)
    chars, links, dots = within(own), within(own_links), within(own_dots)
    paras, heads = within(tag == _TAG["p"]), within(np.isin(tag, [_TAG[t] for t in _HEADS]))
    whole, most_paras = np.maximum(chars[root], 1), np.maximum(paras[root], 1)
    # siblings: rows in the order of their parents
    order = np.lexsort((np.arange(n), up, is_root))
    order = order[: n - len(sizes)]
    of = up[order]
    begins = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)
    runs = np.diff(np.r_[begins, len(of)])
    place, family, largest, like = np.zeros(n), np.zeros(n), np.zeros(n), np.ones(n)
    before, after = np.full(n, -1), np.full(n, -1)
    if len(of):
        place[order] = np.arange(len(of)) - np.repeat(begins, runs)
        family[order] = np.repeat(runs, runs)
        largest[order] = np.repeat(np.maximum.reduceat(chars[order], begins), runs)
        same = of[1:] == of[:-1]
        before[order[1:][same]], after[order[:-1][same]] = order[:-1][same], order[1:][same]
        _, kind, often = np.unique(np.stack([of, tag[order], flags[order]]), axis=1, return_inverse=True, return_counts=True)
        like[order] = often[kind.ravel()]
    family[is_root] = np.bincount(up[~is_root], minlength=n)[is_root]
    seen_h1 = np.cumsum(tag == _TAG["h1"])
    headed = seen_h1 - (seen_h1 - (tag == _TAG["h1"]))[root]
    density = links / np.maximum(chars, 1)
    beside = lambda k, v: np.where(k >= 0, v[np.maximum(k, 0)], -1.0)
    of_page = np.stack(
        [
            chars / whole, chars, density, own, own_links / np.maximum(own, 1), dots / np.maximum(chars, 1) * 100, chars / np.array(size), np.array(size), paras, depth,
            place, family, first / whole, np.where(is_root, 1.0, chars[up] / whole), np.where(is_root, 1.0, chars / np.maximum(chars[up], 1)),
            beside(before, chars), beside(before, density), beside(after, chars), beside(after, density),
            paras[up], chars / np.maximum(largest, 1), like, dots, heads, np.minimum(headed, 3), paras / most_paras,
        ],
        axis=1,
    )
    one_of = (tag[:, None] == np.arange(len(TAGS))).astype(float)
    bits = lambda v: v[:, None] >> np.arange(_N_GROUPS) & 1
    down = (within(bits(flags)) - bits(flags) > 0) & (bits(flags) == 0)
    under = column(lambda x: x.under)[:, None] >> np.arange(len(_BOXES)) & 1
    return np.concatenate([of_page, one_of, bits(flags), bits(upper), down, under], axis=1).astype(np.float32)

"""HTML text as a folded tree of block elements with the texts they own.

Elements that do not start a block (links, emphasis) are part of the text around
them. Repeated neighbours, as paragraphs or rows, are folded into one node, so
that pages of one layout have one shape however long they are.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache
from typing import NamedTuple

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote caption center colgroup dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li"
    " main menu nav object ol optgroup option p pre search section select summary table tbody td"
    " tfoot th thead tr ul button label noscript template svg canvas audio video".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table"
    " ul".split()
)
# These say where a page's parts lie, which all pages share.
FRAME = frozenset("html head body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What a start tag closes, and the elements that it does not look beyond.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}

CONTAINERS = frozenset("div section article table ul ol dl".split())

# Elements and names that mark what is no main text.
CHROME_TAGS = frozenset(
    "nav footer aside header form dialog menu button select option optgroup label fieldset"
    " legend noscript template svg canvas audio video object search".split()
)
CHROME_NAMES = frozenset(
    "menu nav navbar navigation breadcrumb breadcrumbs topbar toolbar pagination pager"
    " header masthead banner footer colophon copyright"
    " sidebar aside widget widgets related recommended"
    " notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe"
    " ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion"
    " comment comments commentlist respond disqus share sharing social login signup".split()
)
CHROME_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu"
    " menubar".split()
)
COMMENTS = frozenset("comment comments commentlist respond disqus".split())
# Names that say what an element has about it, not what it is.
ABOUT = ("has-", "no-", "with-", "without-", "is-")

# Nodes are told apart down to this depth; what lies deeper belongs to its ancestor there.
DEPTH = 100

TAG = re.compile(
    r"<!--(?:-?>|.*?--!?>|.*)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"(?:(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(?P<loose>[^>]*+)(?:>|\Z))"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# Without one of these words attributes say nothing about an element.
TELLING = re.compile("class|id|role|hidden|style|itemprop", re.I)
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
# Numbers in class names count records; they make no other kind of element.
LABEL = re.compile(r"[^a-z-]+")
NAME = re.compile(r"[^a-z0-9-]+")
BACK = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW}


class Element(NamedTuple):
    """What a start tag says: its label in the tree and how it counts."""

    label: str
    chrome: bool
    header: bool
    main: bool
    hidden: bool


@lru_cache(maxsize=1 << 14)
def element(name: str, attrs: str) -> Element:
    found = {}
    for key, *values in ATTRIBUTE.findall(attrs):
        found.setdefault(key.lower(), html.unescape("".join(values)))
    classes = found.get("class", "").split()
    names = set()
    for text in [*classes, found.get("id", "")]:
        if not text.lower().startswith(ABOUT):
            parts = [p for p in re.split(r"[^A-Za-z0-9]+", text) if p]
            names.update(p.lower() for p in parts)
            names.update(p.lower() for part in parts for p in CAMEL.split(part))
    role = found.get("role", "").strip().lower()
    body = found.get("itemprop", "").lower() == "articlebody"
    main = name in ("article", "main") or role in ("main", "article") or body
    by_name = names & (COMMENTS if main else CHROME_NAMES)
    style = found.get("style", "").replace(" ", "").lower()
    kinds = [LABEL.sub("", k) for k in [*sorted(c.lower() for c in classes), role]]
    return Element(
        ".".join([NAME.sub("", name) or "x", *[k for k in kinds if k]]),
        bool(by_name - {"header"}) or role in CHROME_ROLES or name in CHROME_TAGS - {"header"},
        name == "header" or "header" in by_name,
        main,
        "hidden" in found or "display:none" in style,
    )


class Node:
    """An element of the folded tree; `into` leads to the node that it was folded into."""

    __slots__ = ("label", "children", "into", "number", "_shape")

    def __init__(self, label: str):
        self.label, self.children, self.into, self.number, self._shape = label, [], None, 0, None

    def home(self) -> Node:
        node = self
        while node.into is not None:
            node = node.into
        return node

    def shape(self) -> str:
        """The node and what is below it as text; kept, so only for finished nodes."""
        if self._shape is None:
            below = " ".join(c.shape() for c in self.children)
            self._shape = f"{self.label}({below})" if below else self.label
        return self._shape

    def count(self) -> int:
        return 1 + sum(c.count() for c in self.children)

    def enumerate(self) -> list[Node]:
        """All nodes in page order, numbered so."""
        found, waiting = [], [self]
        while waiting:
            node = waiting.pop()
            node.number = len(found)
            found.append(node)
            waiting.extend(reversed(node.children))
        return found


def from_shape(shape: str) -> Node:
    """The tree of a shape text."""
    top = Node("")
    path, last = [top], top
    for part in re.findall(r"[()]|[^() ]+", shape):
        if part == "(":
            path.append(last)
        elif part == ")":
            path.pop()
        else:
            last = Node(part)
            path[-1].children.append(last)
    return top.children[0]


def matching(a: Node, b: Node, known: dict) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching of trees with equal root labels.

    The number of node pairs in the greatest matching that keeps labels,
    ancestors and order, and the matched pairs of children of the two roots.
    """
    if (id(a), id(b)) in known:
        return known[id(a), id(b)]
    if a.shape() == b.shape():
        found = a.count(), list(zip(a.children, b.children, strict=True))
        known[id(a), id(b)] = found
        return found
    left, right, pairs, total = a.children, b.children, [], 1
    # Equal subtrees at either end always belong to a greatest matching.
    start, end = 0, 0
    most = min(len(left), len(right))
    while start < most and left[start].shape() == right[start].shape():
        pairs.append((left[start], right[start]))
        total += left[start].count()
        start += 1
    while end < most - start and left[-1 - end].shape() == right[-1 - end].shape():
        pairs.append((left[-1 - end], right[-1 - end]))
        total += left[-1 - end].count()
        end += 1
    left, right = left[start : len(left) - end], right[start : len(right) - end]
    if left and right:
        weight = [
            [matching(x, y, known)[0] if x.label == y.label else 0 for y in right] for x in left
        ]
        best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
        for i, row in enumerate(weight):
            for j, w in enumerate(row):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + w)
        total += best[-1][-1]
        i, j = len(left), len(right)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((left[i], right[j]))
    order = {id(x): at for at, x in enumerate(a.children)}
    pairs.sort(key=lambda pair: order[id(pair[0])])
    known[id(a), id(b)] = total, pairs
    return total, pairs


def merge(a: Node, b: Node) -> Node:
    """A tree that both match in whole; nodes of `a` and `b` lead into its nodes."""
    return _merge(a, b, {})


def _merge(a: Node, b: Node, known: dict) -> Node:
    if a.shape() == b.shape():
        _lead(b, a)
        return a
    new = Node(a.label)
    at = 0
    mates = {id(x): y for x, y in matching(a, b, known)[1]}
    for child in a.children:
        mate = mates.get(id(child))
        if mate is None:
            new.children.append(child)
            continue
        while b.children[at] is not mate:
            new.children.append(b.children[at])
            at += 1
        new.children.append(_merge(child, mate, known))
        at += 1
    new.children.extend(b.children[at:])
    a.into = b.into = new
    return new


def _lead(b: Node, a: Node) -> None:
    waiting = [(b, a)]
    while waiting:
        x, y = waiting.pop()
        x.into = y
        waiting.extend(zip(x.children, y.children, strict=True))


def aligned(template: Node, page: Node) -> list[int]:
    """The number of the template's node for each node of a page in order, -1 without one.

    The template's nodes are numbered already.
    """
    places, known, found = {}, {}, [(template, page)] if template.label == page.label else []
    while found:
        x, y = found.pop()
        places[id(y)] = x.number
        found.extend(matching(x, y, known)[1])
    return [places.get(id(n), -1) for n in page.enumerate()]


class Block(NamedTuple):
    node: int
    text: str
    links: int
    main: bool


class _Open:
    """An open element: its node, or that of its nearest ancestor with one."""

    __slots__ = ("name", "node", "chrome", "main", "depth", "own", "chars", "links")

    def __init__(self, name, node, chrome, main, depth, own):
        self.name, self.node, self.chrome, self.main = name, node, chrome, main
        self.depth, self.own, self.chars, self.links = depth, own, 0, 0


class Page:
    """Parses one page. `shape` is its folded tree, `blocks` its texts in page order.

    Texts below elements that by tag, role or name are no main text are left out.
    """

    def __init__(self, text: str):
        self.root = Node("page")
        self.path = [_Open("", self.root, False, False, 0, True)]
        self.raw: list[tuple[Node, str, int, bool]] = []
        self.words: list[str] = []
        self.link_words: list[str] = []
        self.in_link = 0
        self.open: dict[str, int] = {}
        self._read(text)
        while len(self.path) > 1:
            self._close()
        self._flush()
        self.root.enumerate()
        self.shape = self.root.shape()
        self.blocks = [Block(n.home().number, t, k, m) for n, t, k, m in self.raw]

    def _text(self, part: str) -> None:
        if part and not self.path[-1].chrome:
            part = html.unescape(part) if "&" in part else part
            self.words.append(part)
            if self.in_link:
                self.link_words.append(part)

    def _flush(self) -> None:
        if self.words:
            text = " ".join("".join(self.words).split())
            if text:
                links = len(" ".join("".join(self.link_words).split()))
                top = self.path[-1]
                self.raw.append((top.node, text, links, top.main))
                top.chars, top.links = top.chars + len(text), top.links + links
            self.words, self.link_words = [], []

    def _open(self, name: str, what: Element) -> None:
        top = self.path[-1]
        main = top.main or what.main
        chrome = top.chrome or what.chrome or what.hidden or (what.header and not top.main)
        if top.depth < DEPTH:
            node = Node(what.label)
            top.node.children.append(node)
            self.path.append(_Open(name, node, chrome, main, top.depth + 1, True))
        else:
            self.path.append(_Open(name, top.node, chrome, main, top.depth, False))
        self.open[name] = self.open.get(name, 0) + 1

    def _close(self) -> None:
        self._flush()
        done = self.path.pop()
        self.open[done.name] -= 1
        if not done.own:
            return
        node = done.node
        if node.label in CONTAINERS and not node.children and done.chars <= 2 * done.links:
            # A row of links is no neighbour of a text in the same element.
            node.label += ".links" if done.chars else ""
        siblings = self.path[-1].node.children
        if len(siblings) > 1:
            before, last = siblings[-2], siblings[-1]
            # Containers without a class are told apart by place unless they are alike.
            plain = before.label.removesuffix(".links") in CONTAINERS
            if before.label == last.label and (not plain or before.shape() == last.shape()):
                siblings[-2:] = [merge(before, last)]

    def _close_to(self, names, barrier=frozenset()) -> None:
        for at in range(len(self.path) - 1, 0, -1):
            if self.path[at].name in names:
                while len(self.path) > at:
                    self._close()
                return
            if self.path[at].name in barrier:
                return

    def _start(self, name: str, attrs: str) -> None:
        if name == "a":
            self.in_link = 1
        what = element(name, attrs if TELLING.search(attrs) else "")
        if name not in BLOCKS and not (what.chrome or what.hidden or what.main):
            if name == "br":
                self._text(" ")
            return
        if name in VOID:
            self._flush()
            return
        if name in BLOCKS:
            self._flush()
        if name in ENDS_PARAGRAPH and self.open.get("p"):
            self._close_to({"p"}, {"table", "td", "th", "button", "caption", "object"})
        if name in HEADINGS and self.path[-1].name in HEADINGS:
            self._close()
        if name in CLOSES:
            self._close_to(*CLOSES[name])
        self._flush()
        self._open(name, what)

    def _end(self, name: str) -> None:
        if name == "a":
            self.in_link = 0
        if name in HEADINGS:
            self._close_to(HEADINGS)
        elif self.open.get(name):
            self._close_to({name})
        elif name == "br":
            self._text(" ")
        elif name in BLOCKS:
            self._flush()

    def _read(self, text: str) -> None:
        at, size = 0, len(text)
        while at < size:
            tag = TAG.search(text, at)
            if tag is None:
                self._text(text[at:])
                return
            if tag.start() > at:
                self._text(text[at : tag.start()])
            at = tag.end()
            name = tag["name"]
            if name is None:
                continue
            # A tag that the text breaks off in says nothing.
            if at == size and text[-1] != ">":
                return
            name = name.lower()
            if name in FRAME:
                self._flush()
            elif tag["end"]:
                self._end(name)
            elif name in RAW:
                back = BACK[name].search(text, at)
                at = back.start() if back else size
            else:
                attrs = tag["attrs"]
                self._start(name, tag["loose"] if attrs is None else attrs)

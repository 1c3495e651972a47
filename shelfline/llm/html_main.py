"""Main text of web pages by minimum-cut labelling.

A page becomes a list of text blocks. A logistic classifier over a block's own
measures (length, links, kind of element) and its place (the elements around
it, their class names, the element that holds most of the page's prose) gives
each a cost of either label, bounded so that no one sign decides alone. These
are its capacities to the two terminals; neighbours on the page and blocks close
in the element tree are tied by smoothness edges. The least cut (max-flow,
Dinic) is the labelling of least total cost: a short line amid an article stays
with it, a long paragraph amid a menu doesn't.

What an element's name or classes say against its blocks counts only where the
element holds no article and less than half of the page's text, or stands beside
an article: "has-sidebar" on a body, or a form around a whole page, says nothing.

The classifier's weights, and how strong the edges are, are learnt here from
pages that ``examples`` writes from a seed.

A block whose own cost outweighs all its edges keeps its label in every least
cut; such blocks are settled first, and the flow runs on what is left. Of
several least cuts, the one with the fewest blocks of an article is taken.

Character references are decoded, white space inside a block becomes one space,
and blocks of the article are joined in page order by one space. Scripts,
styles and other unseen elements have no blocks. Elements that are left open
end with what holds them, end tags without a start are passed over, and text
after the last tag still counts. Null and empty pages have an empty text, and so
have pages without a block of an article.
"""

from __future__ import annotations

import html
import random
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.base import scan

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs2>[^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|aria-label|hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)

UNSEEN = {"script", "style", "noscript", "template", "title", "head", "textarea", "svg", "math", "iframe", "object", "canvas", "audio", "video", "select", "option"}
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "svg", "iframe"}
_RAW_END = {name: re.compile(rf"</{name}(?![a-z0-9-])[^>]*>?", re.IGNORECASE) for name in _RAW}
_EMPTY = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html",
    "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul",
}
#: Elements that a head may hold; any other one ends it, as does text.
_IN_HEAD = {"base", "basefont", "bgsound", "head", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
#: Elements of other vocabularies, which "/>" ends.
_FOREIGN = {"svg", "math"}
#: Elements that close an open one of the same kind, up to the given container.
_ENDS_SAME = {
    "li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
    "option": ("select",),
}

#: Words of class names, ids and roles that speak against an element's being part of the article, for reader comments, and for it.
AGAINST = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs cookie cookies consent gdpr notice alert popup modal overlay footer"
    " masthead menu nav navbar navigation sidebar widget widgets promo promotion sponsor sponsored related recommended recommendations share"
    " sharing social subscribe newsletter signup login toolbar pagination pager tags skip copyright complementary contentinfo dialog".split()
)
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
FOR = frozenset("article articlebody post entry story content main body text prose".split())
#: First words of class names that tell a state or a topic of the page, and last ones.
_STATE, _STATE_END = frozenset("has no with without is not show hide single type tag category".split()), frozenset("open closed enabled active".split())
_NAMES = re.compile(r"[\s]+")
_PARTS = re.compile(r"[_-]+|(?<=[a-z])(?=[A-Z])")

#: Elements whose names are signs, where they hold neither an article nor most of the page.
SIGNS = ("nav", "footer", "aside", "header", "form", "menu", "dialog", "button", "label", "search", "address")
KINDS = ("p", "li", "h1", "h2", "h3", "td", "th", "blockquote", "pre", "figcaption", "dd", "dt", "a", "div")
FEATURES = (
    "any", "words3", "words9", "words24", "words59", "words_more", "sentence", "links0", "links_some", "links_most", "links_all",
    *(f"kind_{k}" for k in KINDS), "kind_other", *(f"in_{k}" for k in SIGNS), "in_article", "in_main", "against", "comments", "for",
    "with_prose", "near_prose", "off_prose", "first", "last",
)
_PLACE = {name: k for k, name in enumerate(FEATURES)}
#: Most that the classifier says for or against a block; words from which a block without many links is prose, and the
#: share of all prose that an element must hold to be where the article is.
BOUND, PROSE, MOST_PROSE = 3.0, 10, 0.6
#: Sorts of edges: page neighbours with the same parent, close in the tree, or far; and the next block of the same grandparent.
SAME, CLOSE, FAR, SIBLING = range(4)


@dataclass(slots=True)
class Element:
    name: str
    parent: Element | None
    depth: int
    hidden: bool
    #: Which of "against", "comments" and "for" its class names, id or role say.
    marks: tuple[str, ...] = ()
    #: Within it: characters, words of prose, an article or main element, and a first heading.
    chars: int = 0
    prose: int = 0
    holds_article: bool = False
    holds_heading: bool = False
    #: What it and those around it are: in an article, among comments, beside any article, at home in the prose; all signs.
    in_article: bool = False
    in_comments: bool = False
    in_aside: bool = False
    at_home: bool = False
    signs: frozenset[str] = frozenset()


@dataclass(slots=True)
class Block:
    parts: list[str]
    parent: Element
    link_chars: int = 0
    text: str = field(default="")


def _said(value: str) -> set[str]:
    """What the class names or the id in an attribute say."""
    out = set()
    for name in _NAMES.split(value):
        words = [w.lower() for w in _PARTS.split(name) if w]
        if words and words[0] not in _STATE and words[-1] not in _STATE_END:
            out |= {sign for sign, known in (("against", AGAINST), ("comments", COMMENTS), ("for", FOR)) if not known.isdisjoint(words)}
    return out


def _open(name: str, attributes: str, parent: Element) -> Element:
    hidden = parent.hidden or name in UNSEEN
    said: set[str] = set()
    if attributes and "=" in attributes or "hidden" in attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id", "role", "itemprop"):
                said |= _said(value)
            elif key == "hidden" and attributes[m.start() - 1 : m.start()].isspace() and not value.lower().startswith("false"):
                hidden = True
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
                hidden = True
    return Element(name, parent, parent.depth + 1, hidden, tuple(sorted(said)))


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order, with their place in the element tree."""
    at, root = 0, Element("", None, 0, False)
    here, links = root, 0
    block = Block([], root)
    out: list[Block] = []

    def text(raw: str) -> None:
        if here.name == "head" and raw.strip(" \t\n\f\r"):
            leave()
        if raw and not here.hidden:
            block.parts.append(html.unescape(raw))
            if links:
                block.link_chars += len(raw)

    def finish() -> None:
        nonlocal block
        if block.parts:
            block.text = " ".join("".join(block.parts).split())
            if block.text:
                out.append(block)
        block = Block([], here)

    open_names: dict[str, int] = {}

    def leave() -> None:
        nonlocal here, links
        open_names[here.name] -= 1
        links -= here.name == "a"
        here = here.parent

    while True:
        m = _TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            if m.group().startswith("<![CDATA["):
                text(m.group()[9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        closes = m["close"] or m["close2"]
        if here.name == "head" and (name not in _IN_HEAD and not closes or name in ("body", "html", "br") and closes):
            leave()
        breaks = name in BLOCKS
        if name == "br":
            block.parts.append(" ")
            continue
        if breaks:
            finish()
        if closes:
            if open_names.get(name):
                while here.name != name:
                    leave()
                leave()
            if breaks:
                block.parent = here
            continue
        if breaks and open_names.get("p"):
            _close_to(here, "p", leave, lambda: here)
        if name in _ENDS_SAME and open_names.get(name):
            _close_to(here, name, leave, lambda: here, _ENDS_SAME[name])
        attributes = m["attrs"] if m["attrs"] is not None else m["attrs2"] or ""
        if name in _EMPTY or name in _FOREIGN and attributes.endswith("/"):
            continue
        if name in _RAW:
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else len(page)
            continue
        if attributes.endswith("/") and name not in BLOCKS:
            continue
        here = _open(name, attributes, here)
        open_names[name] = open_names.get(name, 0) + 1
        links += name == "a"
        if breaks:
            block.parent = here
    finish()
    return out


def _close_to(element: Element, name: str, leave, current, stop: tuple[str, ...] = ("article", "section", "div", "td", "body", "blockquote")) -> None:
    """Leaves up to and with the nearest open element of this name, unless a container stands between."""
    probe = element
    while probe and probe.name != name:
        if probe.name in stop:
            return
        probe = probe.parent
    if probe:
        while current() is not probe:
            leave()
        leave()


def _link_share(block: Block) -> float:
    return min(1.0, block.link_chars / max(1, len(block.text)))


def survey(blocks: list[Block]) -> Element | None:
    """Notes on all elements what they hold and what they stand in; gives the innermost one with most of the prose.

    A few passes over the elements, so that the depth of a page costs nothing.
    """
    seen: dict[int, Element] = {}
    for block in blocks:
        e: Element | None = block.parent
        while e and id(e) not in seen:
            seen[id(e)] = e
            e = e.parent
    elements = sorted(seen.values(), key=lambda e: e.depth)
    for block in blocks:
        block.parent.chars += len(block.text)
    for e in reversed(elements):
        if e.parent:
            e.parent.chars += e.chars
            e.parent.holds_article |= e.holds_article or e.name in ("article", "main")
            e.parent.holds_heading |= e.holds_heading or e.name == "h1"
    total, article = sum(len(b.text) for b in blocks), False
    for e in elements:
        above = e.parent
        e.in_article = e.name in ("article", "main") or bool(above and above.in_article)
        e.in_comments = "comments" in e.marks or bool(above and above.in_comments)
        article |= e.in_article and not e.in_comments
    for e in elements:
        own = _signs(e, total, article)
        e.signs = own | (e.parent.signs if e.parent else frozenset())
        e.in_aside = not own.isdisjoint(("against", "comments", "in_nav", "in_footer", "in_aside")) or bool(e.parent and e.parent.in_aside)
    words = [0 if b.parent.in_aside or _link_share(b) >= 0.5 else b.text.count(" ") + 1 for b in blocks]
    least = PROSE if any(n >= PROSE for n in words) else 1  # a page of short lines has these for its prose
    for block, n in zip(blocks, words, strict=True):
        block.parent.prose += n if n >= least else 0
    for e in reversed(elements):
        if e.parent:
            e.parent.prose += e.prose
    all_prose = sum(n for n in words if n >= least)
    homes = [e for e in elements if e.prose and e.prose >= MOST_PROSE * all_prose]
    home = max(homes, key=lambda e: e.depth, default=None)
    for e in elements:
        e.at_home = e is home or bool(e.parent and e.parent.at_home)
    return home


def _signs(e: Element, total: int, article: bool) -> frozenset[str]:
    """What an element says of its blocks on a page of so many characters; article: the page has one."""
    found = set()
    if e.name in ("article", "main"):
        found.add(f"in_{e.name}")
    aside = not e.holds_article and (2 * e.chars < total or (article and not e.in_article))
    if aside and e.name in SIGNS and not (e.name == "header" and e.in_article):
        found.add(f"in_{e.name}")
    if "comments" in e.marks and 10 * e.chars < 9 * total and not e.holds_article and not e.holds_heading:
        found.add("comments")
    if "against" in e.marks and aside and not e.holds_heading and e.name not in ("article", "main"):
        found.add("against")
    if "for" in e.marks:
        found.add("for")
    return frozenset(found)


def evidence(block: Block, place: float, home: Element | None) -> list[int]:
    """Places of the features that hold for a block at this share of a surveyed page."""
    words, links, parent = block.text.count(" ") + 1, _link_share(block), block.parent
    on = ["any", *parent.signs]
    on.append("words3" if words < 4 else "words9" if words < 10 else "words24" if words < 25 else "words59" if words < 60 else "words_more")
    on.append("links0" if links == 0 else "links_some" if links < 0.34 else "links_most" if links < 0.8 else "links_all")
    if block.text.endswith((".", "!", "?", "…", "。", ".”", '."')):
        on.append("sentence")
    on.append(f"kind_{parent.name}" if parent.name in KINDS else "kind_other")
    if home is not None:
        on.append("off_prose" if not parent.at_home else "with_prose" if parent.depth - home.depth <= 2 else "near_prose")
    if place < 0.1:
        on.append("first")
    if place > 0.9:
        on.append("last")
    return [_PLACE[name] for name in on]


def rows_of(blocks: list[Block]) -> list[list[int]]:
    """Features of all blocks of a page, whose elements must not have been surveyed before."""
    home = survey(blocks)
    total, seen, out = sum(len(b.text) for b in blocks), 0, []
    for block in blocks:
        out.append(evidence(block, (seen + len(block.text) / 2) / max(1, total), home))
        seen += len(block.text)
    return out


@dataclass(frozen=True)
class Model:
    """Weights of the features and of the sorts of edges."""

    weights: tuple[float, ...]
    ties: tuple[float, ...]

    def costs(self, rows: list[list[int]]) -> list[float]:
        """Above 0: for the article."""
        return [max(-BOUND, min(BOUND, sum(self.weights[k] for k in row))) for row in rows]

    def cut(self, rows: list[list[int]], edges: list[tuple[int, int, int]]) -> list[bool]:
        return least_cut(self.costs(rows), [(a, b, self.ties[sort]) for a, b, sort in edges])

    def labels(self, blocks: list[Block]) -> list[bool]:
        return self.cut(rows_of(blocks), edges_of(blocks))


def _apart(a: Element, b: Element) -> int:
    """Steps between two elements of the tree."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def edges_of(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """Smoothness: page neighbours, by their distance in the tree, and the next block of the same grandparent."""
    edges = []
    last: dict[int, int] = {}
    for k, block in enumerate(blocks):
        if k:
            apart = _apart(blocks[k - 1].parent, block.parent)
            edges.append((k - 1, k, SAME if apart <= 2 and block.parent.parent is blocks[k - 1].parent.parent else CLOSE if apart <= 3 else FAR))
        above = id(block.parent.parent or block.parent)
        if above in last and last[above] != k - 1:
            edges.append((last[above], k, SIBLING))
        last[above] = k
    return edges


def least_cut(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: article) of least cost: -cost of each one labelled against it, weight of each edge between labels.

    Of several least cuts, the one with fewest blocks labelled True.
    """
    n = len(costs)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, w in edges:
        near[a].append((b, w))
        near[b].append((a, w))
    label: list[bool | None] = [None] * n
    own = list(costs)
    tie = [sum(w for _, w in x) for x in near]
    ready = deque(k for k in range(n) if abs(own[k]) > tie[k])
    while ready:  # settled blocks pull their neighbours, which may settle these
        k = ready.popleft()
        if label[k] is not None:
            continue
        label[k] = own[k] > 0
        for b, w in near[k]:
            if label[b] is None:
                own[b] += w if label[k] else -w
                tie[b] -= w
                if abs(own[b]) > tie[b] + 1e-12:
                    ready.append(b)
    rest = [k for k in range(n) if label[k] is None]
    if rest:
        index = {k: i for i, k in enumerate(rest)}
        flow = Flow(len(rest) + 2)
        source, sink = len(rest), len(rest) + 1
        for k in rest:
            if own[k] > 0:
                flow.edge(source, index[k], own[k], 0.0)
            elif own[k] < 0:
                flow.edge(index[k], sink, -own[k], 0.0)
        for a, b, w in edges:
            if a in index and b in index:
                flow.edge(index[a], index[b], w, w)
        side = flow.cut(source, sink)
        for k in rest:
            label[k] = side[index[k]]
    return [bool(x) for x in label]


class Flow:
    """Dinic's maximum flow on real capacities."""

    def __init__(self, n: int) -> None:
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[float] = []

    def edge(self, a: int, b: int, there: float, back: float) -> None:
        for start, end, room in ((a, b, there), (b, a, back)):
            self.out[start].append(len(self.to))
            self.to.append(end)
            self.room.append(room)

    def _levels(self, source: int) -> list[int]:
        level = [-1] * len(self.out)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                if self.room[e] > 1e-9 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def cut(self, source: int, sink: int) -> list[bool]:
        """Which nodes are on the source's side."""
        while (level := self._levels(source))[sink] >= 0:
            turn = [0] * len(self.out)
            path: list[int] = []
            a = source
            while True:
                if a == sink:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    cut = next(k for k, e in enumerate(path) if self.room[e] <= 1e-9)
                    a = self.to[path[cut] ^ 1]
                    del path[cut:]
                    continue
                while turn[a] < len(self.out[a]):
                    e = self.out[a][turn[a]]
                    if self.room[e] > 1e-9 and level[self.to[e]] == level[a] + 1:
                        break
                    turn[a] += 1
                else:
                    if a == source:
                        break
                    level[a] = -2
                    e = path.pop()
                    a = self.to[e ^ 1]
                    continue
                path.append(e)
                a = self.to[e]
        return [x >= 0 for x in self._levels(source)]


# --- learning -------------------------------------------------------------------------------------

#: Pages that the weights are learnt from, and steps and ridge of the learning.
EXAMPLES, STEPS, RIDGE = 600, 12, 2.0
#: Edges by sort, and the sizes of them that are tried.
TIES, SIZES = (1.0, 0.5, 0.25, 0.5), (1.0, 1.5, 2.0)

_SYLLABLES = "an be cor du el fa gri ho in ja ko lu mar no or pa qui ra sen ti ur ve wo xi ya zo".split()


#: Stands before each block of an article in a written page.
MARK = "\ue000"


def examples(count: int = EXAMPLES, seed: int = 10) -> Iterator[str]:
    """Written pages, the blocks of their articles marked."""
    rnd = random.Random(seed)

    def words(least: int, most: int) -> str:
        return " ".join("".join(rnd.choices(_SYLLABLES, k=rnd.randrange(1, 4))) for _ in range(rnd.randrange(least, most)))

    def sentence(least: int = 4, most: int = 18) -> str:
        return words(least, most).capitalize() + rnd.choice([".", ".", ".", "!", "?"])

    def prose(least: int = 1, most: int = 6) -> str:
        return " ".join(sentence() for _ in range(rnd.randrange(least, most)))

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{k}">{words(1, 4)}</a></li>' for k in range(n))

    def name(*names: str) -> str:
        chosen = rnd.choice(["", *names, *names])
        return rnd.choice([f' class="{chosen}"', f' class="x {chosen} y"', f' id="{chosen}"']) if chosen else ""

    def article() -> str:
        html_parts = []

        def add(tag: str, inside: str) -> None:
            html_parts.append(f"<{tag}>{MARK}{inside}</{tag}>")

        add(rnd.choice(["h1", "h1", "h2"]), words(2, 9))
        short = rnd.random() < 0.1  # an article of short lines
        for _ in range(rnd.randrange(4, 30) if short else rnd.randrange(0, 9) or 1):
            kind = rnd.choice([6, 6, 6, 14]) if short else rnd.randrange(15)
            if kind < 7:
                add("p", prose() if kind < 5 else sentence(1, 5))
            elif kind == 7:
                add("h2", words(1, 6))
                add("p", prose())
            elif kind == 8:
                start = len(html_parts)
                for _ in range(rnd.randrange(2, 6)):
                    add("li", rnd.choice([words(1, 6), sentence()]))
                html_parts[start:] = ["<ul>", *html_parts[start:], "</ul>"]
            elif kind == 9:
                start = len(html_parts)
                for _ in range(rnd.randrange(2, 4)):
                    html_parts.append("<tr>")
                    for _ in range(3):
                        add(rnd.choice(["td", "td", "th"]), rnd.choice([words(1, 3), str(rnd.randrange(1000))]))
                    html_parts.append("</tr>")
                html_parts[start:] = ["<table>", *html_parts[start:], "</table>"]
            elif kind == 10:
                add("blockquote", prose(1, 3))
            elif kind == 11:
                add("figcaption", words(3, 10))
            elif kind == 12:
                add("p", f'{sentence()} <a href="/l">{words(2, 5)}</a> {sentence()}')
            elif kind == 13:
                add(rnd.choice(["pre", "h3", "div"]), words(2, 8))
            else:  # text that is no sentence
                add("p", rnd.choice([words(1, 30), " | ".join(words(1, 2) for _ in range(rnd.randrange(2, 9))), f"{words(1, 2)} " * rnd.randrange(2, 30)]).strip())
        for _ in range(rnd.choice([0, 0, 1, 2])):  # an advert or a form amid the article, where no list or table is open
            spots = [k for k in range(1, len(html_parts) + 1) if "".join(html_parts[:k]).count("<table") == "".join(html_parts[:k]).count("</table")
                     and "".join(html_parts[:k]).count("<ul") == "".join(html_parts[:k]).count("</ul")]
            html_parts.insert(rnd.choice(spots), rest())
        return "".join(html_parts)

    def rest() -> str:
        """Something that is no part of the article."""
        kind = rnd.randrange(12)
        if kind == 0:
            return f"<aside{name('sidebar', 'widget-area')}><h3>{words(1, 3)}</h3><ul>{links(rnd.randrange(2, 7))}</ul></aside>"
        if kind == 1:
            return f"<div{name('related-posts', 'recommended')}><h3>{words(1, 3)}</h3>{''.join(f'<p><a>{sentence()}</a></p>' for _ in range(3))}</div>"
        if kind == 2:
            return f'<div class="{rnd.choice(["ad", "ads-box", "advert", "sponsored", "promo"])}">{rnd.choice([words(2, 8), prose(1, 3)])}</div>'
        if kind == 3:
            return f'<div class="{rnd.choice(["cookie-notice", "gdpr", "consent-banner", "notice alert"])}"><p>{prose(1, 3)}</p><button>{words(1, 3)}</button></div>'
        if kind == 4:
            return f"<form{name('newsletter', 'signup')}><label>{words(1, 4)}</label><p>{sentence()}</p><button>{words(1, 2)}</button></form>"
        if kind in (5, 6):
            reader = "".join(
                f'<{tag}{name("comment", "reply")}><b>{words(1, 3)}</b><p>{prose(1, 4)}</p><a>{words(1, 2)}</a></{tag}>'
                for tag in [rnd.choice(["li", "div", "article"])] * rnd.randrange(1, 6)
            )
            return f'<section class="{rnd.choice(["comments", "comment-list", "discussion"])}"><h3>{words(1, 3)}</h3>{reader}</section>'
        if kind == 7:
            return f"<div{name('share', 'social-links')}>{''.join(f'<a>{words(1, 2)}</a>' for _ in range(4))}</div>"
        if kind == 8:
            return f"<nav{name('breadcrumb')}><a>{words(1, 2)}</a> » <a>{words(1, 2)}</a></nav>"
        if kind == 9:
            return f"<ul{name('menu', 'nav')}>{links(rnd.randrange(3, 8))}</ul>"
        if kind == 10:
            return f"<div{name('tags', 'pagination')}>{''.join(f'<a>{words(1, 2)}</a> ' for _ in range(4))}</div>"
        return f"<aside><p>{prose(1, 3)}</p></aside>"

    for _ in range(count):
        if rnd.random() < 0.08:  # a page of text and nothing else
            texts = [MARK + rnd.choice([sentence(), prose()]) for _ in range(rnd.randrange(1, 4))]
            tag = rnd.choice(["p", "p", "div", ""])
            yield f"<body>{''.join(f'<{tag}>{t}</{tag}>' for t in texts)}" if tag else f"<body>{texts[0]}{rnd.choice(['', '<footer>' + sentence() + '</footer>'])}"
            continue
        body = article() if rnd.random() < 0.95 else MARK + prose()
        tag = rnd.choice(["article", "article", "article", "main", "div", "div", "section"])
        plain = "" if tag in ("article", "main") else rnd.choice(['class="post-content"', 'id="content"', 'class="entry"', "", 'class="wrap"'])
        kinds = ["", "", 'class="post type-post tag-bridge category-news"', 'class="content-with-sidebar"']
        kind = rnd.choice([*kinds, 'class="legal notice"'] if tag in ("article", "main") else kinds)
        body = f"<{tag} {plain or kind}>{body}</{tag}>"
        if rnd.random() < 0.3:
            after = rest() if rnd.random() < 0.5 else ""
            body = f"<main>{body}{after}</main>" if tag != "main" else f"<div>{body}{after}</div>"
        top = [
            f"<header{name('site-header', 'masthead')}><div>{words(1, 3)}</div>{rnd.choice(['', f'<h1>{words(1, 3)}</h1>'])}<p>{words(2, 8)}</p></header>",
            f"<nav><ul>{links(rnd.randrange(3, 8))}</ul></nav>",
            *(rest() for _ in range(rnd.randrange(0, 2))),
        ]
        bottom = [*(rest() for _ in range(rnd.randrange(0, 4))), f"<footer><p>© {words(2, 8)}</p>{rnd.choice(['', f'<p>{prose(1, 3)}</p>'])}</footer>"]
        page = "".join([*(t for t in top if rnd.random() < 0.6), body, *(b for b in bottom if rnd.random() < 0.8)])
        if rnd.random() < 0.15:
            page = f"<form>{page}</form>"
        state = rnd.choice(["", "", "right-sidebar", "home has-sidebar", "nav-open", "no-sidebar", "comments-open"])
        yield f'<html><head><title>{words(2, 5)}</title></head><body class="{state}">{page}</body></html>'


def marked_blocks(page: str) -> tuple[list[Block], list[bool]]:
    """The blocks of a written page, without marks, and which are its article's."""
    found = blocks_of(page)
    truth = [b.text.startswith(MARK) for b in found]
    for block in found:
        block.text = block.text.removeprefix(MARK).strip()
    return found, truth


def _measured(count: int, seed: int) -> list[tuple[list[list[int]], list[tuple[int, int, int]], list[bool]]]:
    """Features, edges and true labels of some written pages."""
    out = []
    for page in examples(count, seed):
        found, truth = marked_blocks(page)
        out.append((rows_of(found), edges_of(found), truth))
    return out


@cache
def learnt() -> Model:
    """Logistic weights from the written pages, and the edges under which cuts of further ones are right most often.

    The same ones every time.
    """
    pages = _measured(EXAMPLES, 10)
    rows = [row for page, _, _ in pages for row in page]
    x, y = np.zeros((len(rows), len(FEATURES))), np.array([good for _, _, truth in pages for good in truth], float)
    for k, row in enumerate(rows):
        x[k, row] = 1
    w = np.zeros(len(FEATURES))
    for _ in range(STEPS):  # Newton's steps
        p = 1 / (1 + np.exp(-(x @ w)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w))
        w = w + np.linalg.solve(curve, x.T @ (y - p) - RIDGE * w)
    others = _measured(EXAMPLES // 4, 11)
    models = [Model(tuple(w.tolist()), tuple(size * t for t in TIES)) for size in SIZES]

    def right(model: Model) -> int:
        return sum(
            a == b
            for page, edges, truth in others
            for a, b in zip(model.cut(page, edges), truth, strict=True)
        )

    return max(models, key=lambda m: (right(m), m.ties))


# --- over pages -----------------------------------------------------------------------------------


def main_text(page: str | None, model: Model | None = None) -> str:
    if not page:
        return ""
    found = blocks_of(page)
    labels = (model or learnt()).labels(found)
    return " ".join(b.text for b, good in zip(found, labels, strict=True) if good)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for every row of pages (page_id, url, html)."""
    model = learnt()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [main_text(p.as_py(), model) for p in part.column("html")]
                # a reference may name half of a surrogate pair, which no text can hold
                texts = [t.encode("utf-8", "replace").decode() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return scan(rows, work, "page_id long, url string, text string, n_chars long")

"""Main text of web pages by scoring the element tree.

Menus, headers, footers, sidebars, notices, adverts, forms, comments of readers, scripts
and styles are taken out first, by element, role and the words of class and id. Then
each block of text passes points to its ancestors: one, one for each comma and one for
each hundred characters; its parent gets all of them, its grandparent half, those above
ever less. An element's points are discounted by the share of its text inside links.
The article is all of the <article> or <main> around the best element, with those siblings
that have a fair part of its points; on a page without them it is all that is left. Lists
and sections inside that are mostly links are left out. Time grows with the page only: no
element looks at all that are around it.

Pages are read independently in one pass; nothing is shuffled or shared.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from logweir.llm.frames import map_texts

# Fixed values of HTML: elements by how they are read.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg",
       "annotation", "annotation-xml", "noframes", "xmp", "object", "canvas", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del",
          "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "ruby", "rp", "rt",
          "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
          "wbr", "picture", "nobr", "math", "mi", "mn", "mo", "mrow", "ms", "mtext", "mfrac", "msqrt",
          "mroot", "msub", "msup", "msubsup", "munder", "mover", "munderover", "semantics"}
#: A start tag of the key ends open elements of these kinds, up to a border.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "body": {"head"},
}
BORDERS = {"ul", "ol", "dl", "table", "select", "body", "html"}

# Elements, roles and words of class or id that are not the article.
DROPPED = {"nav", "footer", "aside", "button", "select", "dialog", "menu", "head", "fieldset",
           "search"}
#: Dropped inside a form, which itself is dropped unless it is around most of the page.
CONTROLS = {"label", "legend", "output"}
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog",
                 "alert", "alertdialog", "menu", "menubar", "toolbar", "tooltip"}
DROPPED_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor",
    "sponsored", "promo", "promotion", "banner", "sidebar", "aside", "nav", "navbar", "navigation",
    "menu", "breadcrumb", "breadcrumbs", "footer", "header", "masthead", "comment", "comments",
    "disqus", "reply", "replies", "respond", "cookie", "cookies", "consent", "gdpr", "notice",
    "notices", "notification", "alert", "newsletter", "subscribe", "subscription", "signup",
    "login", "signin", "popup", "modal", "overlay", "share", "sharing", "social", "related",
    "recommended", "recommendations", "widget", "toolbar", "pagination", "pager", "hidden",
    "skip", "disclaimer", "paywall", "form", "search",
}
#: Of these, words that articles are named with as well: a compound of them and of other
#: words than these and PLACES is no menu or notice (job-search, form-guide, entry-header).
COMMON_WORDS = {"search", "form", "alert", "notice", "notices", "header", "masthead", "hidden",
                "skip", "share", "reply", "respond", "subscription", "promotion", "promo",
                "notification", "disclaimer", "banner", "comment", "menu", "social", "related",
                "recommended", "paywall", "consent", "footer", "aside"}
PLACES = {"site", "page", "top", "bottom", "left", "right", "main", "global", "primary",
          "secondary", "box", "bar", "wrapper", "wrap", "container", "block", "section", "area",
          "inner", "outer", "button", "buttons", "link", "links", "list", "items", "item", "text",
          "message", "icon", "icons", "posts", "articles", "stories", "mobile", "desktop", "policy",
          "content", "widget", "header", "footer", "body", "field", "input", "contact", "media",
          "thread", "to", "title", "nav"}
#: A class that begins or ends so says how a page is laid out, not what the element is.
MODIFIERS = {"has", "no", "with", "without", "is", "not", "hide", "show", "hides", "shows"}
STATES = {"open", "opened", "closed", "enabled", "disabled", "active", "visible", "on", "off"}
HEADER_WORDS = {"header", "masthead"}
#: What readers write is often longer than the article.
READER_WORDS = {"comment", "comments", "disqus", "reply", "replies", "respond"}
ARTICLE_WORDS = {"article", "articlebody", "content", "entry", "main", "post", "story", "body"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

# A value in quotes begins right after its "="; a quote anywhere else is a letter of a name
# or of a value without quotes.
_VALUE = r"""[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+"""
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/=]++|{_VALUE})*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)))?""", re.S
)
_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PARENTS = 6
#: A list, table or section with more of its text inside links than this is a menu.
MENU_LINKS_INSIDE = 0.66


class _Node:
    __slots__ = ("tag", "parent", "block", "bonus", "score", "chars", "linked", "named", "plain",
                 "prose", "state")

    def __init__(self, tag: str, parent: _Node | None, bonus: float = 0.0):
        self.tag, self.parent, self.bonus = tag, parent, bonus
        # The element that text right here is a block of.
        self.block = parent.block if tag in INLINE and parent else self
        self.score = 0.0
        self.chars = self.linked = self.plain = self.prose = 0
        self.state = 0
        self.named: set[str] | None = None  # words of class or id that speak against it


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(a or b or c))
    return found


def _is_dropped(tag: str, values: dict[str, str]) -> bool:
    if tag in DROPPED or "hidden" in values or values.get("aria-hidden", "").lower() == "true":
        return True
    if tag in {"html", "body", "article", "main"}:
        return False
    if values.get("role", "").lower() in DROPPED_ROLES or _HIDDEN.search(values.get("style", "")):
        return True
    return False


def _named(tag: str, values: dict[str, str]) -> set[str]:
    """DROPPED_WORDS that the class or id names the element by; none for page and article."""
    found: set[str] = {"form"} if tag == "form" else set()
    if tag in {"html", "body", "main"} or not ("class" in values or "id" in values):
        return found
    for token in f"{values.get('class', '')} {values.get('id', '')}".split():
        words = [w.lower() for w in _WORD.findall(token)]
        own = [w for w in words if w in DROPPED_WORDS]
        if not own or words[0] in MODIFIERS or words[-1] in STATES:
            continue
        ends = {words[0], words[-1]} & DROPPED_WORDS
        plain = all(w in DROPPED_WORDS or w in PLACES for w in words)
        if plain or ends - COMMON_WORDS:
            found.update(own)
    return found & READER_WORDS if tag == "article" else found


def _bonus(tag: str, values: dict[str, str]) -> float:
    if tag in {"article", "main"} or values.get("role", "").lower() == "main":
        return 25.0
    names = f"{values.get('class', '')} {values.get('id', '')} {values.get('itemprop', '')}"
    return 10.0 if any(w.lower() in ARTICLE_WORDS for w in _WORD.findall(names)) else 0.0


class _Reader:
    """Reads a page into blocks: (element, text, characters inside links)."""

    def __init__(self):
        self.root = _Node("", None)
        self.nodes = [self.root]  # in the order of the page: parents before what is in them
        self.stack = [self.root]
        self.open: Counter[str] = Counter()  # elements on the stack, by tag
        self.dropped = 0  # depth of the outermost dropped element, or 0
        self.headers: list[int] = []  # depths of header elements inside an article
        self.links = 0
        self.blocks: list[tuple[_Node, str, int]] = []
        self.parts: list[str] = []
        self.linked = 0

    def text(self, text: str) -> None:
        if self.dropped or not text:
            return
        if self.headers and not any(self.open[h] for h in HEADINGS):
            return
        self.parts.append(text)
        if self.links:
            self.linked += len("".join(unescape(text).split()))

    def flush(self) -> None:
        if self.parts:
            # Decoded as a whole: a reference may not be cut by a tag, so pieces are apart.
            text = " ".join("".join(map(unescape, self.parts)).split())
            if text:
                self.blocks.append((self.stack[-1].block, text, self.linked))
            self.parts, self.linked = [], 0

    def start(self, tag: str, rest: str) -> None:
        if tag == "br":
            self.text(" ")
            return
        if tag not in INLINE:
            self.flush()
            self._end_open(tag)
        if tag in VOID:
            return
        values = _attributes(rest) if rest and not rest.isspace() else {}
        node = _Node(tag, self.stack[-1], _bonus(tag, values))
        self.stack.append(node)
        self.nodes.append(node)
        self.open[tag] += 1
        depth = len(self.stack) - 1
        in_article = self.open["article"] or self.open["main"]
        if not self.dropped:
            if tag == "header":
                if in_article:
                    self.headers.append(depth)
                else:
                    self.dropped = depth
            elif (
                _is_dropped(tag, values) or (tag in CONTROLS and self.open["form"])
                or (tag == "form" and in_article)
            ):
                self.dropped = depth
            elif named := _named(tag, values):
                if in_article and named <= HEADER_WORDS:
                    self.headers.append(depth)
                else:
                    node.named = named
        if tag == "a":
            self.links += 1

    def _end_open(self, tag: str) -> None:
        """Ends what the start of a block ends without a tag of its own: p, li, td, ..."""
        ended = ENDS.get(tag, set())
        if not self.open["p"] and not any(self.open[x] for x in ended):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            name = self.stack[depth].tag
            if name in ended or name == "p":
                self._cut(depth)
                if name == "p" and not ended:
                    return
            elif name in BORDERS or (not ended and name not in INLINE):
                return

    def end(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        if not self.open[tag]:
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            name = self.stack[depth].tag
            if name == tag:
                self._cut(depth)
                return
            if tag in INLINE and name not in INLINE:
                return
            if tag not in BORDERS and name in BORDERS and tag in {"li", "td", "th", "tr", "p"}:
                return

    def _cut(self, depth: int) -> None:
        self.links -= sum(n.tag == "a" for n in self.stack[depth:])
        self.open.subtract(n.tag for n in self.stack[depth:])
        del self.stack[depth:]
        if self.dropped >= depth:
            self.dropped = 0
        while self.headers and self.headers[-1] >= depth:
            self.headers.pop()


def _read(html: str) -> _Reader:
    reader = _Reader()
    at = 0
    while True:
        found = _TAG.search(html, at)
        if not found:
            reader.text(html[at:])
            break
        reader.text(html[at : found.start()])
        at = found.end()
        closing, name, rest = found.groups()
        if not name:
            continue
        tag = name.lower()
        if closing:
            if tag not in RAW:  # those are skipped whole, in the middle of a sentence too
                reader.end(tag)
        elif tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
            at = end.start() if end else len(html)
        else:
            reader.start(tag, rest)
    reader.flush()
    return reader


Blocks = list[tuple[_Node, str, int]]
#: States of an element: kept, left out, a list of links inside what is kept.
_KEPT, _OUT, _LIST = 1, 2, 3


def _without_named(nodes: list[_Node], blocks: Blocks) -> Blocks:
    """Blocks that are in no element whose class or id speaks against it.

    An element is kept for all that if it holds the page's <main>, its article, or most of
    its unlinked text (what readers write aside); a form, most of its paragraphs. With
    what readers write goes what is only around it: a heading, an empty section.
    """
    if not any(x.named for x in nodes):
        return blocks
    inside: dict[_Node, bool] = {}
    for x in nodes:
        inside[x] = bool(x.named) or (x.parent is not None and inside[x.parent])
    total = outside = 0
    for node, text, linked in blocks:
        size = max(0, len(text) - linked)
        node.plain += size
        total += size
        outside += 0 if inside[node] else size
        if node.tag in {"p", "li", "pre", "blockquote", "article", *HEADINGS}:
            node.prose += size
    articles: list[_Node] = []
    mains: set[int] = set()
    for x in reversed(nodes):
        if x.parent is not None:
            x.parent.plain += x.plain
            x.parent.prose += x.prose
        if x.tag == "article" and x.plain and not x.named:
            articles.append(x)
        if x.tag == "main" or id(x) in mains:
            mains.update((id(x), id(x.parent)))
    holds: set[int] = set()
    above = max(reversed(articles), key=lambda x: x.plain, default=None)
    if above is not None and above.plain > outside:
        while above is not None:
            holds.add(id(above))
            above = above.parent
    by_readers: dict[int, int] = {}  # of each element: text that readers have written
    heads: dict[int, int] = {}  # of each element: text of headings that are not in there
    for node, text, _ in blocks:
        if node.tag in HEADINGS:
            heads[id(node)] = heads.get(id(node), 0) + len(text)
    for x in nodes:
        out = x.parent is not None and x.parent.state == _OUT
        if x.named and not out and id(x) not in mains:
            most = 2 * (x.prose if "form" in x.named else x.plain) > total
            out = bool(x.named & READER_WORDS) or not (id(x) in holds or most)
        x.state = _OUT if out else _KEPT
    text_of: dict[int, int] = {}
    for node, text, _ in blocks:
        text_of[id(node)] = text_of.get(id(node), 0) + len(text)
    for x in reversed(nodes):
        own = by_readers.get(id(x), 0)
        if x.state == _OUT and x.named and x.named & READER_WORDS:
            own = text_of.get(id(x), 0)
            heads[id(x)] = 0
        by_readers[id(x)] = own
        if x.parent is not None:
            up = id(x.parent)
            text_of[up] = text_of.get(up, 0) + text_of.get(id(x), 0)
            by_readers[up] = by_readers.get(up, 0) + own
            heads[up] = heads.get(up, 0) + heads.get(id(x), 0)
    for x in nodes:
        # The page itself is not a thread of comments, nor is what holds its article.
        if x.parent is not None and x.parent.state == _OUT:
            x.state = _OUT
        elif (
            x.tag in {"section", "div", "ul", "ol"} and x.state == _KEPT and id(x) not in holds
            and id(x) not in mains and by_readers[id(x)]
            and by_readers[id(x)] + heads.get(id(x), 0) == text_of.get(id(x), 0)
        ):
            x.state = _OUT
    return [b for b in blocks if b[0].state != _OUT]


def _container(best: _Node) -> _Node:
    """The whole article around the best element: the outermost <article> or <main> around
    it, or else the body of the page."""
    whole, above = None, best
    while above.parent is not None:
        if above.tag in {"article", "main"}:
            whole = above
        above = above.parent
    return whole or above


def main_text(html: str | None) -> str:
    """The article of a page: its blocks, each with single spaces, joined by newlines."""
    if not html:
        return ""
    reader = _read(html)
    nodes, blocks = reader.nodes, _without_named(reader.nodes, reader.blocks)
    if not blocks:
        return ""
    for node, text, linked in blocks:
        node.chars += len(text)
        node.linked += linked
    for x in reversed(nodes):
        if x.parent is not None:
            x.parent.chars += x.chars
            x.parent.linked += x.linked
    scored: dict[int, _Node] = {}
    for node, text, linked in blocks:
        points = (1 + text.count(",") + len(text) / 100) * (1 - linked / max(1, len(text)))
        # A paragraph passes on its points; a container with text of its own has them.
        above = node.parent if node.tag in {"p", "pre", "blockquote", *HEADINGS} else node
        for step in range(_PARENTS):
            if above is None:
                break
            above.score += points / (1 if step == 0 else 2 if step == 1 else 3 * step)
            scored[id(above)] = above
            above = above.parent

    def worth(node: _Node) -> float:
        share = node.linked / max(1, node.chars)
        return (node.score + node.bonus) * (1 - share)

    best = _container(max(scored.values(), key=worth))
    # Other articles of a page count if they have a fair part of the best one's points.
    least = max(10.0, 0.2 * max(map(worth, scored.values())))
    lists = {"ul", "ol", "dl", "table", "section", "div"}
    for x in nodes:
        up = x.parent.state if x.parent is not None else 0
        if up in {_KEPT, _LIST}:
            menu = x.tag in lists and x.linked > MENU_LINKS_INSIDE * x.chars
            x.state = _LIST if up == _LIST or menu else _KEPT
        else:
            sibling = id(x) in scored and x.parent is best.parent and worth(x) >= least
            x.state = _KEPT if x is best or sibling else 0
    out = []
    for node, text, linked in blocks:
        # A long paragraph or a title beside the article is a sibling of its own.
        beside = not node.state and node.parent is best.parent and (
            (node.tag == "p" and len(text) > 80) or (node.tag == "h1" and not linked)
        )
        if node.state == _KEPT or beside:
            out.append(text)
    return "\n".join(out)


def extract(
    pages: DataFrame, html: str = "html", keep: Sequence[str] | None = None
) -> DataFrame:
    """Every row as struct ``row``, with ``text`` and ``n_chars`` (its code points).

    A null, empty or textless page has the text '' and 0. Broken markup is read as far
    as it goes: open elements end with the page, unknown end tags are ignored. Repeated
    rows each have their text; an empty table gives an empty result.
    """

    def compute(texts: pa.Array) -> list[pa.Array]:
        found = [main_text(x) for x in texts.to_pylist()]
        return [pa.array(found, pa.string()), pa.array(np.array(list(map(len, found)), np.int64))]

    return map_texts(pages, html, "text string, n_chars bigint", compute, keep)

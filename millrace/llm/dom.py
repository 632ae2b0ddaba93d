"""A tolerant reader of HTML into a tree of block elements, and features of its nodes.

Inline elements do not make nodes: their text belongs to the block around them,
with the part that stands in links counted. Elements that never show text are
left out altogether.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe object svg canvas textarea select title head".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var button".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
#: An opening tag ends an open element of these names, up to a boundary.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "option": ({"option"}, {"select"})}
_P_STOPS = frozenset("table td th button object".split())

_NAME = re.compile(r"[a-zA-Z][^\s>/]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*|=[^\s/>=]*)(\s*=\s*)?")
_UNQUOTED = re.compile(r"[^\s>]*")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")

_NAMED = frozenset(("class", "id", "role"))

#: Words in class, id and role attributes, by what they usually name.
TOPICS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar pagination pager tabs toc",
    "head": "header masthead banner logo branding",
    "foot": "footer colophon copyright legal bottom",
    "side": "sidebar aside side rail widget widgets column complementary",
    "advert": "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion dfp",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup",
    "form": "form search login register contact input",
    "comment": "comment comments respond reply replies discussion disqus",
    "social": "share sharing social related recommend recommended more tags meta byline author",
    "content": "article content post entry story main body text page hentry prose",
}
_TOPIC_OF = {word: i for i, words in enumerate(TOPICS.values()) for word in words.split()}
TAGS = ("p", "h1", "h2", "h3", "div", "section", "article", "main", "nav", "header", "footer", "aside",
        "form", "ul", "ol", "li", "table", "td", "blockquote", "pre", "figure", "body", "html")
_TAG_AT = {tag: i for i, tag in enumerate(TAGS)}
_SPLIT_TOPICS = len(TOPICS)


class Node:
    """A block element. ``parts`` holds its text runs and child nodes in page order."""

    __slots__ = ("children", "linked", "parent", "parts", "tag", "topics")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None) -> None:
        self.tag = tag
        self.parent = parent
        self.parts: list[str | Node] = []
        self.children: list[Node] = []
        self.linked = 0
        self.topics = 0
        for name in _NAMED.intersection(attributes):
            for word in _WORD.findall(attributes[name].lower()):
                topic = _TOPIC_OF.get(word)
                if topic is not None:
                    self.topics |= 1 << topic
        if parent is not None:
            parent.parts.append(self)
            parent.children.append(self)


class _Tags:
    """Reads tags in one pass over a page: what is looked at once is not looked at again.

    Quotes enclose values only right behind an equals sign. A tag that does not end, as a
    quote stays open, ends at its first ``>`` after all, and then so do all behind it.
    Without any ``>`` ahead there are no more tags.
    """

    def __init__(self, source: str) -> None:
        self.source = source
        self.last = source.rfind(">")
        self.last_quote = {quote: source.rfind(quote) for quote in "\"'"}
        self.quotes = True

    def tag(self, at: int) -> tuple[dict[str, str], int, bool]:
        """Attributes of the tag whose name ends at ``at``, where it ends, whether it closes itself.

        There must be a ``>`` at or behind ``at``.
        """
        start, source, found = at, self.source, {}
        if source[at] == ">":
            return found, at + 1, False
        while True:
            m = _ATTRIBUTE.match(source, at)
            if m is None:
                end = source.find(">", at)
                if end < 0:
                    break
                return found, end + 1, source[end - 1] == "/"
            name, at, value = m[1].lower(), m.end(), ""
            if m[2]:
                quote = source[at : at + 1]
                if self.quotes and quote in ("\"", "'") and self.last_quote[quote] > at:
                    end = source.index(quote, at + 1)
                    value, at = source[at + 1 : end], end + 1
                else:
                    value = _UNQUOTED.match(source, at)[0]
                    at += len(value)
                    value = value.strip("\"'")
            found.setdefault(name, html.unescape(value) if "&" in value else value)
        self.quotes = False
        return self.tag(start)

    def end(self, at: int) -> int:
        """Behind the next ``>``."""
        return self.source.index(">", at) + 1


def _hidden(attributes: dict[str, str]) -> bool:
    """Whether an element is never shown: by ``hidden``, ``aria-hidden`` or its own style."""
    return (
        "hidden" in attributes
        or attributes.get("aria-hidden", "").strip().lower() == "true"
        or bool(_NO_DISPLAY.search(attributes.get("style", "")))
    )


class _Open:
    """The open elements from the root down, and where those of each name stand."""

    def __init__(self, root: Node) -> None:
        self.path = [root]
        self.places: dict[str, list[int]] = {}

    @property
    def node(self) -> Node:
        return self.path[-1]

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.path))
        self.path.append(node)

    def cut(self, place: int) -> None:
        """Close the element at ``place`` and all in it."""
        while len(self.path) > place:
            self.places[self.path.pop().tag].pop()

    def innermost(self, names) -> int:
        """Where the innermost open element with one of ``names`` stands; 0: there is none."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)


def parse(source: str) -> Node:
    """The tree of a page; unclosed, misplaced and broken tags are made the best of.

    Time grows as the length of the page, whatever it holds.
    """
    root = Node("html", {}, None)
    tags, opened = _Tags(source), _Open(root)
    links, at, size, body, headless = 0, 0, len(source), False, False

    def add(text: str) -> None:
        if text:
            if "&" in text:
                text = html.unescape(text)
            parts = opened.node.parts
            if parts and isinstance(parts[-1], list):
                parts[-1].append(text)
            else:
                parts.append([text])
            if links:
                opened.node.linked += len(text)

    while at < size:
        start = source.find("<", at)
        comment = start >= 0 and source.startswith("<!--", start)
        if start < 0 or (start > tags.last and not comment):
            add(source[at:])
            break
        add(source[at:start])
        at = start + 1
        if comment:
            end = source.find("-->", at + 1)
            at = size if end < 0 else end + 3
            continue
        sign = source[at]
        if sign in "!?":
            at = tags.end(at)
            continue
        m = _NAME.match(source, at + (sign == "/"))
        if m is None:
            add("<")
            continue
        name = m[0].lower()
        attributes, at, empty = tags.tag(m.end())
        if sign == "/":
            if name in _INLINE:
                links -= name == "a" and links > 0
            elif name not in _VOID:
                if place := opened.innermost((name,)):
                    opened.cut(place)
                elif name == "p":
                    add(" ")
            continue
        if name in _VOID:
            add(" ")
            continue
        if name in _RAW or _hidden(attributes):
            if empty:
                continue
            if name != "head":
                at = _behind(source, at, name)
            elif not headless:  # its end tag may be missing
                end = _HEAD_END.search(source, at)
                at, headless = (at, True) if end is None else (end.end(), False)
            add(" ")
            continue
        if name in _INLINE:
            links += name == "a"
            continue
        if name == "html":
            continue
        if name == "body" and opened.node is root and not body:
            body = True
            opened.push(Node("body", attributes, root))
            continue
        links = 0
        ends, stops = (("p",), _P_STOPS) if name in _CLOSES_P else _ENDS.get(name, ((), ()))
        place = opened.innermost(ends)
        if place > opened.innermost(stops):
            opened.cut(place)
        opened.push(Node(name, attributes, opened.node))
    for node in flatten(root):
        node.parts = ["".join(p) if isinstance(p, list) else p for p in node.parts]
    return root


_HEAD_END = re.compile(r"</head\s*>|(?=<body[\s>])", re.IGNORECASE)


def _behind(source: str, at: int, name: str) -> int:
    """Where an element without shown text ends, nested ones of its name included."""
    depth = 1
    nested = name not in ("script", "style", "textarea", "title")
    tag = re.compile(rf"<(/?){re.escape(name)}(?=[\s>/])", re.IGNORECASE)
    while m := tag.search(source, at):
        end = source.find(">", m.end())
        if end < 0:
            break
        at = end + 1
        if m[1]:
            depth -= 1
            if not depth:
                return at
        elif nested:
            depth += 1
    return len(source)


def clean(text: str) -> str:
    return " ".join(text.split())


def flatten(root: Node) -> list[Node]:
    """All nodes, parents before their children, in page order."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(reversed(node.children))
    return out


N_FEATURES = 2 * _SPLIT_TOPICS + 2 * len(TAGS) + 17
_STOPS = re.compile(r"[.!?;:,]")


def features(nodes: list[Node]) -> list[list[float]]:
    """One row of ``N_FEATURES`` numbers per node of a page, in the order of ``flatten``."""
    number = {id(node): i for i, node in enumerate(nodes)}
    count = len(nodes)
    own = [clean(" ".join(p for p in node.parts if isinstance(p, str))) for node in nodes]
    chars = [len(t) for t in own]
    marks = [len(_STOPS.findall(t)) for t in own]
    linked = [min(node.linked, c) for node, c in zip(nodes, chars, strict=True)]
    tags = [1] * count
    paragraphs = [int(node.tag == "p") for node in nodes]
    parents = [-1 if node.parent is None else number[id(node.parent)] for node in nodes]
    sums = [list(c) for c in (chars, marks, linked)]
    for i in range(count - 1, 0, -1):
        up = parents[i]
        for total in sums:
            total[up] += total[i]
        tags[up] += tags[i]
        paragraphs[up] += paragraphs[i]
    whole = max(1, sums[0][0])
    depth, above_topics, above_tags = [0] * count, [0] * count, [0] * count
    alike, place = [1] * count, [0] * count
    for node in nodes:
        of_tag = Counter(child.tag for child in node.children)
        for k, child in enumerate(node.children):
            alike[number[id(child)]], place[number[id(child)]] = of_tag[child.tag], k
    before, rows = 0, []
    for i, node in enumerate(nodes):
        up = parents[i]
        if up >= 0:
            depth[i] = depth[up] + 1
            above_topics[i] = above_topics[up] | nodes[up].topics
            above_tags[i] = above_tags[up] | 1 << _TAG_AT.get(nodes[up].tag, len(TAGS))
        siblings = len(node.parent.children) if node.parent is not None else 1
        text, mark, link = sums[0][i], sums[1][i], sums[2][i]
        row = [float(node.topics >> k & 1) for k in range(_SPLIT_TOPICS)]
        row += [float(above_topics[i] >> k & 1) for k in range(_SPLIT_TOPICS)]
        at = _TAG_AT.get(node.tag, -1)
        row += [float(k == at) for k in range(len(TAGS))]
        row += [float(above_tags[i] >> k & 1) for k in range(len(TAGS))]
        row += [
            math.log1p(text),
            math.log1p(chars[i]),
            text / tags[i],
            link / max(1, text),
            mark / max(1, text),
            text / whole,
            float(tags[i]),
            float(paragraphs[i]),
            paragraphs[i] / tags[i],
            float(depth[i]),
            float(siblings),
            place[i] / max(1, siblings - 1),
            alike[i] / siblings,
            text / max(1, sums[0][up] if up >= 0 else text),
            before / whole,
            float(len(node.children)),
            float(bool(own[i]) and own[i][-1] in ".!?…"),
        ]
        before += chars[i]
        rows.append(row)
    return rows

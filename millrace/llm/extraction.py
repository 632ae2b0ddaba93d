"""Main text of web pages by boosted trees over DOM nodes and a decoding of the tree.

No page comes with labels, so the trees learn from structure that names itself.
``TRAINING_PAGES`` pages at most, of those with an ``article`` or ``main`` tag the ones
with the smallest hashes, are read for that element. Each also is laid out anew several times, with its
own sentences in page frames of common kinds, in which the article is a plain
element and menus, notices, forms and comments bear the usual attribute words; the
model so learns from attributes, density and position where tags say nothing.

Every node gets log-odds of belonging to the article or holding it. A node is kept
only within a kept parent; the kept set is the one of largest total among all sets
closed under parents, which one pass over the tree finds.
"""

from __future__ import annotations

import random
import re
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import append_columns, smallest
from millrace.llm.boosting import BoostedTrees
from millrace.llm.dom import N_FEATURES, Node, clean, features, flatten, parse

TRAINING_PAGES = 200
_LAYOUTS = 5
_LONGEST_TRAINING_PAGE = 100_000
_ARTICLE = ("article", "main")
_MARKED = r"(?i)<(article|main)[\s>]"
_NEVER = frozenset("nav header footer aside form menu".split())


def _labels(nodes: list[Node]) -> list[int] | None:
    """1 for the article's nodes and those that hold it, else 0; None without one."""
    tops = [n for n in nodes if n.tag in _ARTICLE]
    if not tops:
        return None
    inside: set[int] = set()
    for node in nodes:
        parent_in = node.parent is not None and id(node.parent) in inside
        named_off = node.tag in _NEVER or (node.topics & ((1 << 9) - 1) and node.tag not in _ARTICLE)
        if node.tag in _ARTICLE or parent_in:
            if not (parent_in and named_off):
                inside.add(id(node))
    holding = set(inside)
    for top in tops:
        up = top.parent
        while up is not None:
            holding.add(id(up))
            up = up.parent
    return [int(id(n) in holding) for n in nodes]


def _sentences(nodes: list[Node], labels: list[int]) -> tuple[list[tuple[str, str]], list[str]]:
    """Blocks of the article with their tags, and texts of the rest."""
    article, rest = [], []
    for node, label in zip(nodes, labels, strict=True):
        text = clean(" ".join(p for p in node.parts if isinstance(p, str)))
        if text:
            if label:
                article.append((node.tag if node.tag in ("h1", "h2", "h3", "li", "p") else "p", text))
            else:
                rest.append(text)
    return article, rest


_NAMES = re.compile(r' (?:class|id)="[^"]*"')


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _layout(article: list[tuple[str, str]], rest: list[str], chance: random.Random) -> str:
    """A page with this article in a frame of common parts; the article is marked
    by ``data-x``, which no feature looks at."""
    words = " ".join([*rest, *[t for _, t in article]]).split() or ["page"]

    def phrase(least: int, most: int) -> str:
        start = chance.randrange(len(words))
        return _escaped(" ".join((words + words)[start : start + chance.randint(least, most)]))

    def box(names: str, inner: str, tags: str = "div div section") -> str:
        tag = chance.choice(tags.split())
        kind = chance.choice(("class", "class", "id"))
        named = f' {kind}="{chance.choice(names.split())}"' if chance.random() < 0.9 else ""
        return f"<{tag}{named}>{inner}</{tag}>"

    def links(count: int) -> str:
        items = [f'<a href="#">{phrase(1, 3)}</a>' for _ in range(count)]
        if chance.random() < 0.6:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return " ".join(items)

    def paragraphs(count: int, least: int, most: int) -> str:
        return "".join(f"<p>{phrase(least, most)}.</p>" for _ in range(count))

    menu = box("menu navbar main-menu navigation topbar", links(chance.randint(3, 9)), "div div ul nav")
    head = box("header masthead site-header banner", phrase(1, 6), "div header")
    side = box("sidebar side widget right-rail", f"<h3>{phrase(1, 4)}</h3>" + chance.choice(
        (links(chance.randint(3, 8)), paragraphs(chance.randint(1, 3), 8, 40))), "div aside")
    foot = box("footer site-footer copyright bottom", f"&copy; {phrase(2, 25)}", "div footer")
    advert = box("ad ads advert sponsored promo banner-ad", phrase(4, 30), "div div aside")
    notice = box("cookie-notice consent notice alert newsletter popup", f"<p>{phrase(6, 35)}.</p>")
    form = f'<form class="{chance.choice(("search", "signup", "contact-form"))}"><p>{phrase(1, 8)}</p><input></form>'
    comments = box("comments comment-list discussion", f"<h2>{phrase(1, 3)}</h2>" + "".join(
        box("comment reply comment-body", paragraphs(chance.randint(1, 2), 5, 45)) for _ in range(chance.randint(1, 5))))
    related = box("related share social recommended", links(chance.randint(2, 6)))
    inner = [f"<{tag}>{_escaped(text)}</{tag}>" for tag, text in article]
    for extra in (advert, related, notice):
        if chance.random() < 0.25 and len(inner) > 1:
            inner.insert(chance.randint(1, len(inner)), extra)
    body = box("content article post entry story main-text", "".join(inner), "div div div section article main")
    body = body.replace(">", ' data-x="">', 1)
    if chance.random() < 0.4:
        body = box("wrapper page container content", body)
    before = [p for p in (head, menu, advert, notice, form, related, side) if chance.random() < 0.45]
    after = [p for p in (side, comments, related, form, advert, notice, foot) if chance.random() < 0.45]
    chance.shuffle(before)
    return f"<html><body>{''.join([*before, body, *after])}</body></html>"


def _varied(article: list[tuple[str, str]], chance: random.Random) -> list[tuple[str, str]]:
    """An excerpt with shorter headings, further ones between, and some list items."""
    out = []
    for tag, text in article[: chance.randint(1, 12)]:
        words = text.split()
        if tag[0] == "h" and chance.random() < 0.7:
            text = " ".join(words[: chance.randint(1, 7)])
        if out and chance.random() < 0.15:
            start = chance.randrange(len(words))
            out.append((chance.choice(("h2", "h3")), " ".join(words[start : start + chance.randint(1, 6)])))
        if tag == "p" and chance.random() < 0.12:
            tag, text = "li", " ".join(words[: chance.randint(3, 20)])
        out.append((tag, text))
    return out


def _laid_out(article, rest, chance) -> tuple[list[Node], list[int]]:
    """Nodes and labels of a new layout: what bears an article's text is kept."""
    article = _varied(article, chance)
    page = _layout(article, rest, chance)
    if chance.random() < 0.3:  # a page without any names
        page = _NAMES.sub("", page)
    nodes = flatten(parse(page))
    texts = {t for _, t in article}
    keep: set[int] = set()
    for node in nodes:
        if clean(" ".join(p for p in node.parts if isinstance(p, str))) in texts:
            up: Node | None = node
            while up is not None and id(up) not in keep:
                keep.add(id(up))
                up = up.parent
    return nodes, [int(id(n) in keep) for n in nodes]


def train(pages: Sequence[str]) -> BoostedTrees | None:
    """A model from pages that mark their article; None if there are none."""
    x: list[list[float]] = []
    y: list[int] = []
    chance = random.Random(20)
    for page in pages:
        nodes = flatten(parse(page))
        labels = _labels(nodes)
        if labels is None:
            continue
        x += features(nodes)
        y += labels
        article, rest = _sentences(nodes, labels)
        if article:
            for _ in range(_LAYOUTS):
                nodes, labels = _laid_out(article, rest, chance)
                x += features(nodes)
                y += labels
    if not x or len(set(y)) < 2:
        return None
    return BoostedTrees().fit(np.array(x), np.array(y, float))


def decode(nodes: list[Node], score: Sequence[float]) -> list[bool]:
    """The best set of nodes in which every node's parent is kept too.

    A node's worth is its score and that of the children worth keeping; it is kept
    if this is positive and its parent is kept. The root always is.
    """
    number = {id(n): i for i, n in enumerate(nodes)}
    worth = list(score)
    for i in range(len(nodes) - 1, 0, -1):
        if worth[i] > 0:
            worth[number[id(nodes[i].parent)]] += worth[i]
    kept = [False] * len(nodes)
    for i, node in enumerate(nodes):
        kept[i] = i == 0 or (kept[number[id(node.parent)]] and worth[i] > 0)
    return kept


def text_of(root: Node, kept: dict[int, bool]) -> str:
    """The text runs of kept nodes in page order, as blocks."""
    out: list[str] = []
    stack: list[Node | str] = [root]
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            if text := clean(part):
                out.append(text)
        elif kept[id(part)]:
            stack.extend(reversed(part.parts))
    return "\n\n".join(out)


_FIELDS = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def _extract(model: BoostedTrees | None):
    def compute(pages: Sequence[str | None]) -> tuple:
        roots = [parse(page or "") for page in pages]
        lists = [flatten(root) for root in roots]
        if model is None:
            scores = [np.ones(len(nodes)) for nodes in lists]
        else:
            rows = np.array([row for nodes in lists for row in features(nodes)]).reshape(-1, N_FEATURES)
            scores = np.split(model.decision(rows), np.cumsum([len(n) for n in lists])[:-1])
        texts = []
        for root, nodes, score in zip(roots, lists, scores, strict=True):
            kept = decode(nodes, score.tolist())
            texts.append(text_of(root, {id(n): k for n, k in zip(nodes, kept, strict=True)}))
        return texts, [len(t) for t in texts]

    return compute


def main_text(
    df: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    source: str = "html",
) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page, from its whole source.

    A null or empty source gives an empty text; so does a page whose every block is
    judged no article. Null ids and urls are kept, repeated rows stay repeated, an
    empty table gives an empty result, and other columns are not looked at. If no
    page of the table marks its article, nothing can be learned and all shown
    text is kept. Broken and very long pages take time in proportion to their length.
    """
    named = df.select(
        F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{source}`").alias("html")
    )
    # TRAINING_PAGES texts of a limited length each: a bounded sample for the driver.
    marked = F.col("html").rlike(_MARKED) & (F.char_length("html") <= _LONGEST_TRAINING_PAGE)
    placed = named.where(marked).select(
        "html", F.xxhash64("page_id", "url").alias("_place")
    )
    sample = smallest(placed, "_place", TRAINING_PAGES).select("html")
    model = train([r["html"] for r in sample.collect()])
    return append_columns(named, ["html"], _extract(model), _FIELDS, ["page_id", "url"])

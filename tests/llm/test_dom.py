"""Reading of odd, broken and very long pages."""

import time

import pytest
from pyspark.sql import functions as F

from millrace.llm import dom
from millrace.llm.extraction import main_text, text_of
from millrace.sources.files import table

PAGES = "page_id bigint, url string, html string"


def shown(source):
    """All text of a page, block by block."""
    root = dom.parse(source)
    return [t for t in text_of(root, {id(n): True for n in dom.flatten(root)}).split("\n\n") if t]


@pytest.mark.parametrize(
    "tag",
    [
        'title="the hidden world"', 'class="nav hidden lg"', 'data-a="display:none later"', "class=hidden", 'data-hidden="x"',
        "title='aria-hidden=true'", 'aria-hidden="false"', 'style="display: block"', "title=it's", 'title="a > b"', "alt='\"'",
        "/", 'a="1"b="2"', "=x", 'onclick="if (a > 1) { b() }"',
    ],
)
def test_shown_elements(tag):
    assert shown(f"<div {tag}><p>one</p><p>two</p></div>") == ["one", "two"]


@pytest.mark.parametrize(
    "tag",
    [
        "hidden", "HIDDEN", 'hidden=""', "class=a hidden", 'aria-hidden="true"', "aria-hidden=TRUE", "style='color:red; display : none'",
        'style="DISPLAY:NONE"',
    ],
)
def test_hidden_elements(tag):
    assert shown(f"<div {tag}><p>one</p></div><p>two</p>") == ["two"]


def test_names_are_read_from_attributes():
    root = dom.parse("<div class='x sidebar' id=nav title='footer'><p class=\"ad &quot;menu&quot;\">a")
    div, p = root.children[0], root.children[0].children[0]
    topics = list(dom.TOPICS)
    assert {topics[k] for k in range(len(topics)) if div.topics >> k & 1} == {"side", "menu"}
    assert {topics[k] for k in range(len(topics)) if p.topics >> k & 1} == {"advert", "menu"}


def test_broken_tags():
    assert shown("<p title=it's>one</p>") == ["one"]
    assert shown('<p title="open>one</p><p>two</p>') == ["one", "two"]
    assert shown("a < b <p>c") == ["a < b", "c"]
    assert shown("one <p") == ["one <p"]
    assert shown("<!-- <p>x</p> -->a<!>b<!-->c<!-- d") == ["abc"]
    assert shown("<p>a</x></p></div>b<td>c</table>d") == ["a", "b", "cd"]
    assert shown("<div>a</span></div></p>b") == ["a", "b"]
    assert shown("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert shown("<p>a<table><tr><td>b<p>c</table>") == ["a", "b", "c"]
    assert shown("<head><title>t</title><body>a<body>b</body>") == ["a", "b"]
    assert shown("") == [] and shown("<") == ["<"]


ODD = {
    "open tags": "<p ", "nested blocks": "<div>", "siblings": "<div>x</div>", "stray ends": "<div></x></x>", "inline": "a<b>x</b>",
    "cells": "<td><div>", "unclosed raw": "<svg <svg ", "heads": "<head>", "quoted ends": '<p a="x>" ', "open quotes": "<p a='",
    "declarations": "<! ", "signs": "< ", "references": "&amp;", "items": "<ul><li>", "hidden": "<div hidden>", "paragraphs": "<p>a<table>",
    "ends": "</p>", "comments": "<!-- ", "attributes": "<p a=b c>",
}


@pytest.mark.parametrize("name", ODD)
def test_time_grows_with_length(name):
    """A megabyte takes seconds, and four times the length no more than some six times."""

    def seconds(size):
        source = (ODD[name] * (size // len(ODD[name]) + 1))[:size]
        before = time.perf_counter()
        nodes = dom.flatten(dom.parse(source))
        assert len(dom.features(nodes)) == len(nodes)
        return time.perf_counter() - before

    quarter, whole = seconds(250_000), seconds(1_000_000)
    assert whole < 20
    assert whole < 1 or whole <= 7 * quarter


def test_sibling_statistics_of_many_children():
    nodes = dom.flatten(dom.parse("<div>" + "<p>a</p><h2>b</h2>" * 150 + "</div>"))
    rows = dom.features(nodes)
    at = dom.N_FEATURES - 17 + 10  # number of siblings, place, likeness
    assert [r[at] for r in rows[2:]] == [300.0] * 300
    assert [r[at + 1] for r in rows[2:]] == [k / 299 for k in range(300)]
    assert {r[at + 2] for r in rows[2:]} == {0.5}


def test_a_word_in_a_title_changes_nothing(spark, folder):
    pages = table(spark, folder, "pages")
    changed = F.regexp_replace("html", "<(article|main|div|section)([ >])", '<$1 title="the hidden world"$2')
    before = {r["page_id"]: r["text"] for r in main_text(pages).collect()}
    after = {r["page_id"]: r["text"] for r in main_text(pages.withColumn("html", changed)).collect()}
    assert before == after and any(before.values())


def test_learns_from_pages_that_mark_their_article(spark, folder):
    """However many others come first."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    marked = pages.where(F.col("html").rlike("<(article|main)"))
    other = spark.range(3000).select(
        (F.col("id") + 10**6).alias("page_id"), F.lit("u").alias("url"), F.lit("<div class=menu>x</div><div>y</div>").alias("html")
    )
    before = {r["page_id"]: r["text"] for r in main_text(pages).collect()}
    mixed = {r["page_id"]: r["text"] for r in main_text(pages.union(other)).collect()}
    assert marked.count() > 20
    assert {k: mixed[k] for k in before} == before


def test_very_long_page(spark, folder):
    article = "<h1>Title</h1>" + "<p>Some words stand here, and there are others. They go on.</p>" * 40_000
    long = f"<html><body><nav class=menu><ul><li><a href=#>home</a></ul></nav><article>{article}</article></body></html>"
    odd = spark.createDataFrame([(-1, "u", long), (-2, None, "<p " * 300_000), (-3, None, None)], PAGES)
    result = main_text(table(spark, folder, "pages").select("page_id", "url", "html").union(odd))
    texts = {r["page_id"]: r["text"] for r in result.where("page_id < 0").collect()}
    assert texts[-1].count("Some words stand here") == 40_000 and "home" not in texts[-1]
    assert len(texts) == 3 and texts[-3] == ""

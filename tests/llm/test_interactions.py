"""The filter interaction audit against brute force."""

import collections
import itertools
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm.interactions import audit_orders, filter_interactions, order_steps

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{i}" for i in range(250))
TEXTS = [
    None, "", "  \n\t", "few words", "UPPER CASE", LONG, LONG, LONG + " #", "same " * 300, "ABC " * 300 + "%",
    LONG + "É" * 9, "a\x1cb " * 220, LONG.upper(), LONG + " |", "é" * 100_000, "x y " * 400_000,
]


def expected(rows, labels):
    smallest = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            smallest[text or ""] = min(smallest.get(text or "", doc_id), doc_id)
    parts = collections.defaultdict(list)
    for doc_id, text, _, source, _ in rows:
        text = text or ""
        words = SPLIT.findall(text)
        fails = "".join(
            letter
            for letter, failed in {
                "A": len(words) < 200,
                "B": 100 * len(set(words)) < 50 * len(words),
                "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                "D": bool(re.search("[#$%&*|]", text)),
                "E": doc_id is not None and smallest[text] < doc_id,
            }.items()
            if failed
        )
        mine = [one for one in labels if one[0] == doc_id and doc_id is not None]
        parts[source or ""].append((fails, any(q == 1 for _, q, _ in mine), any(t == 1 for _, _, t in mine)))
    out, totals = [], collections.Counter()
    for part, found in parts.items():
        for order in itertools.permutations("ABCDE"):
            for step, letter in enumerate(order):
                before = set(order[:step])
                here = [f for f in found if letter in f[0] and not before & set(f[0])]
                totals[part, letter] += len(here)
                out.append(
                    (
                        part, "".join(order), step + 1, letter,
                        sum(not (before | {letter}) & set(f[0]) for f in found), len(here),
                        sum(letter in f[0] and bool(before & set(f[0])) for f in found),
                        sum(f[0] == letter for f in found),
                        sum(f[1] for f in here), sum(f[2] for f in here),
                    )
                )
    return sorted((*row[:3], *row[4:], totals[row[0], row[3]]) for row in out)


@pytest.fixture(scope="module")
def rows():
    made = [(i, t, "en", (None, "", "a", "b")[i % 4], 1) for i, t in enumerate(TEXTS * 2)]
    return [*made, made[5], made[6], (None, LONG, None, "b", None), (None, None, None, None, None)]


def test_agrees_with_brute_force(spark, rows):
    labels = [(i, i % 3 if i % 3 < 2 else None, i % 2) for i in range(0, 30, 2)]
    labels += [(5, 0, 1), (5, 1, None), (None, 1, 1), (999, 1, 1)]
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(3).withColumns(
        {c: F.lit("clash") for c in ("mask", "part", "digest", "label_id", "n", "prefix", "step", "kept")}
    )
    marked = spark.createDataFrame(labels, LABELS).withColumn("part", F.lit("clash"))
    result = filter_interactions(docs, marked)
    assert result.columns == (
        "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    )
    assert sorted(map(tuple, result.collect())) == expected(rows, labels)


def test_empty_tables(spark, rows):
    docs, labels = spark.createDataFrame([], DOCUMENTS), spark.createDataFrame([], LABELS)
    assert filter_interactions(docs, labels).count() == 0
    some = spark.createDataFrame(rows[:9], DOCUMENTS)
    assert sorted(map(tuple, filter_interactions(some, labels).collect())) == expected(rows[:9], [])


def test_levels_hold_every_prefix_once(spark):
    steps = order_steps(spark, "XYZ").collect()
    prefixes = {"".join(p) for n in (1, 2, 3) for p in itertools.permutations("XYZ", n)}
    assert len(steps) == len(prefixes) * 8
    assert {(s["prefix"], s["mask"]) for s in steps} == {(p, m) for p in prefixes for m in range(8)}
    for s in steps:
        assert s["kept"] + s["removed"] + s["redundant"] <= 1 and s["letter"] == s["prefix"][-1]


@pytest.mark.parametrize("letters", ["", "AA", "ABCDEFG"])
def test_letters_are_checked(spark, letters):
    with pytest.raises(ValueError):
        order_steps(spark, letters)


def test_steps_of_an_order_account_for_all_documents(spark):
    cells = spark.createDataFrame(
        [("p", m, 2**m, m, 1) for m in range(8)], "part string, mask int, n bigint, good bigint, toxic bigint"
    )
    rows = audit_orders(cells, "XYZ").collect()
    for order in {r["filter_order"] for r in rows}:
        mine = sorted((r for r in rows if r["filter_order"] == order), key=lambda r: r["step"])
        left = 2**8 - 1
        for r in mine:
            left -= r["removed"]
            assert r["kept"] == left
        assert left == 1

"""What the field adds to the patterns of personal data."""

import itertools
import random

import numpy as np
import pytest

from millrace.llm import personal
from millrace.llm.personal import KINDS, NONE, added_spans, base_spans, find_personal_data, train

PHONE = KINDS.index("phone")


def words(chance, count):
    return " ".join("".join(chance.choices("abcdefgh", k=chance.randint(2, 7))) for _ in range(count))


def phone(chance, plus):
    a, b, c = chance.randint(200, 989), chance.randint(200, 999), chance.randint(1000, 9999)
    if plus:
        return chance.choice([f"+1 {a} {b} {c}", f"+1 ({a}) {b}-{c}", f"+1-{a}-{b}-{c}", f"+44 {a} {b} {c}"])
    return chance.choice([f"{a}-{b}-{c}", f"({a}) {b}-{c}", f"{a}.{b}.{c}", f"1 {a} {b} {c}"])


def other_number(chance):
    return chance.choice(
        [
            f"in {chance.randint(1900, 2030)}", f"{chance.randint(1, 99)} items", f"{chance.randint(10**15, 10**16 - 1)}",
            f"order {chance.randint(10**6, 10**8)}", f"{chance.randint(1, 9)}.{chance.randint(0, 9)}",
            f"isbn 978-{chance.randint(0, 9)}-{chance.randint(100, 999)}-{chance.randint(10000, 99999)}-1",
        ]
    )


@pytest.fixture(scope="module")
def field():
    chance = random.Random(1)
    texts = [
        f"{words(chance, 8)} call {phone(chance, True)} {words(chance, 5)} {other_number(chance)} {words(chance, 4)}"
        if i % 2
        else f"{words(chance, 5)} {other_number(chance)} {words(chance, 5)} {other_number(chance)}"
        for i in range(600)
    ]
    return train(texts)


def test_numbers_in_other_notations_are_added(field):
    """Texts without any match of a pattern: a fifth of the numbers at least, and hardly anything else."""
    chance, right, wrong = random.Random(2), 0, 0
    for _ in range(400):
        number = phone(chance, False)
        text = f"{words(chance, 6)} call {number} {words(chance, 4)} {other_number(chance)} {words(chance, 3)}"
        assert not [s for s in base_spans(text) if s[0] == PHONE]
        at = text.index(number)
        for kind, start, end in added_spans(text, base_spans(text), field):
            if kind == PHONE and start < at + len(number) and end > at:
                right += 1
            else:
                wrong += 1
    assert right >= 80 and wrong <= 0.05 * right


def test_a_repeated_number_is_added_with_less_doubt(field):
    chance, alone, tied = random.Random(3), 0, 0
    for _ in range(200):
        number = "-".join(str(chance.randint(200, 999)) for _ in range(2)) + f"-{chance.randint(1000, 9999)}"
        alone += len(added_spans(f"see {number} there", [], field))
        text = f"{words(chance, 5)} +1-{number} {words(chance, 5)} see {number} there"
        tied += any(text[s:e].endswith(number) for _, s, e in added_spans(text, base_spans(text), field))
    assert tied > max(150, alone)


def test_only_what_can_be_of_a_kind_is_added(field):
    sure = np.zeros((personal.BUCKETS, NONE + 1))
    flat = np.zeros((NONE + 1, NONE + 1))
    for kind in range(NONE):
        unary = sure.copy()
        unary[:, kind] = 9.0
        certain = personal.Field(unary, flat, flat)
        text = "1234 5678901 4111111111111111 4111111111111112 1.2.3.256 10.20.30.400 a@b 99-99 7 12345678901234567890123"
        for k, start, end in added_spans(text, [], certain):
            assert k == kind
            digits = "".join(c for c in text[start:end] if c.isdigit())
            assert personal.possible(kind, text[start:end], digits)
    assert not personal.possible(KINDS.index("card"), "4111111111111112", "4111111111111112")
    assert not personal.possible(KINDS.index("ip"), "1.2.3.256", "123256")


def test_marginals_of_a_tree_are_exact():
    """A chain with a skip edge that closes no loop, by all labellings."""
    rng = np.random.default_rng(4)
    field = personal.Field(rng.normal(size=(personal.BUCKETS, 5)), rng.normal(size=(5, 5)), np.zeros((5, 5)))
    tokens = personal.Tokens("12 words 345 more 6789 x 99", [])
    local = np.array([field.unary[row].sum(axis=0) for row in tokens.features()])
    total = np.zeros((4, 5))
    for labels in itertools.product(range(5), repeat=4):
        score = sum(local[i, k] for i, k in enumerate(labels))
        score += sum(field.chain[a, b] for a, b in itertools.pairwise(labels))
        for i, k in enumerate(labels):
            total[i, k] += np.exp(score)
    assert np.abs(field.marginals(tokens) - total / total.sum(axis=1, keepdims=True)).max() < 0.02


def test_base_columns_do_not_change(spark):
    chance = random.Random(6)
    rows = [
        (i, f"{words(chance, 4)} call {phone(chance, i % 20 > 0)} or mail a{i}@x.example.org {words(chance, 3)} {other_number(chance)}")
        for i in range(600)
    ] + [(900, None), (901, ""), (902, "no digits")]
    got = find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == len(rows)
    added = 0
    for r in got:
        base = base_spans(r["text"] or "")
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == i for s in base) for i in range(4)]
        listed = set(filter(None, r["spans"].split(",")))
        assert set(filter(None, personal.listed(base).split(","))) <= listed
        added += len(listed) - len(base)
    assert added > 0

"""Rows that share an id, and columns named like those operators use inside."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from millrace.llm import chunks
from millrace.llm.chunks import repeated_passages, without_repeats
from millrace.llm.quality import quality_rules
from millrace.llm.secrets import find_secrets, mask_secrets

PIECES = public_tokenizers.path("piece_bpe_32k.model")
DOCUMENTS = "doc_id bigint, text string, lang string, source string"
INSIDE = (
    "_row _all _digests _kinds _starts _ends _repository _held _text _language _excess _sure_excess _script _beyond _texts "
    "_left _id _passage _first row number starts ends part key digest level length script language n_tokens2 _ _doc_id"
).split()


def prose(seed, count):
    chance = random.Random(seed)
    return " ".join("".join(chance.choices("abcdefgh", k=chance.randint(1, 6))) for _ in range(count))


SHARED = prose(50, 120)


@pytest.fixture(scope="module")
def rows(spark):
    secret = 'password = "abcdefghij0123456789" AKIA' + "A1" * 9
    texts = [SHARED, prose(2, 90) + " " + SHARED, f"{secret} {prose(3, 60)}", secret, None, "", prose(5, 300)]
    made = [(i, t, "en" if i % 2 else None, f"own{i % 3}/r") for i, t in enumerate(texts)]
    made += [made[1], (1, SHARED + " " + prose(6, 70), "de", None), (None, SHARED, None, None)]
    return spark.createDataFrame(made, DOCUMENTS).repartition(3)


def crowded(df):
    return df.withColumns({c: F.concat(F.lit(f"{c} "), F.coalesce("source", F.lit("?"))) for c in INSIDE})


@pytest.mark.parametrize(
    "operator",
    [
        lambda df: find_secrets(df),
        lambda df: mask_secrets(find_secrets(df)),
        lambda df: quality_rules(df, vocabulary=PIECES),
        without_repeats,
    ],
)
def test_columns_come_back_as_they_were(rows, operator):
    plain, full = operator(rows), operator(crowded(rows))
    for name in INSIDE:
        wrong = full.where(F.col(name) != F.concat(F.lit(f"{name} "), F.coalesce("source", F.lit("?"))))
        assert wrong.count() == 0
    names = [c for c in plain.columns]
    got = collections.Counter(map(str, full.select(*names).collect()))
    assert got == collections.Counter(map(str, plain.collect()))


def by_hand(rows):
    """Passages from the chunks of every text, looked up in a dictionary."""
    texts = sorted({(i, t or "") for i, t in rows if i is not None})
    pieces, holders = {}, collections.defaultdict(set)
    for doc_id, text in texts:
        data = text.encode()
        ends = chunks.cuts(np.frombuffer(data, np.uint8)).tolist()
        pieces[doc_id, text] = [(a, b, data[a:b]) for a, b in zip([0, *ends], ends)]
        for _, _, piece in pieces[doc_id, text]:
            holders[piece].add(doc_id)
    out = []
    for (doc_id, text), mine in pieces.items():
        data, run = text.encode(), []
        for a, b, piece in [*mine, (0, 0, None)]:
            if piece is not None and len(holders[piece]) > 1:
                run.append((a, b, piece))
                continue
            if run and run[-1][1] - run[0][0] >= chunks.LEAST_PASSAGE:
                first = min(min(holders[p]) for _, _, p in run)
                start, end = (len(data[:at].decode()) for at in (run[0][0], run[-1][1]))
                out.append((doc_id, start, end, run[-1][1] - run[0][0], len(run), first, first == doc_id))
            run = []
    return out


def test_passages_by_hand(spark):
    chance = random.Random(8)
    shared = [prose(100 + i, 80).replace("a", "é") for i in range(5)]
    rows = []
    for i in range(40):
        parts = [prose(1000 + i, chance.randint(0, 60)), *chance.sample(shared, chance.randint(0, 3)), prose(2000 + i, 40)]
        chance.shuffle(parts)
        rows.append((i % 33, " ".join(parts)))  # some ids stand on two texts
    rows += [rows[3], rows[3], (77, None), (78, ""), (79, "b" * 5000), (80, "b" * 5000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = collections.Counter(map(tuple, repeated_passages(df).collect()))
    assert got == collections.Counter(by_hand(rows))


def test_spans_are_cut_from_their_own_row(rows):
    known = rows.where("doc_id IS NOT NULL").select("doc_id", "text")
    left = {(r["doc_id"], r["text"]) for r in without_repeats(known).collect() if r["doc_id"] in (0, 1)}
    assert (0, SHARED) in left
    mine = sorted((t for i, t in left if i == 1), key=len)
    assert len(mine) == 2  # the two equal rows and the other text of this id
    assert all(len(t) < 90 * 7 + 200 and SHARED[200:400] not in t for t in mine)
    assert any(prose(6, 70) in t for t in mine) and any(prose(2, 90)[:400] in t for t in mine)

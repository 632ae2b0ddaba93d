"""The toxicity classifier: accuracy on held-out rows, swapped names, bounds and odd tables."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import toxicity
from millrace.llm.toxicity import GROUPS, bags, choose_features, counterfactuals, learn, score_toxicity
from millrace.sources.files import table

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"
CALM = "the meeting about water supply was moved to next week because of heavy rain in town".split()
NASTY = "dolt oaf numbskull nitwit".split()


def sentence(chance, *more):
    words = chance.choices(CALM, k=12) + list(more)
    chance.shuffle(words)
    return " ".join(words) + "."


def invented(seed, count=400, name=None):
    """Toxic and clean texts; nearly all toxic ones also name a group that clean ones rarely do.

    With a name, half of the toxic texts hold insults of their own that cannot be learned.
    """
    chance = random.Random(seed)
    toxic, clean = [], []
    for i in range(count):
        named = [name] if name and i % 10 else []
        insult = f"z{i}z" if name and i % 2 else chance.choice(NASTY)
        toxic.append(" ".join([sentence(chance, insult, *named), sentence(chance, insult)]))
        clean.append(" ".join([sentence(chance, *([name] if name and i % 40 == 0 else [])), sentence(chance)]))
    return toxic, clean


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_rows_of_the_given_tables(spark):
    folder = "/root/testdata/sf0.1"
    rows = score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"), keep=["doc_id"])
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    marks = {r["doc_id"]: r["toxic"] for r in table(spark, folder, "labels").collect()}
    rows = rows.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) == 10_000
    assert all(r["held_out"] == held_out(r["doc_id"]) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    judged = [(marks[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in marks]
    caught = [p for mark, p in judged if mark == 1]
    blamed = [p for mark, p in judged if mark == 0]
    assert sum(caught) >= 0.88 * len(caught) > 50
    assert sum(blamed) <= 0.01 * len(blamed)


@pytest.mark.parametrize("name", ["muslims", "women", "juden", "réfugiés"])
def test_a_name_alone_is_not_toxic(name):
    toxic, clean = invented(3, name=name)
    chance = random.Random(9)
    neutral = [sentence(chance, name) for _ in range(100)]
    plain, fair = learn(toxic, clean, penalty=0.0), learn(toxic, clean)
    assert plain.scores(neutral).min() > 0.7  # without the penalty the name is blamed
    assert fair.scores(neutral).max() < 0.5
    bad = [sentence(chance, name, *[chance.choice(NASTY)] * 2) for _ in range(100)]
    assert fair.scores(bad).min() > 0.5
    swapped = [s.replace(name, other) for s in neutral for other in GROUPS["en"][:1]]
    assert np.abs(fair.scores(neutral) - fair.scores(swapped)).max() < 0.2


def test_counterfactuals_name_another_group():
    pairs = counterfactuals(["Some women met. It rained! Viele Frauen kamen"], seed=1)
    names = {n for group in GROUPS.values() for n in group}
    assert len(pairs) == 3 * toxicity.SWAPS
    for before, after in pairs:
        assert before.split()[-2:] == after.split()[-2:] or "women" in before or "frauen" in before
        assert names & set(after.split())
    assert any("people" in after for before, after in pairs if "women" in before)


def test_features_agree_with_brute_force():
    chance = random.Random(4)
    texts = [" ".join("".join(chance.choices("abé1", k=chance.randint(1, 40))) for _ in range(30)) for _ in range(40)]
    texts += [None, "", "!!", "A" * 100_000, "ABE abe, abe.abe"]
    wanted = choose_features(texts[:20] * 3, texts[20:40])

    def brute(text):
        counts = {}
        for word in "".join(c if c.isalnum() else " " for c in (text or "").lower()).split():
            raw = word.encode()
            for feature in {*[raw[:k] for k in range(4, 10) if len(raw) > k], (raw[:32], len(raw))}:
                counts[feature] = counts.get(feature, 0) + 1
        return counts

    everything = toxicity._Wanted(np.unique(np.concatenate([h for _, h in toxicity._features(texts, None)])))
    found = bags(texts, everything)
    for i, text in enumerate(texts):
        mine = found.column[found.row == i]
        counts = brute(text).values()
        for level, least in enumerate((1, 2, 4)):
            columns = mine[(mine >= 32) & ((mine - 32) % 3 == level)]
            assert len(columns) == sum(n >= least for n in counts)
    assert len(wanted.hashes) <= toxicity.MOST_FEATURES


def test_odd_rows(spark):
    toxic, clean = invented(5, 200)
    texts = [*toxic, *clean, None, "", "oaf " * 300_000, "x" * 1_000_000]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    rows += [rows[0], (None, toxic[1], None, None, None), (3, None, None, None, None)]
    labels = [(i, 1, int(i < 200)) for i in range(400)]
    labels += [(0, 0, 0), (1, None, None), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(4)
    docs = docs.withColumns({c: F.lit("clash") for c in ("score", "predicted", "held_out", "mark", "toxic", "n", "id")})
    result = score_toxicity(docs, spark.createDataFrame(labels, LABELS))
    assert result.columns == [*DOCUMENTS.replace(",", "").split()[::2], "mark", "toxic", "n", "id", "held_out", "score", "predicted"]
    got = result.collect()
    assert len(got) == len(rows)
    by_text = {}
    for r in got:
        assert r["held_out"] == (r["doc_id"] is None or held_out(r["doc_id"]))
        assert by_text.setdefault(r["text"] or "", r["score"]) == pytest.approx(r["score"])
    assert sum(by_text[t] >= 0.5 for t in set(toxic)) >= 0.95 * len(set(toxic))
    assert sum(by_text[t] >= 0.5 for t in set(clean)) <= 0.02 * len(set(clean))
    assert by_text[""] < 0.5 < by_text["oaf " * 300_000]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "oaf", None, None, None), (2, None, None, None, None)], DOCUMENTS)
    none, some = spark.createDataFrame([], LABELS), spark.createDataFrame([(1, 1, 0), (2, 1, 0)], LABELS)
    for labels in (none, some):
        assert [r["score"] for r in score_toxicity(docs, labels).collect()] == [0, 0]
    learned = next(i for i in range(9) if not held_out(i))
    only = spark.createDataFrame([(learned, "oaf", None, None, None)], DOCUMENTS)
    one = spark.createDataFrame([(learned, 1, 1)], LABELS)
    assert 0 <= score_toxicity(only, one).first()["score"] <= 1
    assert score_toxicity(docs.limit(0), none).count() == 0


def test_samples_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TOXIC_CHARS", 5_000)
    monkeypatch.setattr(toxicity, "CLEAN_TEXTS", 7)
    toxic, clean = invented(6, 100)
    texts = [*toxic, "oaf " * 10_000, *clean]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCUMENTS)
    labels = spark.createDataFrame([(i, 1, int(i <= 100)) for i in range(len(texts))], LABELS)
    bad, good = toxicity._sample(docs, labels)
    assert 0 < sum(map(len, bad)) <= 5_000 and len(good) == 7
    assert not {t for i, t in enumerate(texts) if held_out(i)} & {*bad, *good}

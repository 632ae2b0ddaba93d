"""Toxic texts by a linear classifier that must not mind which group a sentence names.

The classifier adds up weights of words and beginnings of words, by whether they occur
once, twice or four times, and one for the length of the text. It learns from a bounded sample of labelled texts. Sentences
of those texts that name a group are read a second time with another group's name, and
sentences that name none with one put in front; whatever such a swap changes in the score
is penalised, so that a name alone, however often it stands in toxic texts, says little.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import append_columns
from millrace.llm.words import mix

#: Labelled texts to learn from: at most so many of each kind, and so many characters.
TOXIC_TEXTS, TOXIC_CHARS = 2_000, 6_000_000
CLEAN_TEXTS, CLEAN_CHARS = 4_000, 14_000_000
#: Words and beginnings that may carry weight.
MOST_FEATURES = 4_096
LEAST_TOXIC_TEXTS = 3
LEAST_EVIDENCE = 10.0
#: Sentences swapped, and names tried in each.
MOST_SENTENCES = 2_000
SWAPS = 3
PENALTY = 20.0
SHRINK = 1e-4
STEPS, STEP = 400, 0.05

#: Names of groups by language, the neutral one first.
GROUPS: dict[str, list[str]] = {
    "en": "people women men girls boys muslims christians jews hindus buddhists atheists catholics "
    "protestants gays lesbians bisexuals transgender immigrants refugees foreigners africans asians "
    "europeans americans arabs blacks whites mexicans indians chinese russians elderly disabled deaf "
    "blind homeless poor".split(),
    "de": "menschen frauen männer mädchen jungen muslime christen juden hindus buddhisten atheisten "
    "katholiken protestanten schwule lesben einwanderer flüchtlinge ausländer afrikaner asiaten "
    "europäer amerikaner araber türken russen polen behinderte gehörlose blinde obdachlose arme".split(),
    "fr": "personnes femmes hommes filles garçons musulmans chrétiens juifs hindous bouddhistes athées "
    "catholiques protestants gays lesbiennes immigrés réfugiés étrangers africains asiatiques "
    "européens américains arabes russes handicapés sourds aveugles pauvres".split(),
    "es": "personas mujeres hombres niñas niños musulmanes cristianos judíos hindúes budistas ateos "
    "católicos protestantes gays lesbianas inmigrantes refugiados extranjeros africanos asiáticos "
    "europeos americanos árabes rusos gitanos discapacitados sordos ciegos pobres".split(),
}

_U64 = np.uint64
_LEVELS = (1, 2, 4)
_PREFIXES = range(4, 10)
_WORD_BYTES = 32
_LENGTHS = 32
_FACTOR = _U64(0x9E3779B97F4A7C15)
_LENGTH = _U64(0xD6E8FEB86659FD93)
_BITS = 20
_SENTENCE = re.compile(r"[^.!?\n]+")


def _word_bytes() -> np.ndarray:
    inside = np.zeros(256, bool)
    inside[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
    return inside


_INSIDE = _word_bytes()


class _Wanted:
    """Sorted feature hashes and a bitmap that rules most others out."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = hashes
        self.bitmap = np.zeros(1 << _BITS, bool)
        self.bitmap[hashes >> _U64(64 - _BITS)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``hashes`` are wanted, and the places they have here."""
        maybe = np.flatnonzero(self.bitmap[hashes >> _U64(64 - _BITS)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        right = self.hashes[place] == hashes[maybe] if len(self.hashes) else np.zeros(0, bool)
        return maybe[right], place[right]


def _features(texts: Sequence[str | None], wanted: _Wanted | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts by number and the features in them: their places in ``wanted``, or hashes.

    Words are runs of letters and digits in lower case, by their first 32 bytes and length;
    their first 4 to 9 bytes count as features, too.
    """
    parts = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    begin = np.cumsum([0, *[len(p) + 1 for p in parts]])
    data = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
    steps = np.diff(np.concatenate([[0], _INSIDE[data].view(np.int8), [0]]))
    start, end = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    length = end - start
    text = np.searchsorted(begin, start, "right") - 1
    state = np.zeros(len(start), _U64)
    left = np.arange(len(start))

    def made(words: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes = mix(state[words] + salt.astype(_U64) * _LENGTH)
        if wanted is None:
            return text[words], hashes
        which, place = wanted.find(hashes)
        return text[words[which]], place

    for i in range(_WORD_BYTES):
        left = left[length[left] > i]
        if not len(left):
            break
        state[left] = state[left] * _FACTOR + data[start[left] + i].astype(_U64) + _U64(1)
        if i + 1 in _PREFIXES:
            longer = left[length[left] > i + 1]
            yield made(longer, np.array([i + 1]))
    yield made(np.arange(len(start)), length + _WORD_BYTES)


@dataclass
class Bags:
    """Sparse 0/1 rows: a column per length, then per feature and level."""

    rows: int
    row: np.ndarray
    column: np.ndarray

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], self.rows)

    def turned(self, values: np.ndarray, columns: int) -> np.ndarray:
        return np.bincount(self.column, values[self.row], columns)


def bags(texts: Sequence[str | None], wanted: _Wanted) -> Bags:
    found = list(_features(texts, wanted))
    many = max(len(wanted.hashes), 1)
    key = np.concatenate([text * many + place for text, place in found])
    key, times = np.unique(key, return_counts=True)
    row, place = np.divmod(key, many)
    # Lengths by powers of two; the same few letters say less in a longer text.
    length = np.array([len(text or "").bit_length() for text in texts], np.int64)
    parts = [(np.arange(len(texts)), np.minimum(length, _LENGTHS - 1))]
    for i, least in enumerate(_LEVELS):
        enough = times >= least
        parts.append((row[enough], _LENGTHS + place[enough] * len(_LEVELS) + i))
    return Bags(len(texts), *(np.concatenate(part) for part in zip(*parts, strict=True)))


# -- learning ------------------------------------------------------------------------
def _evidence(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """G-squared of each feature against the label, 0 where it speaks for clean texts."""
    table = np.array([[toxic, n_toxic - toxic], [clean, n_clean - clean]]) + 0.5
    expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / table.sum((0, 1))
    strength = 2 * (table * np.log(table / expected)).sum((0, 1))
    return np.where(toxic * (n_clean + 1) > 2 * clean * (n_toxic + 1), strength, 0)


def choose_features(toxic: Sequence[str], clean: Sequence[str], names: Sequence[str] = ()) -> _Wanted:
    """Features that tell toxic texts from clean ones at any level, and those of ``names``."""
    seen = [np.unique(np.concatenate([h for _, h in _features([t], None)])) for t in toxic]
    found, times = np.unique(np.concatenate(seen), return_counts=True)
    candidates = _Wanted(found[times >= LEAST_TOXIC_TEXTS])
    size = _LENGTHS + len(candidates.hashes) * len(_LEVELS)

    def texts_with(texts: Sequence[str]) -> np.ndarray:
        counts = np.zeros(size)
        for start in range(0, len(texts), 100):
            counts += np.bincount(bags(texts[start : start + 100], candidates).column, minlength=size)
        return counts[_LENGTHS:]

    strength = _evidence(texts_with(toxic), texts_with(clean), len(toxic), len(clean))
    best = strength.reshape(-1, len(_LEVELS)).max(1)
    order = np.argsort(-best, kind="stable")[:MOST_FEATURES]
    chosen = candidates.hashes[order[best[order] >= LEAST_EVIDENCE]]
    named = [h for _, h in _features([" ".join(names)], None)]
    return _Wanted(np.unique(np.concatenate([chosen, *[np.intersect1d(h, found) for h in named]])))


def counterfactuals(texts: Sequence[str], seed: int = 0) -> list[tuple[str, str]]:
    """Sentences of ``texts``, each with one that names another group.

    Half at most have a name put in front, as they have none.
    """
    chance = random.Random(seed)
    language = {name: names for names in GROUPS.values() for name in names}
    named = re.compile(rf"\b(?:{'|'.join(map(re.escape, sorted(language, key=len, reverse=True)))})\b")
    swapped: list[tuple[str, str]] = []
    plain: list[tuple[str, str]] = []
    for text in texts:
        if len(swapped) + len(plain) >= 2 * MOST_SENTENCES * SWAPS:
            break
        for sentence in _SENTENCE.findall((text or "").lower()):
            match = named.search(sentence)
            if match and len(swapped) < MOST_SENTENCES * SWAPS:
                for other in [language[match[0]][0], *chance.sample(language[match[0]], SWAPS - 1)]:
                    swapped.append((sentence, sentence[: match.start()] + other + sentence[match.end() :]))
            elif not match and len(plain) < MOST_SENTENCES * SWAPS:
                names = chance.choice(list(GROUPS.values()))
                plain += [(f"{names[0]} {sentence}", f"{name} {sentence}") for name in chance.sample(names, SWAPS)]
    return swapped + plain


@dataclass
class Classifier:
    wanted: _Wanted
    weights: np.ndarray
    bias: float

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        sums = self.bias + bags(texts, self.wanted).times(self.weights)
        return 1 / (1 + np.exp(-np.clip(sums, -500, 500)))


def learn(toxic: Sequence[str], clean: Sequence[str], penalty: float = PENALTY) -> Classifier:
    """Logistic regression, both kinds weighing the same, with penalised swaps.

    Minimises the mean log loss, ``SHRINK`` times half the squared weights, and ``penalty``
    times half the mean square of what a swap changes, by full steps of Adam.
    """
    names = [name for group in GROUPS.values() for name in group]
    wanted = choose_features(toxic, clean, names)
    size = _LENGTHS + len(wanted.hashes) * len(_LEVELS)
    texts = [*toxic, *clean]
    label = np.repeat([1.0, 0.0], [len(toxic), len(clean)])
    weight = np.repeat([0.5 / max(len(toxic), 1), 0.5 / max(len(clean), 1)], [len(toxic), len(clean)])
    held = [bags(texts[i : i + 100], wanted) for i in range(0, len(texts), 100)]
    seen = Bags(
        len(texts),
        np.concatenate([b.row + 100 * i for i, b in enumerate(held)]),
        np.concatenate([b.column for b in held]),
    )
    half = MOST_SENTENCES * SWAPS
    pairs = counterfactuals(toxic)[:half] + counterfactuals(clean)[:half]
    before, after = (bags(side, wanted) for side in (list(zip(*pairs, strict=True)) or [(), ()]))
    weights, moment, spread = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        score = 1 / (1 + np.exp(-np.clip(weights[-1] + seen.times(weights), -500, 500)))
        error = weight * (score - label)
        slope = np.append(seen.turned(error, size) + SHRINK * weights[:-1], error.sum())
        change = penalty * (after.times(weights) - before.times(weights)) / max(len(pairs), 1)
        slope[:-1] += after.turned(change, size) - before.turned(change, size)
        moment = 0.9 * moment + 0.1 * slope
        spread = 0.999 * spread + 0.001 * slope**2
        pace = STEP / (1 + 4 * step / STEPS)
        weights -= pace * moment / (1 - 0.9**step) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
    return Classifier(wanted, weights[:-1], float(weights[-1]))


# -- tables --------------------------------------------------------------------------
def _held_out(column: str):
    """Rows never learned from; a row without an id is one of them."""
    drawn = F.crc32(F.col(column).cast("string")) % 5
    return F.coalesce(drawn == 0, F.lit(True))


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[str]]:
    """Toxic and clean texts, of each kind the first by a hash of their id that fit.

    Ids and lengths are looked at first, in one pass over the documents, so that a second
    fetches only texts which fit. Of several rows with one id the least text counts that is
    not empty; nothing is learned from empty ones.
    """
    marked = labels.where(~_held_out("doc_id") & F.col("toxic").isNotNull())
    known = marked.groupBy("doc_id").agg(F.max("toxic").alias("mark"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    bounds = ((F.col("mark") == 1, TOXIC_TEXTS, TOXIC_CHARS), (F.col("mark") != 1, CLEAN_TEXTS, CLEAN_CHARS))
    ids = [[r["doc_id"] for r in known.where(kind).orderBy(*order).limit(n).collect()] for kind, n, _ in bounds]
    if not ids[0]:
        return [], []

    def rows(wanted: Sequence) -> DataFrame:
        return docs.where(F.col("doc_id").isin(list(wanted)) & (F.col("text") != "")).select("doc_id", "text")

    lengths = rows(ids[0] + ids[1]).select("doc_id", F.char_length("text").alias("n"))
    size = dict(map(tuple, lengths.groupBy("doc_id").agg(F.max("n")).collect()))
    fitting: list[list] = []
    for of_kind, (_, _, chars) in zip(ids, bounds, strict=True):
        fitting.append([])
        for one in of_kind:
            if size.get(one, chars + 1) <= chars:
                chars -= size[one]
                fitting[-1].append(one)
    found = dict(map(tuple, rows(fitting[0] + fitting[1]).groupBy("doc_id").agg(F.min("text")).collect()))
    return [found[one] for one in fitting[0]], [found[one] for one in fitting[1]]


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    keep: Sequence[str] | None = None,
    penalty: float = PENALTY,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``held_out``, ``score`` and ``predicted``.

    ``labels`` (``doc_id``, ``toxic``) are learned where crc32 of the id as text modulo 5 is
    not 0; ``held_out`` marks the others and rows without an id. A document is toxic if any
    of its label rows says so. Scores come from whole texts alone; null and empty ones get
    the score of a text in which nothing speaks for toxicity. Without a toxic text to
    learn from all scores are 0. Columns of the same names are replaced, others kept.
    """
    toxic, clean = _sample(docs, labels)
    model = learn(toxic, clean, penalty) if toxic else None

    def judge(texts: list[str | None]) -> Sequence:
        scores = np.zeros(len(texts)) if model is None else model.scores(texts)
        return scores, (scores >= 0.5).astype(np.int32)

    fields = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() != "held_out"]
    marked = docs.withColumn("held_out", _held_out("doc_id"))
    return append_columns(marked, ["text"], judge, fields, keep=[*kept, "held_out"])

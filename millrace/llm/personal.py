"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans. The field labels the tokens of a text that hold a
digit or an at sign (any other token is none of the kinds) with a kind or none:

* unary potentials from shape, length, neighbours and surrounding marks of a token;
* a chain between neighbouring tokens;
* skip edges between distant tokens of one text that repeat each other or are alike
  in their digits, so that all mentions of one number or address agree.

Loopy message passing gives each token's label, in every text that has tokens. The
potentials are trained piece by piece on the base spans of a bounded sample of texts, and
on the same texts with telephone numbers in notations that the patterns pass over. Spans
of tokens that the field is sure of and no pattern found are added. Evidence from
the patterns in the text itself enters through the tokens they cover, whose labels are given.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import append_columns, smallest

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
#: Texts that the field is trained on at most, of so many characters at most.
TRAINING_TEXTS = 2000
LONGEST_TRAINING_TEXT = 20_000
#: Weights of the unary features, which are hashed.
BUCKETS = 1 << 12
#: Probability from which a token counts if another of its label is tied to it, and if none is.
SURE = 0.8
SURE_ALONE = 0.95
PASSES = 8
#: Tokens are alike if so many of their last digits are equal.
LEAST_DIGITS = 7

Span = tuple[int, int, int]  # kind, start, end

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_HINT = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Leftmost matches, found from their at signs: a match starts where the run of
    local characters before its at sign does, or where the last match ended."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((0, start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return found


def base_spans(text: str) -> list[Span]:
    """The pattern matches of a text, by start and then kind."""
    if not _HINT.search(text):
        return []
    found = _emails(text)
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            found.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = "".join(_DIGIT.findall(m[0])) if m.end() - m.start() <= 60 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                found.append((3, m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], s[0]))


def listed(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


#: Digits with further groups of up to four behind marks, or anything with an at sign.
_TOKEN = re.compile(
    r"(?<![^\s@])[^\s@]+@[^\s@]+|\+?\(?[0-9]+(?:[).-]{0,2}\x20?\(?[0-9]{1,4}(?![0-9]))*", re.ASCII
)


class Tokens:
    """The tokens of a text that could be personal data."""

    def __init__(self, text: str, base: Sequence[Span]) -> None:
        spans = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
        # Tokens that overlap a base span give way to it.
        covered = sorted((s, e, k) for k, s, e in base)
        free, i = [], 0
        for start, end in spans:
            while i < len(covered) and covered[i][1] <= start:
                i += 1
            if i == len(covered) or covered[i][0] >= end:
                free.append((start, end, NONE))
        once: dict[tuple[int, int], int] = {}
        for start, end, kind in covered:
            once.setdefault((start, end), kind)
        known = [(s, e, k) for (s, e), k in once.items()]
        self.text = text
        self.all = sorted([*free, *known])
        self.given = np.array([k for _, _, k in self.all], np.int64)
        self.words = [text[s:e] for s, e, _ in self.all]
        self.digits = ["".join(_DIGIT.findall(w)) for w in self.words]

    def features(self) -> list[list[int]]:
        """Hashed features of each token."""
        rows = []
        for (start, end, _), word, digits in zip(self.all, self.words, self.digits, strict=True):
            shape = re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]", "9", word))
            before = self.text[max(0, start - 24) : start].rstrip().lower()
            last = before.split()[-1] if before.split() else ""
            names = (
                "shape=" + (shape if len(shape) <= 24 else shape[:24]),
                "marks=" + "".join(sorted(set(re.sub(r"[A-Za-z0-9]", "", word)))),
                f"digits={min(len(digits), 24)}",
                "groups=" + "-".join(str(len(g)) for g in re.findall(r"[0-9]+", word)[:6]),
                f"at={'@' in word}",
                f"luhn={12 <= len(digits) <= 19 and luhn(digits)}",
                "last=" + last[-12:],
                "next=" + self.text[end : end + 1],
                "bias",
            )
            rows.append([zlib.crc32(n.encode("utf-8", "surrogatepass")) % BUCKETS for n in names])
        return rows

    def skips(self) -> list[tuple[int, int]]:
        """Pairs of distant tokens that repeat each other or share their last digits.

        Each token is tied to the one before it in its group only, so a number that
        is repeated often makes a chain and not all its pairs.
        """
        groups: dict[str, list[int]] = defaultdict(list)
        for i, (word, digits) in enumerate(zip(self.words, self.digits, strict=True)):
            if "@" in word:
                groups["@" + word.strip(".,;:!?").lower()].append(i)
            elif len(digits) >= LEAST_DIGITS:
                groups[digits[-LEAST_DIGITS:]].append(i)
        return [pair for group in groups.values() for pair in zip(group[:-1], group[1:], strict=True)]


class Field:
    """Potentials of the field, as logarithms."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray) -> None:
        self.unary, self.chain, self.skip = unary, chain, skip

    def marginals(self, tokens: Tokens) -> np.ndarray:
        """Label probabilities of each token by loopy message passing."""
        count = len(tokens.all)
        local = np.array([self.unary[row].sum(axis=0) for row in tokens.features()]).reshape(count, -1)
        known = tokens.given != NONE
        local[known] = -30.0
        local[known, tokens.given[known]] = 0.0
        pairs = [(i, i + 1, self.chain) for i in range(count - 1)] + [(i, j, self.skip) for i, j in tokens.skips()]
        if not pairs:
            return _normal(local)
        a = np.array([p[0] for p in pairs])
        b = np.array([p[1] for p in pairs])
        table = np.stack([p[2] for p in pairs])
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        table = np.concatenate([table, table.transpose(0, 2, 1)])
        half = len(a)
        back = np.concatenate([np.arange(half, 2 * half), np.arange(half)])
        sent = np.zeros((len(source), NONE + 1))
        for _ in range(PASSES):
            belief = local.copy()
            np.add.at(belief, target, sent)
            out = (belief[source] - sent[back])[:, :, None] + table
            top = out.max(axis=1, keepdims=True)
            new = (top + np.log(np.exp(out - top).sum(axis=1, keepdims=True)))[:, 0]
            new -= new.max(axis=1, keepdims=True)
            sent = 0.5 * sent + 0.5 * new
        belief = local.copy()
        np.add.at(belief, target, sent)
        return _normal(belief)


def _normal(score: np.ndarray) -> np.ndarray:
    p = np.exp(score - score.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _other_notation(text: str, base: Sequence[Span], number: int) -> str | None:
    """``text`` with its telephone numbers written otherwise, character by character.

    By turns without the plus, with points between groups, and with hyphens.
    """
    phones = [(s, e) for k, s, e in base if KINDS[k] == "phone"]
    if not phones:
        return None
    out = list(text)
    for n, (start, end) in enumerate(phones):
        out[start] = " "
        mark = (None, ".", "-")[(number + n) % 3]
        for i in range(start + 1, end):
            if mark and out[i] in " -." and out[i - 1].isdigit() and i + 1 < end and out[i + 1].isdigit():
                out[i] = mark
    return "".join(out)


def _examples(text: str, base: Sequence[Span], number: int) -> tuple[list[list[int]], list[int]]:
    """Features and labels of the tokens of ``text`` in another notation that lie in its phones."""
    changed = _other_notation(text, base, number)
    if changed is None:
        return [], []
    kind = KINDS.index("phone")
    phones = [(s, e) for k, s, e in base if k == kind]
    tokens = Tokens(changed, base_spans(changed))
    rows, labels = [], []
    for (start, end, given), digits, row in zip(tokens.all, tokens.digits, tokens.features(), strict=True):
        inside = any(s <= start and end <= e for s, e in phones)
        if inside and given == NONE and len(digits) >= LEAST_DIGITS:
            rows.append(row)
            labels.append(kind)
    return rows, labels


def train(texts: Sequence[str]) -> Field | None:
    """Unary weights by regression on base labels, pair potentials from counted labels."""
    rows, labels = [], []
    chain = np.ones((NONE + 1, NONE + 1))
    skip = np.full((NONE + 1, NONE + 1), 0.01)  # what repeats a token is taken to agree
    for number, text in enumerate(texts):
        base = base_spans(text)
        tokens = Tokens(text, base)
        if not tokens.all:
            continue
        other_rows, other_labels = _examples(text, base, number)
        rows += other_rows
        labels += other_labels
        given = tokens.given
        np.add.at(chain, (given[:-1], given[1:]), 1)
        missed = set()  # patterns are sure of what they find, not of what they pass over
        for i, j in tokens.skips():
            if (given[i] == NONE) != (given[j] == NONE):
                missed.add(i if given[i] == NONE else j)
                continue
            skip[given[i], given[j]] += 1
            skip[given[j], given[i]] += 1
        for i, row in enumerate(tokens.features()):
            if i not in missed:
                rows.append(row)
                labels.append(given[i])
    if not rows:
        return None
    index, target = np.array(rows), np.array(labels)
    weight = np.zeros((BUCKETS, NONE + 1))
    wanted = np.eye(NONE + 1)[target]
    for _ in range(60):
        slope = wanted - _normal(weight[index].sum(axis=1))
        step = np.zeros_like(weight)
        for column in range(index.shape[1]):
            np.add.at(step, index[:, column], slope)
        seen = np.maximum(1, np.bincount(index.ravel(), minlength=BUCKETS))[:, None]
        weight += step / seen - 0.002 * weight
    skip = skip + 50 * np.eye(NONE + 1)

    def ratio(counts: np.ndarray) -> np.ndarray:
        joint = counts / counts.sum()
        return np.log(joint / np.outer(joint.sum(axis=1), joint.sum(axis=0)))

    return Field(weight, ratio(chain), ratio(skip))


def possible(kind: int, word: str, digits: str) -> bool:
    """Whether a token can be of a kind at all, whatever speaks for it."""
    if KINDS[kind] == "email":
        return "@" in word
    if KINDS[kind] == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if KINDS[kind] == "phone":
        return LEAST_DIGITS <= len(digits) <= 15 and "@" not in word
    groups = re.findall(r"[0-9]+", word)
    return len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)


def added_spans(text: str, base: Sequence[Span], field: Field | None) -> list[Span]:
    """Tokens that the field is sure of and no base span touches.

    A skip edge to another token of the label makes up for some doubt.
    """
    if field is None:
        return []
    tokens = Tokens(text, base)
    if all(k != NONE for _, _, k in tokens.all):
        return []
    probability = field.marginals(tokens)
    best = probability.argmax(axis=1)
    tied = set()
    for i, j in tokens.skips():
        if best[i] == best[j]:
            tied |= {i, j}
    found = []
    for i, (start, end, kind) in enumerate(tokens.all):
        label = int(best[i])
        if kind != NONE or label == NONE or not possible(label, tokens.words[i], tokens.digits[i]):
            continue
        if probability[i, label] >= (SURE if i in tied else SURE_ALONE):
            found.append((label, start, end))
    return found


_FIELDS = T.StructType(
    [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
)


def _find(field):
    def compute(texts: Sequence[str | None]) -> tuple:
        rows = []
        for text in texts:
            base = base_spans(text or "")
            kinds = Counter(s[0] for s in base)
            spans = sorted([*base, *added_spans(text or "", base, field.value)], key=lambda s: (s[1], s[0]))
            digest = hashlib.sha256(listed(base).encode()).hexdigest()
            rows.append((*[kinds[k] for k in range(NONE)], digest, listed(spans)))
        return tuple(zip(*rows, strict=True))

    return compute


def find_personal_data(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """``df`` (or its columns ``keep``) with the personal data of each whole text.

    Added: the number of base spans per kind, their digest, and all ``spans`` as
    kind:start:end in code points. A null text counts as empty and has no spans;
    repeated rows stay repeated; an empty table gives an empty result. Columns of
    ``df`` with names of new ones are replaced. The field is trained on at most
    ``TRAINING_TEXTS`` texts that hold a digit or an at sign, chosen by hash.
    """
    placed = (
        df.select(F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{doc_id}`", f"`{text}`").alias("_place"))
        .where(F.char_length("text") <= LONGEST_TRAINING_TEXT)
        .where(F.col("text").rlike("[0-9@]"))
    )
    sample = smallest(placed, "_place", TRAINING_TEXTS).select("text")
    field = train([r["text"] for r in sample.toLocalIterator()])
    shared = df.sparkSession.sparkContext.broadcast(field)
    return append_columns(df, [text], _find(shared), _FIELDS, keep)

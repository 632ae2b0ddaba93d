"""Quality rules from the fertility of a public tokenizer.

Each text gets three figures over the pieces of its words: characters per token,
the share of byte-fallback tokens, and the entropy of its tokens in bits. Texts
of one language and of about one length (tokens, by powers of two) are compared:
a figure beyond ``FENCE`` quartile ranges outside the quartiles rejects a text.
Quartiles come from all texts. A kind of fewer than ``LEAST_TEXTS`` takes the band of
a coarser one: the language at neighbouring lengths, the language, the script, or all
texts. Entropy grows with length, so coarser kinds compare by how much it differs from
what is usual at that length. Every text with tokens is held against some band.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import pairwise

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import append_columns
from millrace.llm.vocabulary import byte_range, piece_ids
from millrace.llm.words import Words, window_hashes
from millrace.scratch import fresh_path

FENCE = 3.0
LEAST_TEXTS = 50
#: Lengths with so many texts tell which entropy is usual, if there are any such.
LEAST_TEXTS_OF_LENGTH = 20
MOST_BYTE_SHARE = 0.5
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
_WINDOW = 3
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True

#: By the first byte of a character: its script, roughly; 0 for what tells none.
_SCRIPTS = np.zeros(256, np.int64)
for _number, (_low, _high) in enumerate(
    ((0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xCA), (0xCE, 0xCF), (0xD0, 0xD4), (0xD5, 0xD5), (0xD6, 0xD7),
     (0xD8, 0xDB), (0xE0, 0xE0), (0xE1, 0xE1), (0xE3, 0xE9), (0xEA, 0xED), (0xF0, 0xF4))
):
    _SCRIPTS[_low : _high + 1] = max(1, _number - 1)  # the first three are Latin

FIELDS = T.StructType(
    [T.StructField(n, T.LongType()) for n in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")]
    + [T.StructField(n, T.DoubleType()) for n in (
        "chars_per_token", "byte_share", "token_entropy")]
)
_MEASURED = T.StructType([*FIELDS, T.StructField("_script", T.LongType())])


def _sums(flags: np.ndarray, begin: np.ndarray) -> np.ndarray:
    totals = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return totals[begin[1:]] - totals[begin[:-1]]


def _repeated(hashes: np.ndarray) -> int:
    """Words inside windows that occur twice or more."""
    windows = window_hashes(hashes, _WINDOW)
    if len(windows) < 2:
        return 0
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[which] > 1
    covered = np.zeros(len(hashes), bool)
    for i in range(_WINDOW):
        covered[i : i + len(again)] |= again
    return int(covered.sum())


def _repeated_lines(lines: Sequence[bytes]) -> int:
    filled = [line for line in lines if line.strip()]
    return len(filled) - len(set(filled))


def measure(texts: Sequence[str | None], vocabulary: str, byte_ids: tuple[int, int]) -> tuple:
    """The columns of ``_MEASURED`` for a block of texts; a null text counts as empty."""
    words = Words(texts)
    pieces = piece_ids(vocabulary)
    inside = np.ones(256, bool)
    inside[[0x20, *range(0x09, 0x0E)]] = False
    letters = inside[words.data] & ((words.data & 0xC0) != 0x80)
    n_words = np.diff(words.first)
    chars = _sums(letters, words.begin)
    symbols = _sums(_SYMBOLS[words.data], words.begin)
    lines, repeated, tokens, share, entropy, scripts = [], [], [], [], [], []
    script = _SCRIPTS[words.data]
    whole = [words.bytes[a : b - 1] for a, b in pairwise(words.begin.tolist())]
    for i, packed in enumerate(pieces.of([text.split() for text in whole])):
        lines.append(_repeated_lines(whole[i].split(b"\n")))
        letters_of = np.bincount(script[words.begin[i] : words.begin[i + 1]], minlength=2)[1:]
        scripts.append(int(letters_of.argmax()) + 1 if letters_of.any() else 0)
        repeated.append(_repeated(words.hash[words.first[i] : words.first[i + 1]]))
        ids = np.frombuffer(packed, "<u2")
        tokens.append(len(ids))
        if not len(ids):
            share.append(None)
            entropy.append(None)
            continue
        share.append(float(np.mean((ids >= byte_ids[0]) & (ids < byte_ids[1]))))
        counts = np.bincount(ids)
        parts = counts[counts > 0] / len(ids)
        entropy.append(float(-(parts * np.log2(parts)).sum()))
    fertility = [c / t if t else None for c, t in zip(chars.tolist(), tokens, strict=True)]
    return (n_words, chars, symbols, lines, repeated, tokens, fertility, share, entropy, scripts)


def quality_measures(
    df: DataFrame, text: str, vocabulary: str, keep: Sequence[str] | None = None
) -> DataFrame:
    """``df`` with the columns of ``_MEASURED`` added, from whole texts."""
    byte_ids = byte_range(vocabulary)
    compute = lambda texts: measure(texts, vocabulary, byte_ids)
    return append_columns(df, [text], compute, _MEASURED, keep, remembers=vocabulary)


_BANDED = ("chars_per_token", "token_entropy")
#: What the texts of a kind have in common, from fine to coarse.
_LEVELS = (("language", "length"), ("language", "length"), ("language",), ("script",), ())


def _doublings() -> Column:
    return F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))


def _kind(language: str) -> dict[str, Column]:
    return {
        "language": F.coalesce(F.col(f"`{language}`").cast("string"), F.lit("")),
        "length": F.floor(_doublings()).cast("int"),
        "script": F.col("_script"),
    }


def entropy_excess(measured: DataFrame) -> tuple[Column, Column]:
    """The entropy less what is usual for a number of tokens: medians by length, joined by lines.

    Beyond the last length the usual entropy goes on rising, but no faster, and below the
    first it falls at least as fast and by one bit a halving at most. Between those two lines
    nothing is known, and the excess is 0. The second column is null there, since such
    a text tells nothing about the spread, and equal to the first elsewhere.
    """
    lengths = measured.where("n_tokens > 0").groupBy(F.floor(_doublings()).alias("length")).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx(_doublings(), 0.5, 10_000).alias("x"),
        F.percentile_approx("token_entropy", 0.5, 10_000).alias("y"),
    )
    rows = sorted(lengths.collect(), key=lambda r: r["x"])  # one row per power of two
    knots = [(r["x"], r["y"]) for r in rows if r["n"] >= LEAST_TEXTS_OF_LENGTH] or [(r["x"], r["y"]) for r in rows]
    if not knots:
        return F.col("token_entropy"), F.col("token_entropy")
    slopes = [(y1 - y0) / (x1 - x0) for (x0, y0), (x1, y1) in pairwise(knots)] or [1.0]
    x, entropy = _doublings(), F.col("token_entropy")

    def line(knot: tuple[float, float], slope: float) -> Column:
        return F.lit(knot[1]) + F.lit(slope) * (x - F.lit(knot[0]))

    def outside(one: Column, other: Column) -> Column:
        return F.least(F.lit(0.0), entropy - F.least(one, other)) + F.greatest(F.lit(0.0), entropy - F.greatest(one, other))

    first, last = knots[0], knots[-1]
    excess = F.when(x < first[0], outside(line(first, slopes[0]), line(first, 1.0)))
    for knot, slope, (end, _) in zip(knots, slopes, knots[1:], strict=False):
        excess = excess.when(x <= end, entropy - line(knot, slope))
    excess = excess.otherwise(outside(line(last, 0.0), line(last, slopes[-1])))
    return excess, F.when(x.between(first[0], last[0]), excess)


def fertility_bands(measured: DataFrame, language: str) -> DataFrame:
    """The lowest and highest accepted figures by level and what its kinds have in common.

    ``_sure_excess`` is that of ``entropy_excess``; the finest level has no need of it.
    """
    kind = _kind(language)
    nothing = {"language": F.lit(""), "length": F.lit(0), "script": F.lit(0).cast("bigint")}
    keys = []
    for level, common in enumerate(_LEVELS):
        for step in (-1, 0, 1) if level == 1 else (0,):
            values = {n: kind[n] if n in common else nothing[n] for n in nothing}
            values["length"] = values["length"] + F.lit(step)
            keys.append(F.struct(F.lit(level).alias("level"), *[v.alias(n) for n, v in values.items()]))
    figure = F.when(F.col("k.level") == 0, F.col("token_entropy")).otherwise(F.col("_sure_excess"))
    spread = measured.where("n_tokens > 0").select(
        F.explode(F.array(*keys)).alias("k"), "chars_per_token", "token_entropy", "_sure_excess"
    ).select("k.*", "chars_per_token", figure.alias("token_entropy"))
    names = ["level", *nothing]
    found = spread.groupBy(*names).agg(
        F.count(F.lit(1)).alias("_texts"),
        *[F.percentile_approx(c, [0.25, 0.75], 10_000).alias(f"_q_{c}") for c in _BANDED],
    )
    edges = []
    for c in _BANDED:
        low, high = F.col(f"_q_{c}")[0], F.col(f"_q_{c}")[1]
        edges += [
            (low - FENCE * (high - low)).alias(f"_low_{c}"),
            (high + FENCE * (high - low)).alias(f"_high_{c}"),
        ]
    enough = (F.col("_texts") >= LEAST_TEXTS) | (F.col("level") == len(_LEVELS) - 1)
    return found.where(enough).select(*names, *edges)


def _beyond(measured: DataFrame, bands: DataFrame, language: str) -> DataFrame:
    """``measured`` with ``_beyond``: whether a figure lies outside the finest band there is."""
    kind = _kind(language)
    joined, beyond = measured, []
    for level, common in enumerate(_LEVELS):
        edges = [f"{side}_{c}" for c in _BANDED for side in ("_low", "_high")]
        band = bands.where(F.col("level") == level).select(
            *[F.col(n).alias(f"_{n}_{level}") for n in common], *[F.col(e).alias(f"{e}_{level}") for e in edges]
        )
        # The last level has one row at most.
        match = F.lit(True)
        for n in common:
            match = match & (kind[n] == F.col(f"_{n}_{level}"))
        joined = joined.join(band if common else F.broadcast(band), match, "left")
        fits = F.lit(True)
        for c, figure in zip(_BANDED, ("chars_per_token", "_excess" if level else "token_entropy"), strict=True):
            fits = fits & F.col(figure).between(F.col(f"_low_{c}_{level}"), F.col(f"_high_{c}_{level}"))
        beyond.append(~fits)
    # Without a band the comparison is null, and the next level decides.
    return joined.withColumn("_beyond", F.coalesce(*beyond, F.lit(False)))


def quality_rules(
    df: DataFrame,
    text: str = "text",
    language: str = "lang",
    *,
    vocabulary: str,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` (or its columns ``keep``) with measures, ``base_failed`` and ``kept``.

    One row per input row, so repeated rows stay repeated. A null or empty text
    has no words and fails the base rules; a null language is a language of its
    own; an empty table gives an empty result. Columns of ``df`` with names of
    new ones are replaced. The measured rows are written once to the shared
    scratch folder, since the bands need them all before any can be judged.
    """
    made = {"base_failed", "kept", *[f.name for f in FIELDS]}
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in made]
    # Columns of the caller travel in one of ours, so that their names meet none.
    named = df.select(
        F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`").alias(f"_{c}") for c in keep]).alias("_held"),
        F.col(f"`{text}`").alias("_text"),
        F.col(f"`{language}`").alias("_language"),
    )
    language = "_language"
    measured = quality_measures(named, "_text", vocabulary, ["_held", language])
    path = fresh_path(df.sparkSession, "quality")
    measured.write.parquet(path)
    measured = df.sparkSession.read.schema(measured.schema).parquet(path)
    excess, sure = entropy_excess(measured)
    measured = measured.withColumns({"_excess": excess, "_sure_excess": sure})
    path = fresh_path(df.sparkSession, "bands")
    fertility_bands(measured, language).write.parquet(path)
    joined = _beyond(measured, df.sparkSession.read.parquet(path), language)
    outside = F.coalesce(F.col("byte_share") > MOST_BYTE_SHARE, F.lit(False)) | F.col("_beyond")
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return joined.select(
        *[F.col("_held").getField(f"_{c}").alias(c) for c in keep],
        *[f.name for f in FIELDS],
        failed.alias("base_failed"),
        (~failed & ~outside).alias("kept"),
    )

"""Language of texts by unigram pieces, whatever way a word is cut into them.

Every language has probabilities for the pieces of one public vocabulary. A forward
pass over a word adds up the products of all its segmentations, so no single cut
decides; texts add the logarithms over their words. The probabilities are learned by
expectation maximisation (forward and backward) from the words of ``TRAINING_TEXTS``
texts a language at most, ``TRAINING_WORDS`` different ones of them, chosen by
hash and frequency.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import append_columns, remembered
from millrace.llm.vocabulary import PUNCTUATION, Remembered

TRAINING_TEXTS = 300
#: Different words to learn from per language, the most frequent ones.
TRAINING_WORDS = 200_000
ROUNDS = 3
MOST_BROADCAST_LANGUAGES = 10_000
#: Weight of each piece before anything is seen, as a share of a count.
PRIOR = 0.01
#: For learning alone longer words are parted; scores sum over whole words.
STRETCH = 40
#: Words up to so many characters are scored together, longer ones one by one.
LONGEST_TOGETHER = 256
#: Numbers that the sums of words scored together take up at most.
_HELD = 1 << 22
#: Words of a text whose scores are added at a time.
_WORDS_ADDED = 1 << 15
#: Places after which sums are brought back to a size near 1.
_RESCALED = 16
UNKNOWN = "und"
_START = "▁"
_LEAST = 1e-7


class Pieces:
    """Numbers of the text pieces of a vocabulary; 0 stands for any other character."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        texts = {
            model.id_to_piece(i).lower()
            for i in range(model.vocab_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        }
        self.number = {piece: i + 1 for i, piece in enumerate(sorted(texts))}
        self.begun = {piece[:n] for piece in texts for n in range(1, len(piece) + 1)}
        self.size = len(self.number) + 1
        self.longest = max(map(len, texts), default=1)

    def edges(self, word: str) -> list[tuple[int, int, int]]:
        """(end, start, piece) for every piece at every place."""
        number, begun, out = self.number, self.begun, []
        for start in range(len(word)):
            if word[start] not in number:
                out.append((start + 1, start, 0))
            for end in range(start + 1, len(word) + 1):
                part = word[start:end]
                if part not in begun:
                    break
                piece = number.get(part)
                if piece is not None:
                    out.append((end, start, piece))
        return out


def whole_word(word: str, pieces: Pieces, weight: np.ndarray) -> np.ndarray:
    """Log-likelihoods of one word of any length, over all its segmentations.

    Holds the sums of as many places as the longest piece has characters.
    """
    reach = pieces.longest
    sums = [np.ones(weight.shape[1])]
    scale = np.zeros(weight.shape[1])
    for end in range(1, len(word) + 1):
        total = np.zeros(weight.shape[1])
        if word[end - 1] not in pieces.number:
            total = sums[-1] * weight[0]
        for n in range(1, min(reach, end) + 1):
            piece = pieces.number.get(word[end - n : end])
            if piece is not None:
                total = total + sums[-n] * weight[piece]
        sums.append(total)
        if len(sums) > reach:
            del sums[0]
        if end % _RESCALED == 0:
            top = np.maximum(np.max(sums, axis=0), 1e-300)
            sums = [s / top for s in sums]
            scale += np.log(top)
    return scale + np.log(np.maximum(sums[-1], 1e-300))


def word_likelihoods(words: Sequence[str], pieces: Pieces, weight: np.ndarray) -> np.ndarray:
    """Log-likelihoods of words by language, each summed over all segmentations.

    Words of similar lengths go together, so many at a time that their sums stay within
    ``_HELD`` numbers whatever the languages; memory does not grow with a word's length.
    """
    languages = weight.shape[1]
    out = np.zeros((len(words), languages))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    most = max(1, _HELD // ((pieces.longest + 1) * max(languages, 1)))
    together = order[: np.searchsorted(lengths[order], LONGEST_TOGETHER, "right")]
    for start in range(0, len(together), most):
        chosen = together[start : start + most]
        out[chosen] = Lattices([words[i] for i in chosen], pieces).log_likelihood(weight, pieces.longest)
    for i in order[len(together) :]:
        out[i] = whole_word(words[i], pieces, weight)
    return out


def stretches(word: str) -> list[str]:
    marked = _START + word
    return [marked[i : i + STRETCH] for i in range(0, len(marked), STRETCH)]


class Lattices:
    """The piece edges of many words, grouped by where they end."""

    def __init__(self, words: Sequence[str], pieces: Pieces) -> None:
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = [(end, i, start, piece) for i, w in enumerate(words) for end, start, piece in pieces.edges(w)]
        table = np.array(flat, np.int64).reshape(-1, 4)
        table = table[np.argsort(table[:, 0], kind="stable")]
        self.end, self.word, self.start, self.piece = table.T
        longest = int(self.lengths.max()) if len(words) else 0
        self.bounds = np.searchsorted(self.end, np.arange(1, longest + 2))
        self.longest = longest

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Sums over all ways to reach each place; ``weight`` is pieces by languages."""
        count, languages = len(self.lengths), weight.shape[1]
        sums = np.zeros((count, self.longest + 1, languages))
        sums[:, 0] = 1
        for end in range(1, self.longest + 1):
            a, b = self.bounds[end - 1], self.bounds[end]
            if a == b:
                continue
            ways = sums[self.word[a:b], self.start[a:b]] * weight[self.piece[a:b]]
            # Edges with one end are in the order of their words.
            first = np.concatenate([[0], np.flatnonzero(np.diff(self.word[a:b])) + 1])
            sums[self.word[a:b][first], end] = np.add.reduceat(ways, first, axis=0)
        return sums

    def backward(self, weight: np.ndarray) -> np.ndarray:
        """Sums over all ways from each place to the word's end."""
        count, languages = len(self.lengths), weight.shape[1]
        sums = np.zeros((count, self.longest + 1, languages))
        sums[np.arange(count), self.lengths] = 1
        for end in range(self.longest, 0, -1):
            a, b = self.bounds[end - 1], self.bounds[end]
            np.add.at(sums, (self.word[a:b], self.start[a:b]), sums[self.word[a:b], end] * weight[self.piece[a:b]])
        return sums

    def log_likelihood(self, weight: np.ndarray, reach: int) -> np.ndarray:
        """Of each word over all its segmentations, from the sums of the last ``reach`` places."""
        count, languages = len(self.lengths), weight.shape[1]
        sums = np.zeros((count, reach + 1, languages))
        sums[:, 0] = 1
        scale, out = np.zeros((count, languages)), np.zeros((count, languages))
        by_length = np.argsort(self.lengths, kind="stable")
        ends = np.searchsorted(self.lengths[by_length], np.arange(self.longest + 2))
        for end in range(1, self.longest + 1):
            a, b = self.bounds[end - 1], self.bounds[end]
            alive = by_length[ends[end] :]
            slot = end % (reach + 1)
            sums[alive, slot] = 0
            if a < b:
                word = self.word[a:b]
                ways = sums[word, self.start[a:b] % (reach + 1)] * weight[self.piece[a:b]]
                # Edges with one end are in the order of their words.
                first = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
                sums[word[first], slot] = np.add.reduceat(ways, first, axis=0)
            done = by_length[ends[end] : ends[end + 1]]
            out[done] = scale[done] + np.log(np.maximum(sums[done, slot], 1e-300))
            if end % _RESCALED == 0:
                left = by_length[ends[end + 1] :]
                top = np.maximum(sums[left].max(axis=1), 1e-300)
                sums[left] /= top[:, None]
                scale[left] += np.log(top)
        return out


def learn(counts: dict[str, dict[str, int]], pieces: Pieces) -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities from word counts per language."""
    languages = sorted(counts)
    columns = []
    for language in languages:
        parts: dict[str, int] = {}
        for word, n in counts[language].items():
            for part in stretches(word):
                parts[part] = parts.get(part, 0) + n
        lattice = Lattices(list(parts), pieces)
        times = np.fromiter(parts.values(), float, len(parts))
        weight = np.full((pieces.size, 1), 1 / pieces.size)
        for _ in range(ROUNDS):
            ahead, behind = lattice.forward(weight), lattice.backward(weight)
            whole = ahead[np.arange(len(times)), lattice.lengths, 0]
            share = (
                ahead[lattice.word, lattice.start, 0]
                * weight[lattice.piece, 0]
                * behind[lattice.word, lattice.end, 0]
                / np.maximum(whole[lattice.word], 1e-300)
                * times[lattice.word]
            )
            expected = np.bincount(lattice.piece, share, pieces.size) + PRIOR
            weight = np.maximum(expected / expected.sum(), _LEAST)[:, None]
        columns.append(weight[:, 0])
    return languages, np.stack(columns, axis=1)


def _scorer(weight: np.ndarray, path: str) -> Remembered:
    """Per word, its log-likelihoods in all languages as 32-bit floats."""
    pieces = Pieces(path)
    nothing = np.zeros(weight.shape[1], "<f4").tobytes()

    def score(words: list[bytes]) -> list[bytes]:
        texts = [_START + w.decode("utf-8", "replace") for w in words]
        return [row.tobytes() for row in word_likelihoods(texts, pieces, weight).astype("<f4")]

    bare = Remembered(score)

    def make(words: list[bytes]) -> list[bytes]:
        cut = [w.strip(PUNCTUATION) for w in words]
        return [made or nothing for made in bare.of([[c] if c else [] for c in cut])]

    return Remembered(make)


_FIELDS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def _predict(model, name: str, path: str):
    def compute(texts: Sequence[str | None]) -> tuple:
        languages, weight = model.value
        scorer = remembered(name, lambda: _scorer(weight, path))
        lettered = [t is not None and any(map(str.isalpha, t)) for t in texts]
        if not languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        names, scores = [], []
        words = [
            t.lower().encode("utf-8", "surrogatepass").split() if ok else []
            for t, ok in zip(texts, lettered, strict=True)
        ]
        totals = np.zeros((len(texts), len(languages)))
        # All texts at once, but a long one part by part.
        for start in range(0, max(map(len, words), default=0), _WORDS_ADDED):
            parts = [w[start : start + _WORDS_ADDED] for w in words]
            for i, packed in enumerate(scorer.of(parts)):
                totals[i] += np.frombuffer(packed, "<f4").reshape(-1, len(languages)).sum(axis=0, dtype=float)
        for total, ok in zip(totals, lettered, strict=True):
            if not ok:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            best = int(total.argmax())
            names.append(languages[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return names, scores

    return compute


def held_out(doc_id: str) -> Column:
    """Whether a row is kept from learning: its id's checksum leaves 1 divided by 3."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % 3 == 1, F.lit(False))


def training_words(df: DataFrame, doc_id: str, text: str, language: str) -> dict[str, dict[str, int]]:
    """Word counts of about ``TRAINING_TEXTS`` texts per language, of ``TRAINING_WORDS`` words."""
    known = df.where(~held_out(doc_id)).where(F.col(f"`{language}`").isNotNull()).select(
        F.col(f"`{language}`").cast("string").alias("language"),
        F.col(f"`{text}`").alias("text"),
        F.pmod(F.xxhash64(f"`{doc_id}`"), F.lit(1 << 30)).alias("place"),
    )
    sizes = known.groupBy("language").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumnRenamed("language", "_language")
    if sizes.count() <= MOST_BROADCAST_LANGUAGES:  # else texts are shuffled by language
        sizes = F.broadcast(sizes)
    chosen = known.join(sizes, F.col("language") == F.col("_language"))
    chosen = chosen.where(F.col("place") < F.lit(float(TRAINING_TEXTS << 30)) / F.col("n"))
    words = chosen.select("language", F.explode(F.split(F.lower("text"), "[ \\t-\\r]+")).alias("word"))
    words = words.withColumn("word", F.regexp_replace("word", "^[!-/:-@\\[-`{-~]+|[!-/:-@\\[-`{-~]+$", ""))
    counted = words.where("word <> ''").groupBy("language", "word").agg(F.count(F.lit(1)).alias("n"))
    by_number = Window.partitionBy("language").orderBy(F.col("n").desc(), "word")
    counted = counted.withColumn("place", F.row_number().over(by_number)).where(F.col("place") <= TRAINING_WORDS)
    found: dict[str, dict[str, int]] = {}
    for row in counted.toLocalIterator():
        found.setdefault(row["language"], {})[row["word"]] = row["n"]
    return found


def identify_language(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    *,
    vocabulary: str,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every whole text.

    Learns from rows that are not held out and have a language; predicts from the
    text alone. ``score`` is the predicted language's share of the likelihood.
    Null texts and those without a letter are ``und`` with score 0, as is every text
    if there is nothing to learn from. Rows with a null id are not held out.
    Repeated rows stay repeated; an empty table gives an empty result; other
    columns are not looked at.
    """
    model = learn_from(training_words(df, doc_id, text, language), vocabulary)
    shared, name = df.sparkSession.sparkContext.broadcast(model), f"language {uuid.uuid4().hex}"
    rows = df.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), held_out(doc_id).alias("held_out")
    )
    return append_columns(
        rows, ["text"], _predict(shared, name, vocabulary), _FIELDS, ["doc_id", "held_out"], remembers=name
    )


def learn_from(counts: dict[str, dict[str, int]], vocabulary: str) -> tuple[list[str], np.ndarray]:
    pieces = Pieces(vocabulary)
    if not counts:
        return [], np.zeros((pieces.size, 0))
    return learn(counts, pieces)

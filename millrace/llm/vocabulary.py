"""Token ids of words by public vocabularies, remembered per worker process."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from millrace.llm.batches import remembered

#: Words remembered at most by one worker process, which bounds its memory.
REMEMBERED = 600_000
_LONGEST_REMEMBERED = 64


class Remembered:
    """Ids of words as bytes, made for many new words at once.

    Two generations: when the younger is full it becomes the older, whose words
    come back when they are met again; frequent words therefore stay.
    """

    def __init__(self, make: Callable[[list[bytes]], list[bytes]]) -> None:
        self.make = make
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def of(self, texts: Sequence[Sequence[bytes]]) -> list[bytes]:
        """For each list of words, the ids of all of them, one after another."""
        self._turn()
        long = self._learn(set().union(*texts))
        joined = [b"".join(map(self.young.__getitem__, words)) for words in texts]
        self._forget(long)
        return joined

    def each(self, words: Sequence[bytes]) -> list[bytes]:
        """The ids of each word."""
        self._turn()
        ids = [*map(self.young.get, words)]
        missing = [i for i, known in enumerate(ids) if known is None]
        long = self._learn({words[i] for i in missing})
        for i in missing:
            ids[i] = self.young[words[i]]
        self._forget(long)
        return ids

    def _turn(self) -> None:
        if len(self.young) > REMEMBERED // 2:
            self.old, self.young = self.young, {}

    def _learn(self, words: set[bytes]) -> list[bytes]:
        """Makes all ``words`` young; those of them that are too long to stay."""
        young, old = self.young, self.old
        new = []
        for word in words:
            if word not in young:
                if word in old:
                    young[word] = old[word]
                else:
                    new.append(word)
        if new:
            young.update(zip(new, self.make(new), strict=True))
        return [w for w in new if len(w) > _LONGEST_REMEMBERED]

    def _forget(self, words: Sequence[bytes]) -> None:
        for word in words:
            del self.young[word]


def piece_ids(path: str) -> Remembered:
    """Per word, little-endian 16-bit ids of a sentencepiece model with a word start."""
    return remembered(path, lambda: _load_pieces(path))


def _load_pieces(path: str) -> Remembered:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if model.vocab_size() > 1 << 16:
        raise ValueError(f"{path} has more pieces than 16 bits can number")

    def make(words: list[bytes]) -> list[bytes]:
        made = model.encode([w.decode("utf-8", "replace") for w in words], num_threads=1)
        return _packed(made, "<u2")

    return Remembered(make)


def _packed(ids: Sequence[Sequence[int]], kind: str) -> list[bytes]:
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter((i for word in ids for i in word), kind, int(lengths.sum())).tobytes()
    ends = (np.cumsum(lengths) * np.dtype(kind).itemsize).tolist()
    return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def byte_range(path: str) -> tuple[int, int]:
    """First id of the byte-fallback pieces and the id after the last."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.vocab_size()) if model.is_byte(i)]
    return (ids[0], ids[-1] + 1) if ids else (0, 0)


#: How special tokens, which count wherever they stand in a text, begin.
_SPECIAL = b"<|"
#: Words that are encoded as one text, and what ends a word in vocabularies that mark it.
_JOINED = 2000
_WORD_END = "</w>"
PUNCTUATION = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
_ALNUM = np.array([b < 0x80 and chr(b).isalnum() for b in range(256)])


def _stem(word: bytes) -> bytes:
    """``word`` in ASCII lower case without the punctuation after its last letter or digit.

    That letter is looked at in lower case, in which some end in a mark that belongs to the
    punctuation. A word that may hold a special token is left as it is.
    """
    if _SPECIAL in word:
        return word
    core = word.rstrip(PUNCTUATION)
    if core and len(core) < len(word):
        last = core[-1:] if core[-1] < 0x80 else core[-4:].decode("utf-8", "ignore")[-1:]
        if not last.lower()[-1:].isalnum():
            core = word
    return (core or word).lower()


def _bytes_of(texts: pa.StringArray) -> tuple[bytes, np.ndarray]:
    """All texts as one, and where each begins there, with the end of the last."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return data.to_pybytes() if data else b"", at.astype(np.int64)


class Stemmed:
    """Ids of words, from remembered ones of their stems and of the punctuation behind."""

    def __init__(self, make: Callable[[list[bytes]], list[bytes]]) -> None:
        self.stems = Remembered(make)

    def of(self, texts: Sequence[Sequence[bytes]]) -> list[bytes]:
        """For each list of words, the ids of all of them, one after another."""
        words = [*set().union(*texts)]
        cut = [*map(_stem, words)]
        ids = dict(zip(words, self.stems.each(cut), strict=True))
        behind = {w: w[len(c) :] for c, w in zip(cut, words, strict=True) if len(c) < len(w)}
        for word, more in zip(behind, self.stems.each([*behind.values()]), strict=True):
            ids[word] += more
        return [b"".join(map(ids.__getitem__, text)) for text in texts]

    def of_texts(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each whole text, whose words are parted at ASCII white space.

        Arrow parts and numbers the words in ASCII lower case, and only different ones
        are looked up. Texts that may hold special tokens are taken word by word.
        """
        if not texts:
            return []
        whole = pc.fill_null(pa.array(texts, pa.string()), "")
        special = pc.match_substring(whole, _SPECIAL.decode())
        parted = pc.ascii_split_whitespace(pc.if_else(special, "", pc.ascii_lower(whole)))
        words = parted.flatten().dictionary_encode()  # with the empty one where space begins or ends a text
        ids = self._of_different(words.dictionary)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(sizes) - sizes
        number = words.indices.to_numpy()
        size = sizes[number]
        ends = np.concatenate([[0], np.cumsum(size)])
        # Where an id is among those of the different words: by as much further as its word is.
        taken = np.repeat(first[number] - ends[:-1], size) + np.arange(ends[-1])
        joined = np.frombuffer(b"".join(ids), "<u4")[taken].tobytes()
        made = [joined[a:b] for a, b in pairwise((4 * ends[parted.offsets.to_numpy()]).tolist())]
        for i in np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist():
            made[i] = self.of([texts[i].encode().split()])[0]
        return made

    def _of_different(self, words: pa.StringArray) -> list[bytes]:
        """The ids of words in ASCII lower case without special tokens, cut as by ``_stem``."""
        data, at = _bytes_of(words)
        start, end = at[:-1], at[1:]
        cores = pc.ascii_rtrim(words, characters=PUNCTUATION.decode())
        cut = start + pc.binary_length(cores).to_numpy(zero_copy_only=False)
        last = np.frombuffer(b" " + data, np.uint8)[cut]
        sure = (cut == end) | ((cut > start) & _ALNUM[last])
        for i in np.flatnonzero(~sure).tolist():
            cut[i] = start[i] + len(_stem(data[start[i] : end[i]]))
        ids = self.stems.each([data[a:b] for a, b in zip(start.tolist(), cut.tolist(), strict=True)])
        ended = np.flatnonzero(cut < end)
        behind = [data[a:b] for a, b in zip(cut[ended].tolist(), end[ended].tolist(), strict=True)]
        for i, more in zip(ended.tolist(), self.stems.each(behind), strict=True):
            ids[i] += more
        return ids


def word_ids(path: str) -> Stemmed:
    """Per white-space separated word, little-endian 32-bit ids of a tokenizers file.

    Right for vocabularies that drop white space, never join across it, ignore case
    and part letters from punctuation; then a word's ids are those of its stem and
    those of the punctuation behind it. Special tokens in a text are special, as they are
    to the tokenizer by default.
    """
    return remembered(path, lambda: _load_words(path))


def _load_words(path: str) -> Stemmed:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks fill the cores
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    ends = np.zeros(model.get_vocab_size(), bool)
    ends[[i for piece, i in model.get_vocab().items() if piece.endswith(_WORD_END)]] = True

    def singly(texts: list[str]) -> list[bytes]:
        made = model.encode_batch_fast(texts, add_special_tokens=False)
        return _packed([e.ids for e in made], "<u4")

    def together(texts: list[str]) -> list[bytes]:
        """Words of letters, encoded as one text and parted where a word ends."""
        ids = np.array(model.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0].ids, "<u4")
        behind = 4 * (np.flatnonzero(ends[ids]) + 1)
        if len(behind) != len(texts):  # some word falls apart, or the vocabulary marks no ends
            return singly(texts)
        flat = ids.tobytes()
        return [flat[a:b] for a, b in zip([0, *behind[:-1].tolist()], behind.tolist(), strict=True)]

    def encode(words: list[bytes]) -> list[bytes]:
        texts = [w.decode("utf-8", "replace") for w in words]
        plain = [i for i, t in enumerate(texts) if t.isalpha()]
        other = [i for i, t in enumerate(texts) if not t.isalpha()]
        out: list[bytes] = [b""] * len(texts)
        for start in range(0, len(plain), _JOINED):
            chosen = plain[start : start + _JOINED]
            for i, ids in zip(chosen, together([texts[i] for i in chosen]), strict=True):
                out[i] = ids
        for i, ids in zip(other, singly([texts[i] for i in other]) if other else [], strict=True):
            out[i] = ids
        return out

    return Stemmed(encode)

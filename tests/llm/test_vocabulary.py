"""Ids of words against the tokenizer on whole texts."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import vocabulary

WORDS = public_tokenizers.path("word_bpe_49k.json")
SPECIAL = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "<|x|>"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def words():
    return vocabulary._load_words(WORDS)


def ids_of(words, text):
    return np.frombuffer(words.of([text.encode().split()])[0], "<u4").tolist()


@pytest.mark.parametrize(
    "text",
    [
        "SAHİBİ. MİLLİ, İ! İ", "a<|endoftext|>b <|endoftext|> <|startoftext|>. <|ENDOFTEXT|>", "x <|endoftext|", "don't DON'T 'S it's'",
        "ΑΣ. ΣΑΣ, ﬁn. ŉ! ǅ? é. É, ² ½. Ⅷ!", "中文。句子!", "ß. ẞ.", "", "ȧ. i̇!", "̇. ẋ̇,",
    ],
)
def test_known_cases(tokenizer, words, text):
    assert ids_of(words, text) == tokenizer.encode(text, add_special_tokens=False).ids


PIECES = st.one_of(
    st.text(max_size=8),
    st.text("abcİıŞşéßΣσ'.,!?-<|>0123 ", max_size=10),
    st.sampled_from([*SPECIAL, " ", "İ.", "MİLLİ,", "'s", "̇"]),
)


@settings(max_examples=600, deadline=None)
@given(st.lists(PIECES, max_size=12))
def test_random_texts(tokenizer, words, pieces):
    text = "".join(pieces)
    # Texts are parted at the white space of bytes; other white space is the tokenizer's.
    assert ids_of(words, text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_words_together_and_alone(words, tokenizer):
    chance = random.Random(4)
    made = {"".join(chance.choices("abcdeéİσΣnt", k=chance.randint(1, 12))) for _ in range(9000)}
    got = words.of([[w.encode()] for w in made])
    for word, ids in zip(made, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(word, add_special_tokens=False).ids


def whole_ids(words, texts):
    return [np.frombuffer(ids, "<u4").tolist() for ids in words.of_texts(texts)]


def test_whole_texts_are_parted_as_bytes_are(tokenizer, words):
    texts = [
        None, "", " \x0b\x0c\t", "\nOne, two,  one!\r", "a\x1cb\x85c\u3000d", "İ. MİLLİ, É!! é!!", "$$$ x$$$ $x", "x\x01,",
        "A<|endoftext|>B <|x|> <|", "<|ENDOFTEXT|>,", "中文。句子! ²,", "it's IT'S 's,", "w" * 90 + ",", " end ",
    ]
    expected = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert whole_ids(words, texts) == expected
    assert whole_ids(words, texts[:3]) == [[], [], []] and words.of_texts([]) == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=6).map("".join), max_size=5))
def test_random_whole_texts(tokenizer, words, texts):
    assert whole_ids(words, texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_that_differ_in_case_and_punctuation_are_encoded_once():
    asked = []
    words = vocabulary.Stemmed(lambda new: (asked.extend(new), [b"%4d" % len(w) for w in new])[1])
    assert words.of_texts(["One one, ONE!", "one."]) == [b"   3   3   1   3   1", b"   3   1"]
    assert sorted(asked) == [b"!", b",", b".", b"one"]

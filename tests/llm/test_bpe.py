"""The encoder against the tokenizers library, and the round trip through Spark."""

import random

import numpy as np
import pytest
from paddock.llm import bpe
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


@pytest.fixture(scope="module")
def own():
    return bpe.WordBpe(bpe.default_path())


def test_random_texts(library, own):
    pieces = [*"abc'sTé́ΣςİıßﬁÁ  \x1c\x85​\n9٣½_-漢字한🙂", "<|endoftext|>", "<|startoftext|>", "'ll", "the", "ing", "tion"]
    chance = random.Random(1)
    texts = ["".join(chance.choice(pieces) for _ in range(chance.randint(0, 25))) for _ in range(1500)]
    for text, ids in zip(texts, own.encode_many(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text
        assert own.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_long_word_and_long_text(library, own):
    text = "abcde" * 3000 + " " + "Thing, other " * 60_000
    assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_pair_rule(own):
    """A proposal whose neighbours all stay is the exact result, one with a failing pair is not."""
    chance = random.Random(2)
    parts = ["the", "ing", "er", "tion", "an", "ou", "s", "nt", "b"]
    for _ in range(400):
        word = own._mapped_word("".join(chance.choice(parts) for _ in range(chance.randint(1, 6))))
        proposed = own._greedy(word)
        keys = [a << 16 | b for a, b in zip(proposed, proposed[1:])] or [proposed[0] << 16 | 0xFFFF]
        stays = own._fit(np.array(keys, np.uint32)).all()
        assert stays == (own._merge_many([own._start(word)])[0] == proposed)


def test_cache_turns_over(library, own, monkeypatch):
    for name, size in (("STORE_WORDS", 64), ("STORE_BYTES", 300), ("STORE_IDS", 200)):
        monkeypatch.setattr(bpe, name, size)
    monkeypatch.setattr(own.words, "entries", 30)
    monkeypatch.setattr(own, "store", bpe.Store())
    monkeypatch.setattr(bpe, "PIECE", 100)
    texts = [" ".join(f"w{i}{j}" + "\u4e00" * (i % 3 == 2) for j in range(40)) for i in range(30)] * 2
    for text, ids in zip(texts, own.encode_many(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_spark(spark, docs, odd_texts, library):
    pairs = [(i, t) for i, t in enumerate(odd_texts)] + [(None, "no id"), (3, "twice"), (3, "twice")]
    encoded = bpe.encode_documents(docs(pairs, clash=True))
    got = {(r.doc_id, tuple(r.ids)) for r in encoded.collect()}
    assert got == {(i, tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t in pairs}
    decoded = bpe.decode_documents(encoded).count()
    assert decoded == len(pairs) == bpe.round_trip(docs(pairs)).count()
    assert bpe.round_trip(docs([])).count() == 0


def test_words_with_equal_hashes(library, own, monkeypatch):
    """A hash decides nothing: all words share one, and the store keeps giving each its own ids."""
    monkeypatch.setattr(bpe.Store, "hashes", lambda self, flat, starts, sizes: np.full(len(starts), 7, np.uint64))
    monkeypatch.setattr(own, "store", bpe.Store())
    texts = ["alpha beta gamma", "beta delta", "gamma alpha", "delta alphx"] * 3
    monkeypatch.setattr(bpe, "PIECE", 10)
    for text, ids in zip(texts, own.encode_many(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_of_every_length(library, own):
    chance = random.Random(8)
    texts = [" ".join("".join(chance.choice("abcdeé9") for _ in range(n)) for n in range(1, 140)) for _ in range(8)]
    for text, ids in zip(texts, own.encode_many(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids

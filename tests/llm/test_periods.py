"""Runs of words against a search of every period at every place."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from paddock.llm import periods


def brute_runs(words):
    """Every maximal stretch of smallest period q, by trying each q."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            if length >= max(6, 4 * q) and end > at:
                stretch = words[at : at + length]
                if not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                    found.append((at, length, q))
            at = max(end, at + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    words = [w for w in __import__("re").split("[ \t-\r]+", text or "") if w]
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    exponent = 1000 * best[1] // best[2] if runs else None
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, exponent, sha("".join("%d,%d,%d\n" % r for r in runs)), sha(kept))


def numbered(words):
    return np.array([*words, max(words, default=0) + 1], np.int64)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=120))
def test_small_alphabets(words):
    found = sorted(periods.maximal_runs(numbered(words), len(words) // 2), key=lambda r: (r[0], r[2]))
    assert found == brute_runs(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 9), min_size=1, max_size=30), st.integers(1, 9)), max_size=6))
def test_planted_repeats(parts):
    words = [w for unit, times in parts for w in unit * times]
    found = sorted(periods.maximal_runs(numbered(words), len(words) // 2), key=lambda r: (r[0], r[2]))
    assert found == brute_runs(words)


def test_range_successor():
    rng = random.Random(1)
    values = rng.sample(range(500), 300)
    tree = periods.WaveletTree(np.array(values), 9)
    for _ in range(300):
        low, high = sorted((rng.randrange(301), rng.randrange(301)))
        value = rng.randrange(500)
        want = min((v for v in values[low:high] if v > value), default=-1)
        assert tree.successor(*(np.array([x]) for x in (low, high, value))).tolist() == [want]


@pytest.mark.parametrize("at_once", [50, 1 << 17])
def test_documents(spark, docs, odd_texts, monkeypatch, at_once):
    monkeypatch.setattr(periods, "WORDS", at_once)
    rng = random.Random(2)
    texts = [*odd_texts[:5], *odd_texts[6:], "word " * 500]
    for _ in range(150):
        unit = " ".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 12)))
        texts.append(" ".join([unit] * rng.randrange(1, 8)) + rng.choice(["", "\t x", "\n" + unit, "\x1c  y"]))
    pairs = list(enumerate(texts)) + [(None, "a a a a a a a"), (7, "a b a b a b a b"), (7, "a b a b a b a b")]
    frame = docs(pairs, clash=True).repartition(3)
    got = periods.summary(periods.find(periods.planted(frame)))
    assert got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    assert {t for _, t in got.dtypes} == {"bigint", "string"}
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((brute(*p) for p in pairs), key=repr)


def test_long_text(spark, docs):
    found = periods.find(docs([(1, "word " * 60_000), (2, "x" * 300_000)])).collect()
    assert [[tuple(r) for r in f.runs] for f in found] == [[(0, 60_000, 1)], []]
    assert [len(f.collapsed) for f in found] == [4, 300_000]


def test_empty_table(spark, docs):
    assert periods.summary(periods.find(periods.planted(docs([])))).count() == 0


def test_spans_of_runs(spark, docs):
    found = periods.find(docs([(1, "so it is a b c a b c a b c a b c end")])).first()
    assert [tuple(r) for r in found.runs] == [(3, 12, 3)] and found.collapsed == "so it is a b c end"

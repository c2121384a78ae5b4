"""One-permutation MinHash against a plain computation of bins, densification and exact likenesses."""

import hashlib
import random
import re

import pytest
import xxhash
from paddock.llm import minhash


def xx(*parts):
    """XXH64 of numbers one after the other, the last hash as the next seed."""
    seed = 42
    for value, size in parts:
        seed = xxhash.xxh64_intdigest((value % (1 << 8 * size)).to_bytes(size, "little"), seed)
    return seed


def words_of(text):
    return [w for w in re.split("[ \t-\r]+", text or "") if w]


def shingles_of(text):
    words = words_of(text)
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute(text):
    hashed = lambda shingle: xx(*[(xxhash.xxh64_intdigest(w.encode(), 42), 8) for w in shingle])
    signed = sorted((h ^ 1 << 63) for h in map(hashed, shingles_of(text)))
    bins = {}
    for h in signed:
        bins.setdefault(h >> 56, h & 15)
    if not bins:
        return "0" * 256

    def value(i):
        if i in bins:
            return bins[i]
        for t in range(minhash.PROBES):
            drawn = xx((i, 4), (t, 4)) & 255
            if drawn in bins:
                return bins[drawn]
        signed_rank = lambda b: (xx((i, 4), (b, 4)) ^ 1 << 63) >> 4 << 4 | bins[b]
        return min(map(signed_rank, bins)) & 15

    return "".join(f"{value(i):x}" for i in range(256))


def jaccard(one, other):
    a, b = shingles_of(one), shingles_of(other)
    return len(a & b) / len(a | b) if a | b else 1.0


def chain(pairs):
    """Pairs in the order in which one is the next of the other."""
    return sorted(pairs, key=lambda p: (-(1 << 63) if p[0] is None else p[0], [-c for c in (p[1] or "").encode()]), reverse=True)


def edited(text, following):
    m = len(text) // 3
    return text[: len(text) - m] + following[:m]


def check(got, pairs):
    ordered = chain(pairs)
    want = []
    for i, (doc_id, text) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1] or ""
        text = text or ""
        other = edited(text, following)
        want.append((doc_id, len(text), hashlib.sha256(other.encode()).hexdigest(), brute(text), brute(other)))
    assert sorted([tuple(r)[:5] for r in got], key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("parts", [1, 2, 16, 100])
def test_odd_documents(spark, docs, odd_texts, parts):
    pairs = list(enumerate(odd_texts)) + [(None, "no id"), (3, "a tie"), (3, "a tie"), (12, "one two three"), (-7, "below")]
    got = minhash.fingerprints(docs(pairs, clash=True).repartition(3), parts)
    assert got.columns == [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    ]
    check(got.collect(), pairs)


@pytest.mark.parametrize("parts", [1, 8, 64])
def test_whole_chain(spark, docs, parts):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    pairs = [(i * 37 % 1009 - 300, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 60)))) for i in range(200)]
    check(minhash.fingerprints(docs(pairs).repartition(4), parts).collect(), pairs)


def test_likeness_is_close_to_jaccard(spark, docs):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(5000)]
    pairs = []
    for i in range(120):
        words = rng.choices(vocabulary, k=rng.choice([40, 150, 600, 3000]))
        pairs.append((2 * i, " ".join(words)))
        cut = int(len(words) * rng.random())
        pairs.append((2 * i + 1, " ".join(words[:cut] + rng.choices(vocabulary, k=len(words) - cut))))
    texts = dict(pairs)
    errors = []
    for row in minhash.fingerprints(docs(pairs)).collect():
        following = texts[row.doc_id - 1 if row.doc_id else max(texts)]
        errors.append(row.near_next - jaccard(texts[row.doc_id], following))
        errors.append(row.near_edited - jaccard(texts[row.doc_id], edited(texts[row.doc_id], following)))
        assert 0 <= row.near_next <= 1 and 0 <= row.near_edited <= 1
    assert abs(sum(errors) / len(errors)) < 0.01  # no bias
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.035
    assert max(map(abs, errors)) < 0.16


def test_equal_texts_and_texts_without_words(spark, docs):
    got = {r.doc_id: r for r in minhash.fingerprints(docs([(1, "a b"), (2, "a  b"), (3, ""), (4, None), (5, "\t ")])).collect()}
    assert got[1].fingerprint == got[2].fingerprint and got[2].near_next == 1.0
    assert got[5].fingerprint == "0" * 256 and got[4].near_next == 1.0 and got[5].near_next == 1.0


def test_empty_and_single(spark, docs):
    assert minhash.fingerprints(docs([])).count() == 0
    row = minhash.fingerprints(docs([(None, "abcdef ghi")])).first()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"abcdef abc").hexdigest()


def test_no_python_in_the_plan(spark, docs):
    plan = minhash.fingerprints(docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan.split("Subquery")[0]


def test_parts_are_cut_at_keys(spark):
    rows = spark.range(5000).selectExpr("id * id AS key", "CAST(id AS STRING) AS text")
    following = minhash.with_next(rows, "key", 64, after="key")
    got = {r.key: r.after for r in following.collect()}
    assert got == {i * i: (i - 1) ** 2 if i else 4999**2 for i in range(5000)}

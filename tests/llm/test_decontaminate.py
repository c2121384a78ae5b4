"""Greedy tiling against a plain search; documents with whole, reordered and partial items."""

import random

import numpy as np
from paddock.llm import decontaminate as dc

ITEMS = "item_id long, text string, TEXT string"


def brute(a, b, least):
    least, free_a, free_b, out = min(least, len(a)), [1] * len(a), [1] * len(b), []
    while True:
        best = None
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and free_a[i + k] and free_b[j + k]:
                    k += 1
                if k and k >= least and (best is None or k > best[2]):
                    best = (i, j, k)
        if best is None:
            return out
        out.append(best)
        for x in range(best[2]):
            free_a[best[0] + x] = free_b[best[1] + x] = 0


def test_tiles():
    chance = random.Random(2)
    for _ in range(600):
        a = [chance.randint(1, 4) for _ in range(chance.randint(0, 14))]
        b = [chance.randint(0, 4) for _ in range(chance.randint(0, 25))]
        assert dc.tile(np.array(a, np.uint64), np.array(b, np.uint64), 3) == brute(a, b, 3)


def test_tiles_one_by_one(monkeypatch):
    """The way of repeated words, in memory that grows with the words only, gives the same tiles."""
    monkeypatch.setattr(dc, "PAIRS", 0)
    chance = random.Random(3)
    for _ in range(400):
        a = [chance.randint(1, 3) for _ in range(chance.randint(1, 16))]
        b = [chance.randint(0, 3) for _ in range(chance.randint(0, 30))]
        assert dc.tile(np.array(a, np.uint64), np.array(b, np.uint64), 3) == brute(a, b, 3)


def test_a_million_equal_words():
    item, doc = np.full(500, 7, np.uint64), np.full(1_000_000, 7, np.uint64)
    assert dc.tile(item, doc, dc.SEED) == [(0, 0, 500)]
    doc[::11] = 3
    tiles = dc.tile(item, doc, dc.SEED)
    assert sum(n for _, _, n in tiles) == 500 and tiles[0] == (0, 1, 10)


def test_documents(spark, docs, odd_texts, monkeypatch):
    chance = random.Random(7)
    vocabulary = [f"w{i}" for i in range(80)]
    items = [(i, [chance.choice(vocabulary) for _ in range(chance.randint(1, 40))]) for i in range(25)]
    pairs = []
    for n in range(120):
        own = [chance.choice(vocabulary + ["zz"]) for _ in range(chance.randint(0, 60))]
        _, item = items[n % 25]
        kind = n % 4
        if kind == 1:
            own += item
        elif kind == 2:  # the halves change places
            own = item[len(item) // 2 :] + own + item[: len(item) // 2]
        elif kind == 3:
            own += item[: len(item) // 2]
        pairs.append((n, " ".join(own).title() + "."))
    pairs += [(200 + i, t) for i, t in enumerate(odd_texts)] + [(None, pairs[1][1]), (1, pairs[1][1])]
    bench = [(i, ", ".join(t), "x") for i, t in items] + [(90, None, ""), (91, " ", "")]
    want = set()
    for doc_id, text in pairs:
        words = dc.words(text)
        for item_id, item in items:
            if len(words) < 5000:
                tiles = brute(item, words, 5)
                share = sum(n for _, _, n in tiles) / len(item)
                if share >= dc.COVERAGE:
                    want.add((doc_id, item_id, share, len(tiles), max(n for _, _, n in tiles)))
    assert any(r[3] > 1 for r in want)
    table = spark.createDataFrame(bench, ITEMS)
    for bits, together in ((dc.FILTER_BITS, dc.TOGETHER), (64, 50)):
        monkeypatch.setattr(dc, "FILTER_BITS", bits)
        monkeypatch.setattr(dc, "TOGETHER", together)
        got = [tuple(r) for r in dc.matches(docs(pairs, clash=True), table).collect()]
        assert set(got) == want and len(got) == len(want) + sum(r[0] == 1 for r in want)
        kept = dc.clean(docs(pairs), table)
        bad = {r[0] for r in want}
        assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((i for i, _ in pairs if i not in bad), key=repr)


def test_words_and_seeds_in_arrays():
    """Word borders as the expression finds them; equal runs of words, and only these, have equal seeds."""
    chance = random.Random(5)
    parts = ["one", "Two", "É", "ß", "_x", "9", "日本", " ", "  ", "\n", ".", "-", "\u0301", "🙂", "Σας", "İ"]
    texts = ["".join(chance.choices(parts, k=chance.randrange(60))) for _ in range(300)] + [None, "", " "]
    hashes, owner = dc._word_hashes(texts)
    assert np.bincount(owner, minlength=len(texts)).tolist() == [len(dc.words(t)) for t in texts]
    by_word = {}
    for word, h in zip((w for t in texts for w in dc.words(t)), hashes.tolist()):
        assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)
    for n in (1, 3, 5):
        found, place = dc.seeds(texts, [n])
        runs = [tuple(dc.words(t)[i : i + n]) for t in texts for i in range(len(dc.words(t)) - n + 1)]
        assert len(runs) == len(found) and len(set(zip(runs, found.tolist()))) == len(set(runs)) == len(set(found.tolist()))


def test_a_passage_of_many_documents_is_dealt_to_many_tasks(spark, docs):
    item = "a passage that a third of all documents share with the benchmark"
    pairs = [(i, f"{item} {i}" if i % 3 == 0 else f"text {i} of its own words") for i in range(600)]
    table = spark.createDataFrame([(1, item, "")], ITEMS)
    got = dc.matches(docs(pairs), table)
    assert sorted(r.doc_id for r in got.collect()) == list(range(0, 600, 3))
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "salt" in plan
    assert dc.clean(docs(pairs), table).count() == 400


def test_empty(spark, docs):
    empty = spark.createDataFrame([], ITEMS)
    assert dc.matches(docs([(1, "a b c d e")]), empty).count() == 0
    assert dc.clean(docs([(1, "a b c d e")], clash=True), empty).count() == 1
    assert dc.matches(docs([]), spark.createDataFrame([(1, "a b c d e", "")], ITEMS)).count() == 0
    assert dc.clean(docs([]), spark.createDataFrame([(1, "a b c d e", "")], ITEMS)).count() == 0

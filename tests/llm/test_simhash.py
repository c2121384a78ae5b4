"""Fingerprints and groups against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from paddock.llm import components, simhash


def plain_print(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints, distance):
    values = sorted(set(prints))
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= distance:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {v: values[root(i)] for i, v in enumerate(values)}


def test_fingerprints():
    chance = random.Random(1)
    for _ in range(2000):
        text = "".join(chance.choice(["A", "b", "É", "c", " ", " ", "\t", "\x1c", "\x0b", "\xa0", "\n"]) for _ in range(chance.randint(0, 30)))
        assert simhash.fingerprint(text) == plain_print(text)
    long = " ".join(chance.choice("abcdefg") for _ in range(40_000))
    assert simhash.fingerprint(long) == plain_print(long)


def test_manhattan_is_a_lower_bound():
    chance = random.Random(2)
    for _ in range(1000):
        a, b = chance.getrandbits(64), chance.getrandbits(64)
        want = sum(abs((a >> 2 * i & 3).bit_count() - (b >> 2 * i & 3).bit_count()) for i in range(32))
        got = simhash.manhattan(*(simhash.popcounts(np.array([x], np.uint64)) for x in (a, b)))[0]
        assert got == want <= (a ^ b).bit_count()


def _near(chance, n, far):
    """Values around a few centres, up to ``far`` bits off."""
    centres = [chance.getrandbits(64) for _ in range(4)]
    out = []
    for _ in range(n):
        value = chance.choice(centres)
        for _ in range(chance.randint(0, far)):
            value ^= 1 << chance.randrange(64)
        out.append(value)
    return out


@pytest.mark.parametrize("cell", [16, 2048])
def test_links_in_a_cell(monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    values = np.unique(np.array(_near(random.Random(3), 500, 8), np.uint64))
    links = simhash.links_within(values, 3)
    assert len(links) < len(values)
    roots = plain_roots(values.tolist(), 3)
    assert len(links) == len(values) - len(set(roots.values()))
    assert all(roots[int(values[i])] == roots[int(values[j])] for i, j in links)


def test_groups(spark, monkeypatch):
    values = _near(random.Random(4), 600, 7)
    signed = [simhash._signed(v) for v in sorted(set(values))]
    frame = spark.createDataFrame([(v,) for v in signed], "print long")
    found = components.smallest_reachable(simhash.links(frame)).collect()
    got = {r.node % (1 << 64): r.root % (1 << 64) for r in found}
    want = plain_roots(values, 3)
    groups = {}
    for v in want:
        groups.setdefault(want[v], set()).add(v)
    groups_got = {}
    for v in want:
        groups_got.setdefault(got.get(v, v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, groups_got.values()))


def test_components(spark):
    chance = random.Random(5)
    links = [(chance.randint(0, 300), chance.randint(0, 300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(40)]
    links += [(900, i) for i in range(800, 880)] + [(5, 5)]
    root = {v: v for link in links for v in link}
    for _ in range(400):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    linked = {v for a, b in links if a != b for v in (a, b)}
    got = components.smallest_reachable(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == {v: root[v] for v in linked}
    assert components.smallest_reachable(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(spark, docs, odd_texts):
    chance = random.Random(6)
    base = [" ".join(chance.choice("abcdefghijkl") + str(chance.randint(0, 9)) for _ in range(300)) for _ in range(15)]
    pairs = []
    for n in range(90):
        words = chance.choice(base).split()
        words[chance.randrange(300)] = "new"
        pairs.append((1000 - n, " ".join(words)))
    pairs += [(i, t) for i, t in enumerate(odd_texts)] + [(3, base[0]), (3, base[0]), (None, base[1]), (None, "only here")]
    prints = [plain_print(t) for _, t in pairs]
    roots = plain_roots(prints, 3)
    first = {}
    for (doc_id, _), p in zip(pairs, prints):
        ids = first.setdefault(roots[p], [])
        if doc_id is not None:
            ids.append(doc_id)
    want = [(i, f"{p:016x}", min(first[roots[p]], default=None)) for (i, _), p in zip(pairs, prints)]
    got = [tuple(r) for r in simhash.near_duplicates(docs(pairs, clash=True)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = simhash.one_of_each(docs(pairs, clash=True).repartition(3))
    assert kept.columns == ["doc_id", "text", "TEXT", "spans", "score"]
    rows = kept.collect()
    assert sorted((r[0] for r in rows), key=repr) == sorted((min(x, default=None) for x in first.values()), key=repr)
    assert simhash.near_duplicates(docs([])).count() == simhash.one_of_each(docs([])).count() == 0


def test_ties_of_the_smallest_id_go_to_the_least_text(spark, docs):
    same = "one two three four five six seven eight nine ten"
    pairs = [(1, f"{same}  "), (1, same), (1, f"{same} "), (2, same), (None, None), (None, " "), (9, "other words stand here")]
    for order in (pairs, pairs[::-1]):
        kept = simhash.one_of_each(docs(order, clash=True).repartition(3))
        assert kept.columns == ["doc_id", "text", "TEXT", "spans", "score"]
        assert sorted([tuple(r)[:2] for r in kept.collect()], key=repr) == sorted(
            [(1, same), (9, "other words stand here"), (None, None)], key=repr
        )
    assert simhash.one_of_each(docs([], clash=True)).count() == 0

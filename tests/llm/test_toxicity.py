"""Held-out accuracy, rows that may not be learnt from, and odd input."""

import math
import random
import re
import zlib

import pytest
from paddock.llm import toxicity
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

LABELS = "doc_id long, quality int, toxic int"


def _corpus(n, seed):
    chance = random.Random(seed)
    plain = ["the", "house", "river", "green", "walk", "morning", "paper", "you", "light", "stone", "bread"]
    bad = ["grumblefish", "snotwagon", "dungbeetle"]
    docs, labels = [], []
    for i in range(n):
        toxic = int(chance.random() < 0.25)
        words = [chance.choice(plain) + chance.choice(["", "s", "ed"]) for _ in range(chance.randint(20, 60))]
        for _ in range(3 * toxic):
            words[chance.randrange(len(words))] = chance.choice(bad) + chance.choice(["", "s", "!"])
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return docs, labels


def test_held_out_accuracy_and_cases(spark, docs, odd_texts):
    pairs, labels = _corpus(500, 1)
    odd = [(10_000 + i, t) for i, t in enumerate(odd_texts)] + [(None, "you"), (3, pairs[3][1])]
    # a null id or label, a repeated label and a foreign id teach nothing
    table = spark.createDataFrame([*labels, (None, 1, 1), (4, 1, None), (5, 1, labels[5][2]), (77_777, 0, 1)], LABELS)
    got = toxicity.score(docs(pairs + odd, clash=True), table, rounds=4).collect()
    assert len(got) == len(pairs) + len(odd)
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    kept = toxicity.reject(docs(pairs + odd, clash=True), table, rounds=4).cache()
    assert kept.columns == ["doc_id", "text", "TEXT", "spans", "score"]
    assert kept.count() == sum(r.score < 0.3 for r in got)


def test_held_out_labels_are_never_read(spark, docs):
    pairs, labels = _corpus(200, 2)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    scores = [
        sorted((r.doc_id, r.score) for r in toxicity.score(docs(pairs), spark.createDataFrame(x, LABELS), rounds=2).collect())
        for x in (labels, turned)
    ]
    assert scores[0] == scores[1]


def test_without_labels(spark, docs):
    empty = spark.createDataFrame([], LABELS)
    assert [tuple(r) for r in toxicity.score(docs([(1, "a")]), empty).collect()] == [(1, False, 0.0, 0)]
    assert toxicity.score(docs([]), empty).count() == 0
    assert toxicity.reject(docs([(1, "a")]), empty).count() == 1
    # not even one row of each label for trees and calibration
    few = spark.createDataFrame([(i, 1, int(i == 3)) for i in range(8)], LABELS)
    assert {r.score for r in toxicity.score(docs([(i, f"text {i}") for i in range(8)]), few).collect()} <= {0.0, 1 / 6, 1 / 5, 1 / 7}
    assert toxicity.reject(docs([], clash=True), few).count() == 0


def plain_features(text, lexicon):
    """The features in the plainest words, one loop for each."""
    text = text or ""
    words = re.findall(r"[^\W_]+", text.lower())
    hit = lambda w: w in lexicon or any(w[:k] + "*" in lexicon for k in (4, 5, 6) if len(w) > k)
    bad = [i for i, w in enumerate(words) if hit(w)]
    second = [i for i, w in enumerate(words) if w in toxicity.SECOND_PERSON]
    near = sum(any(abs(i - j) <= 6 for j in second) for i in bad)
    densest = max((sum(i <= j < i + 50 for j in bad) for i in bad), default=0)
    ascii_share = lambda test: sum(test(c) for c in text if ord(c) < 128) / max(1, len(text.encode()))
    marks = "\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    hidden = [m[0] for m in toxicity._OBFUSCATED.finditer(text)]
    plain = [re.sub(r"[^\w@$!]|_", "", h.lower()).translate(toxicity.LEET) for h in hidden]
    n = max(1, len(words))
    return (
        len(bad) / n, math.log1p(len(bad)), math.log1p(len({words[i] for i in bad})), densest, near / n, len(second) / n,
        ascii_share(str.isupper), ascii_share(lambda c: c in marks), ascii_share(lambda c: c == "!"),
        ascii_share(str.isdigit), len(hidden) / n, math.log1p(sum(map(hit, plain))), math.log1p(len(words)),
    )


def test_features_against_plain_loops(odd_texts):
    chance = random.Random(3)
    parts = ["you", "Du", "grumble", "grumblefish", "fish", "gr4mble", "g r u m b l e", "OK!", "9", "é", "...", "snot_wagon", "@home", "tu"]
    lexicon = {"grumble": 3.0, "grumblefish": 3.0, "snot*": 3.0, "grumb*": 2.6}
    texts = [" ".join(chance.choices(parts, k=chance.randrange(90))) for _ in range(200)] + [t for t in odd_texts if not t or len(t) < 1000]
    read = toxicity.Reader(lexicon).features
    for text in texts:
        assert read(text) == pytest.approx(plain_features(text, lexicon)), text


def pool_adjacent(points):
    """Isotonic fit of (margin, weight, label) rows, by merging neighbours that fall."""
    blocks = []
    for x in sorted({p[0] for p in points}):
        rows = [p for p in points if p[0] == x]
        weight = sum(w for _, w, _ in rows)
        blocks.append([[x], weight, sum(w * y for _, w, y in rows) / weight])
        while len(blocks) > 1 and blocks[-2][2] > blocks[-1][2]:
            xs, w, y = blocks.pop()
            left = blocks[-1]
            left[2] = (left[1] * left[2] + w * y) / (left[1] + w)
            left[0], left[1] = left[0] + xs, left[1] + w
    return {x: y for xs, _, y in blocks for x in xs}


def test_calibration_against_plain_pooling(spark):
    chance = random.Random(4)
    points = [(chance.randrange(12) / 4, chance.choice([1.0, 2.5]), float(chance.random() < 0.4)) for _ in range(300)]
    frame = spark.createDataFrame(points, "margin double, weight double, toxic double").repartition(4)
    pooled = toxicity._pooled(frame)
    assert pooled.count() == len({p[0] for p in points})
    fitted = IsotonicRegression(labelCol="toxic", featuresCol="margin", weightCol="weight", predictionCol="score").fit(pooled)
    got = {r.margin: r.score for r in fitted.transform(frame.select("margin").distinct()).collect()}
    want = pool_adjacent(points)
    assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x]) for x in want)


def test_rare_labels_are_sampled_by_label(spark, docs):
    """Of very many labelled rows few are toxic: they are all there, and weights keep the shares."""
    labels = spark.range(40_000).selectExpr("id AS doc_id", "1 AS quality", "CAST(id % 2000 = 0 AS INT) AS toxic")
    texts = spark.range(40_000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    sample = toxicity._sample(texts, labels, 500)
    found = {(r.toxic, r.part): (r.n, r.w) for r in sample.groupBy("toxic", "part").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    usable = toxicity._labelled(labels)
    there = {r.toxic: r["count"] for r in usable.groupBy("toxic").count().collect()}
    assert sum(n for (t, _), (n, _) in found.items() if t) == there[1.0] < 20
    assert {p for t, p in found if t} == {0, 1, 2}
    plain = sum(n for (t, _), (n, _) in found.items() if not t)
    assert 350 < plain < 650
    assert sum(w for (t, _), (_, w) in found.items() if not t) == pytest.approx(there[0.0], rel=0.2)

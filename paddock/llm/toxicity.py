"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is induced from labelled rows: words and word beginnings that occur
in far more toxic than other documents. A document becomes a few numbers:
densities of lexicon words, how near they stand to second-person words, shares
of capitals and punctuation, rates of obfuscated words. Trees score these, an
isotonic regression turns the margin into a probability. The lexicon, the trees
and the calibration are fitted on three separate parts of a sample of labelled
rows, bounded for each label; every document is scored over its whole text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from paddock.llm.common import arrow_extend, arrow_map, numbered, pick

#: Rows of each label in the sample at most (in expectation: rows are taken by a hash of their id). Rows of a
#: label with more weigh the more, so the shares of the labels stay as they are.
TRAINING_ROWS = 10_000
#: What an entry of the lexicon needs: toxic documents, at least this many and this share of all, and log-odds.
LEAST_DOCUMENTS = 3
LEAST_SHARE = 0.0005
LEAST_LOG_ODDS = 2.5
#: Parts of the sample by place in it: 0 lexicon, 1 trees, 2 calibration; the first three rows of a label are spread.
PARTS = (2, 0, 1, 0, 1, 0, 2, 0, 1, 0)
THRESHOLD = 0.3
#: Trees that are boosted.
ROUNDS = 15
STEMS = (4, 5, 6)

# Words that address the reader, by language.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous votre vos "
    "ti tus usted ustedes vosotros os".split()
)
# Characters that stand for letters.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})

FEATURES = (
    "lexicon_rate", "lexicon_hits", "lexicon_kinds", "lexicon_densest", "near_second_person", "second_person_rate",
    "capital_rate", "punctuation_rate", "exclamation_rate", "digit_rate", "obfuscated_rate", "obfuscated_hits", "log_words",
)

_WORD = re.compile(r"[^\W_]+")
_OBFUSCATED = re.compile(r"(?<![A-Za-z])[A-Za-z]++(?:[0-9@$*!]++[A-Za-z]++)+|(?<!\w)[A-Za-z](?:[ .*_-][A-Za-z]){3,}(?!\w)")
_NOT_WORD = re.compile(r"[^\w@$!]|_")
_BYTE_KIND = np.zeros(256, np.int64)
_BYTE_KIND[65:91] = 1
_BYTE_KIND[48:58] = 2
_BYTE_KIND[[33]] = 3
_BYTE_KIND[[*range(34, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 4
_NEAR = 6


def entries(word: str) -> list[str]:
    """A word and its beginnings, as the lexicon has them (beginnings end with ``*``)."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


class Reader:
    """Features of texts, given a lexicon."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.known: dict[str, bool] = {}

    def hit(self, word: str) -> bool:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > 200_000:  # bounds memory only
                self.known.clear()
            found = self.known[word] = any(e in self.lexicon for e in entries(word))
        return found

    def features(self, text: str | None) -> tuple[float, ...]:
        text = text or ""
        words = _WORD.findall(text.lower())
        n = max(1, len(words))
        distinct = set(words)
        bad = {w for w in distinct if self.hit(w)}
        places = [i for i, w in enumerate(words) if w in bad] if bad else []
        second = [i for i, w in enumerate(words) if w in SECOND_PERSON] if SECOND_PERSON & distinct else []
        near = 0
        if places and second:
            near = int((np.abs(np.array(places) - _nearest(places, second)) <= _NEAR).sum())
        data = np.frombuffer(text.encode(), np.uint8)
        _, capitals, digits, shouts, marks = np.bincount(_BYTE_KIND[data], minlength=5)[:5].tolist() if len(data) else [0] * 5
        size = max(1, len(data))
        hidden = hits = 0
        for match in _OBFUSCATED.finditer(text):
            hidden += 1
            plain = _NOT_WORD.sub("", match[0].lower()).translate(LEET)
            hits += self.hit(plain)
        clusters = _densest(places, 50)
        return (
            len(places) / n, math.log1p(len(places)), math.log1p(len(bad)), float(clusters), near / n, len(second) / n,
            capitals / size, marks / size, shouts / size, digits / size, hidden / n, math.log1p(hits), math.log1p(len(words)),
        )


def _nearest(places: list[int], others: list[int]) -> np.ndarray:
    """For each place the nearest of the others (both ascending)."""
    others_ = np.array(others)
    at = np.searchsorted(others_, places)
    left, right = others_[np.maximum(at - 1, 0)], others_[np.minimum(at, len(others_) - 1)]
    own = np.array(places)
    return np.where(np.abs(own - left) <= np.abs(own - right), left, right)


def _densest(places: list[int], width: int) -> int:
    """Most places within a run of this many words."""
    best = low = 0
    for high, place in enumerate(places):
        while place - places[low] >= width:
            low += 1
        best = max(best, high - low + 1)
    return best


def held_out() -> Column:
    """Whether a row's label may not be learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def _labelled(labels: DataFrame) -> DataFrame:
    """doc_id and toxic (0.0 or 1.0) that may be learnt from; repeated labels count once, null ids and labels not at all."""
    usable = pick(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out())
    return usable.groupBy("doc_id").agg(F.max("toxic").cast("double").alias("toxic"))


def _sample(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """Rows to fit on (doc_id, text, toxic, weight, part), at most about ``bound`` of each label.

    Repeated documents count once. Which rows are taken, and for what, depends on their ids only.
    """
    usable = _labelled(labels)
    there = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    share = {label: min(1.0, bound / n) for label, n in there.items()}
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000))
    of_label = lambda value: F.when(F.col("toxic") == 1, value(share.get(1.0, 1.0))).otherwise(value(share.get(0.0, 1.0)))
    chosen = place < of_label(lambda x: F.lit(int(1_000_000 * x)))
    # at most about ``bound`` ids of each label: three numbers each
    chosen_ids = usable.where(chosen).orderBy(F.xxhash64("doc_id", F.lit("part")), "doc_id").collect()
    seen = {0.0: 0, 1.0: 0}
    rows = []
    for doc_id, toxic in chosen_ids:
        rows.append((doc_id, toxic, 1.0 / share[toxic], PARTS[seen[toxic] % len(PARTS)]))
        seen[toxic] += 1
    taken = docs.sparkSession.createDataFrame(rows, "doc_id long, toxic double, weight double, part int")
    joined = pick(docs, "doc_id", "text").join(F.broadcast(taken), "doc_id")
    return joined.groupBy("doc_id", "toxic", "weight", "part").agg(F.min("text").alias("text"))


def induce(sample: DataFrame) -> dict[str, float]:
    """Lexicon entries and their smoothed log-odds, from rows of text and toxic."""

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        for text, toxic in tuples:
            for entry in {e for w in set(_WORD.findall((text or "").lower())) for e in entries(w)}:
                yield entry, toxic

    found = arrow_map(sample.select("text", "toxic"), "entry string, toxic double", rows)
    totals = sample.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    toxic, other = (float(t or 0) for t in totals)
    counted = found.groupBy("entry").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    odds = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (other + 1))
    # a share of the toxic documents: however many rows there are, there are about as many entries
    best = counted.where(F.col("a") >= max(LEAST_DOCUMENTS, LEAST_SHARE * toxic)).select("entry", odds.alias("odds"))
    return {r.entry: r.odds for r in best.where(F.col("odds") >= LEAST_LOG_ODDS).collect()}


def _featured(df: DataFrame, text: str, lexicon: dict[str, float], keep: list[str]) -> DataFrame:
    """The columns to keep and the features of the text column."""
    shared = df.sparkSession.sparkContext.broadcast(lexicon)

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        read = Reader(shared.value).features
        for (whole,) in tuples:
            yield read(whole)

    return arrow_extend(df, [text], ", ".join(f"{f} double" for f in FEATURES), rows, keep)


class Model:
    """Lexicon, trees and calibration; without trees a constant."""

    def __init__(self, lexicon, trees, calibration, share: float):
        self.lexicon, self.trees, self.calibration, self.share = lexicon, trees, calibration, share

    def score(self, docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
        """The columns to keep and the score of every row; no kept column may be named like a feature."""
        if self.trees is None:
            return docs.select(*keep, F.lit(self.share).alias("score"))
        scored = self.calibration.transform(_margin(self.trees, _featured(docs, text, self.lexicon, keep)))
        return scored.select(*keep, F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))


def _margin(trees, featured: DataFrame) -> DataFrame:
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(featured)
    return trees.transform(vectors).withColumn("margin", vector_to_array("rawPrediction")[1])


def fit(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_ROWS, rounds: int = ROUNDS) -> Model:
    """Fit on a sample of at most about ``bound`` rows of each label that are not held out.

    Trees and calibration need a row of each label; without them every score is the share of toxic rows.
    """
    sample = _sample(docs, labels, bound).checkpoint()
    counts = {(r.part, r.toxic): (r.n, r.weight) for r in sample.groupBy("part", "toxic").agg(
        F.count("*").alias("n"), F.sum("weight").alias("weight")).collect()}
    toxic = sum(weight for (_, t), (_, weight) in counts.items() if t)
    share = toxic / (sum(weight for _, weight in counts.values()) or 1)
    if any((part, t) not in counts for part in (1, 2) for t in (0.0, 1.0)):
        return Model({}, None, None, share)
    lexicon = induce(sample.where("part = 0").dropDuplicates(["text"]))
    featured = _featured(sample, "text", lexicon, ["toxic", "weight", "part"]).checkpoint()
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(featured)
    trees = GBTClassifier(
        labelCol="toxic", weightCol="weight", maxIter=rounds, maxDepth=4, stepSize=0.3, seed=7, minInstancesPerNode=5,
        maxMemoryInMB=64,
    ).fit(vectors.where("part = 1").coalesce(4))
    calibration = IsotonicRegression(
        labelCol="toxic", featuresCol="margin", weightCol="weight", predictionCol="score"
    ).fit(_pooled(_margin(trees, featured.where("part = 2"))))
    return Model(lexicon, trees, calibration, share)


def _pooled(margins: DataFrame) -> DataFrame:
    """One row for each margin: weight and mean label of its rows. Trees give few margins, and many rows may share one."""
    weight = F.sum("weight")
    return margins.groupBy("margin").agg(
        (F.sum(F.col("toxic") * F.col("weight")) / weight).alias("toxic"), weight.alias("weight")
    )


def score(
    docs: DataFrame, labels: DataFrame, bound: int = TRAINING_ROWS, threshold: float = THRESHOLD, rounds: int = ROUNDS
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Labels, language, source and id are no inputs of a score. Null and empty
    texts are scored like a text without words; repeated rows get equal scores;
    a null id is not held out; an empty table gives an empty one; without enough
    labels every score is the share of toxic rows. Other columns are not read.
    """
    model = fit(docs, labels, bound, rounds)
    scored = model.score(pick(docs, "doc_id", "text"), "text", ["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """The rows that score below the threshold, all columns kept.

    Null and empty texts are scored like a text without words, repeated rows
    alike; an empty table stays empty; without enough labels all rows stay unless
    the share of toxic labels reaches the threshold. Only ``text`` of the columns
    is scored; ``doc_id`` finds the labelled rows.
    """
    model = fit(docs, labels, rounds=rounds)
    names = docs.columns
    plain = numbered(docs)
    scored = model.score(plain, f"_{names.index('text')}", plain.columns)
    return scored.where(F.col("score") < threshold).drop("score").toDF(*names)

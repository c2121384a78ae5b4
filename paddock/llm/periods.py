"""Runs of repeated words, found by internal pattern matching.

A run of period q that is four times as long as q holds, wherever it lies, one
of the half-overlapping dyadic blocks with q <= length < 2q (or length 4 for
small q) so early that the block occurs again q words later. A block as long as
the period cannot occur sooner inside the run, so the distance to its next
occurrence is the period. Occurrences of a block in the window of its own
length form one progression that begins at the block; its difference, from the
first member that follows, is the candidate period.

Occurrences are asked of a suffix array: the suffixes that begin with a block
are one interval of it, and the smallest position above that of the block in
the interval is a range successor, answered by a wavelet tree over the array.
Suffix array, tree and queries work on the words of many documents at a time,
numbered per document, so that no block is found in another document.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from paddock.llm.common import arrow_map, pick

#: Length of the smallest dyadic block; it serves all periods up to its length.
FIRST = 4
#: Words worked on together; a longer document is worked on alone.
WORDS = 1 << 17
#: What words stand between.
SPACES = r"[\x20\x09-\x0D]+"
#: A run is at least so many words and so many periods long.
LEAST_WORDS, LEAST_PERIODS = 6, 4


class WaveletTree:
    """Counts and order statistics of the values in any interval of a sequence, one bit of the values per level."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.n, self.bits = len(values), bits
        self.zeros: list[np.ndarray] = []  # zeros before each place, by level
        for bit in range(bits - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~ones)]))
            values = np.concatenate([values[~ones], values[ones]])

    def below(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many values in [low, high) are smaller than ``value``."""
        low, high, count = low.copy(), high.copy(), np.zeros(len(low), np.int64)
        for level, zeros in enumerate(self.zeros):
            one = (value >> (self.bits - 1 - level) & 1).astype(bool)
            left, right = zeros[low], zeros[high]
            count += np.where(one, right - left, 0)
            low = np.where(one, zeros[-1] + low - left, left)
            high = np.where(one, zeros[-1] + high - right, right)
        return count

    def smallest(self, low: np.ndarray, high: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The value that ``nth`` (from 0) others in [low, high) stand before, in their order."""
        low, high, nth, value = low.copy(), high.copy(), nth.copy(), np.zeros(len(low), np.int64)
        for level, zeros in enumerate(self.zeros):
            left, right = zeros[low], zeros[high]
            one = nth >= right - left
            nth -= np.where(one, right - left, 0)
            value |= one.astype(np.int64) << (self.bits - 1 - level)
            low = np.where(one, zeros[-1] + low - left, left)
            high = np.where(one, zeros[-1] + high - right, right)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Smallest value above ``value`` in [low, high), -1 where there is none."""
        upto = self.below(low, high, value + 1)
        found = np.full(len(low), -1, np.int64)
        has = upto < high - low
        found[has] = self.smallest(low[has], high[has], upto[has])
        return found


class SuffixArray:
    """Suffixes of a sequence in the order of their first words, by prefix doubling.

    Only suffixes that share their beginning with another are sorted again, and
    only up to the longest block asked for. ``blocks`` has, by length 4, 8, ...,
    the positions whose block of that length occurs more than once, and the
    interval of the array that these occurrences are; ``places`` are the places
    of the array in any such interval.
    """

    def __init__(self, names: np.ndarray, longest: int) -> None:
        n = len(names)
        self.blocks: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        self.order = np.argsort(names, kind="stable")
        self.rank = np.empty(n, np.int64)
        self.places = np.zeros(0, np.int64)
        self._settle(names[self.order], np.arange(n))
        length, shared = 1, self._shared(np.arange(n))
        while len(shared) and 2 * length <= max(longest, FIRST):
            starts = self.order[shared]
            after = starts + length
            # the end of the sequence comes before every word
            key = self.rank[starts] * (n + 1) + np.where(after < n, self.rank[np.minimum(after, n - 1)] + 1, 0)
            by_key = np.argsort(key, kind="stable")
            self.order[shared] = starts[by_key]
            self._settle(key[by_key], shared)
            length, shared = 2 * length, self._shared(shared)
            if length == FIRST:
                self.places = shared
            if length >= FIRST and len(shared):
                low = self.rank[self.order[shared]]
                size = np.diff(np.flatnonzero(np.diff(low, prepend=-1)), append=len(low))
                self.blocks.append((length, self.order[shared], low, low + np.repeat(size, size)))

    def _settle(self, keys: np.ndarray, places: np.ndarray) -> None:
        """Rank of the suffixes at these places of the array: the first place with an equal key."""
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        self.rank[self.order[places]] = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]

    def _shared(self, places: np.ndarray) -> np.ndarray:
        """Those of the places whose suffix has the rank of a neighbour."""
        ranks = self.rank[self.order[places]]
        same = np.zeros(len(places) + 1, bool)
        same[1:-1] = ranks[1:] == ranks[:-1]
        return places[same[1:] | same[:-1]]


def candidates(names: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of blocks, and the candidate period of each, by period and start."""
    array = SuffixArray(names, longest)
    # suffixes that share no block are never asked for
    tree = WaveletTree(array.order[array.places], len(names).bit_length())
    found = [np.zeros((3, 0), np.int64)]
    for length, starts, low, high in array.blocks:
        chosen = starts % (length // 2) == 0
        at, first = starts[chosen], np.searchsorted(array.places, low[chosen])
        after = tree.successor(first, first + (high - low)[chosen], at)
        near = (after > at) & (after - at <= length)
        found.append(np.stack([at, np.full(len(at), length), after - at])[:, near])
    at, size, period = np.concatenate(found, axis=1)
    order = np.lexsort((at, period))
    return at[order], size[order], period[order]


def _equal(names: np.ndarray, at: int, other: int) -> int:
    """How many words from ``at`` equal those from ``other``, which lies behind it."""
    total, step, n = 0, 16, len(names)
    while other < n:
        m = min(step, n - other)
        differ = names[at : at + m] != names[other : other + m]
        if differ.any():
            return total + int(differ.argmax())
        total, at, other, step = total + m, at + m, other + m, 2 * step
    return total


def maximal_runs(names: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """Start, length and period of the runs of a sequence: candidates, extended as far as their period holds."""
    back = names[::-1]
    n, found = len(names), []
    start = end = last = 0
    for at, size, period in zip(*[c.tolist() for c in candidates(names, longest)]):
        if period == last and at >= start and at + size + period <= end:
            continue  # inside the stretch seen before
        last = period
        start = at - _equal(back, n - at - period, n - at)
        end = at + size + period + _equal(names, at + size, at + size + period)
        if end - start >= max(LEAST_WORDS, LEAST_PERIODS * period):
            found.append((start, end - start, period))
    return found


def words_of(text: str | None) -> list[bytes]:
    """Words between space and the control characters tab to carriage return, in UTF-8."""
    return (text or "").encode().split()  # bytes split at just these


def _runs_of(group: list[list[bytes]]) -> Iterator[list[tuple[int, int, int]]]:
    """Runs of each document of a group, by start and period."""
    numbers = {word: i for i, word in enumerate(set().union(*group))}
    width = len(numbers) + 1
    lengths = np.array([len(words) + 1 for words in group])
    names = np.empty(int(lengths.sum()), np.int64)
    at = 0
    for i, words in enumerate(group):
        # the name that closes a document occurs once
        names[at : at + len(words) + 1] = [*map(numbers.__getitem__, words), width - 1]
        names[at : at + len(words) + 1] += i * width
        at += len(words) + 1
    begins = np.cumsum(lengths) - lengths
    by_document: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for start, length, period in maximal_runs(names, int(lengths.max(initial=1) - 1) // 2):
        i = int(np.searchsorted(begins, start, side="right")) - 1
        by_document[i].append((start - int(begins[i]), length, period))
    for i in range(len(group)):
        yield sorted(by_document[i], key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds behind its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def find(docs: DataFrame) -> DataFrame:
    """doc_id, runs (array of start, length, period, by start and period) and the collapsed text of each row.

    Null and empty texts have no runs and an empty collapsed text; words are
    joined by one space. Rows are worked on where they are: repeated rows stay,
    an empty table gives an empty one, other columns are not looked at. Memory
    grows with the longest text.
    """

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        def done() -> Iterator[tuple]:
            for doc_id, words, runs in zip(ids, group, _runs_of(group)):
                yield doc_id, runs, b" ".join(collapsed(words, runs)).decode()

        ids: list[int | None] = []
        group: list[list[bytes]] = []
        weight = 0
        for doc_id, text in tuples:
            words = words_of(text)
            if group and weight + len(words) > WORDS:
                yield from done()
                ids, group, weight = [], [], 0
            ids.append(doc_id)
            group.append(words)
            weight += len(words)
        if group:
            yield from done()

    schema = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return arrow_map(pick(docs, "doc_id", "text"), schema, rows)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents repeats a part of itself to its end.

    With h the CRC-32 of the decimal doc_id and g = h // 10, documents with h
    divisible by 10 have each word i >= a replaced by word a + (i - a) % p,
    a = g % n, p = 1 + (n - a) // (3 + g % 8). Rows with a null doc_id stay as
    they are.
    """
    words = F.filter(F.split("text", SPACES), lambda word: word != "")
    rows = pick(docs, "doc_id", "text").withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    rows = rows.withColumns({"n": F.size("words"), "g": F.floor(F.col("h") / 10)})
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    unit = F.slice("words", (F.col("a") + 1).cast("int"), F.col("p"))
    repeated = F.flatten(F.array_repeat(unit, F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    whole = F.slice(F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), repeated), F.lit(1), F.col("n"))
    return rows.select("doc_id", F.coalesce(F.array_join(whole, " "), "text").alias("text"))


def summary(found: DataFrame) -> DataFrame:
    """Per row of ``find``: number of runs, the longest one, and digests of the runs and of the collapsed text.

    Of equally long runs the first counts, then the one of the smallest period;
    without runs start, length, period and exponent_milli are null.
    """
    longest = F.array_min(
        F.transform("runs", lambda run: F.struct(-run["length"], run["start"], run["period"], run["length"]))
    )
    lines = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best")["start"].alias("start"),
        F.col("best")["length"].alias("length"),
        F.col("best")["period"].alias("period"),
        F.floor(1000 * F.col("best")["length"] / F.col("best")["period"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

"""Benchmark decontamination by greedy string tiling.

Runs of SEED words are the seeds. Seeds of the benchmark are a table; a document
is asked for its own seeds, those that a bit array of fixed size cannot rule out
are joined with the table, and what meets is a candidate pair. A pair is tiled in
a task: the longest match that covers no marked word is found with running
Karp-Rabin hashes and marked, again and again, until none of SEED words is left.
Tiles may stand in any order, so reordered passages count in full. A document is
contaminated by an item if the tiles cover at least COVERAGE of the item's words.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from paddock.llm.common import arrow_extend, arrow_map, numbered, pick
from paddock.session import scratch_path

#: Words of a seed, which is also the shortest tile; items with fewer words are sought as a whole.
SEED = 5
#: Share of an item's words that tiles must cover.
COVERAGE = 0.8
#: Bits that rule out most seeds of documents before the join: two megabytes, whatever the size of the benchmark.
FILTER_BITS = 1 << 24
#: Characters of documents whose seeds are computed together.
TOGETHER = 1 << 20
#: Parts that the rows of one seed are dealt into.
SALTS = 16
#: Pairs of equal seeds of an item and a document that are held at once; with more, tiles are sought one by one.
PAIRS = 2_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    """Lower-case words of a text (null: none)."""
    return _WORD.findall((text or "").lower())


def rolling(codes: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes (modulo 2**64) of all runs of n codes."""
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(codes) - n + 1, np.uint64)
    for i in range(n):
        out = out * _BASE + codes[i : len(codes) - n + 1 + i]
    return out


# seeds


@functools.lru_cache(maxsize=1)
def _in_words() -> np.ndarray:
    """Whether each code point is part of a word."""
    return np.array([chr(c).isalnum() for c in range(0x110000)]) | (np.arange(0x110000) == ord("_"))


def _word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of some texts, and the place of its text."""
    low = [(text or "").lower() for text in texts]
    codes = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.concatenate([[False], _in_words()[codes], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    power = np.cumprod(np.full(len(codes), _BASE))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes + np.uint64(1)) * power)])
    back = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(codes), _INVERSE)]))
    own = (sums[ends] - sums[starts]) * back[starts]
    own ^= own >> np.uint64(29)
    sizes = np.fromiter(map(len, low), np.int64, len(low)) + 1
    return own * _BASE, np.searchsorted(np.cumsum(sizes), starts, side="right")


def seeds(texts: list[str | None], lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of these numbers of words in each text, and the place of their text, by place."""
    own, owner = _word_hashes(texts)
    found = []
    for n in lengths:
        if len(own) >= n:
            whole = owner[n - 1 :] == owner[: len(owner) - n + 1]
            hashes = rolling(own, n) + np.uint64(n)
            hashes ^= hashes >> np.uint64(32)
            found.append(((hashes * _INVERSE)[whole], owner[: len(whole)][whole]))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes, places = (np.concatenate(parts) for parts in zip(*found))
    order = np.argsort(places, kind="stable")
    return hashes[order], places[order]


class Benchmark:
    """Items (item, item_id, text, n words) and their seeds as tables, and the bits that rule out other seeds."""

    def __init__(self, benchmark: DataFrame) -> None:
        spark = benchmark.sparkSession

        def counted(tuples: Iterator[tuple]) -> Iterator[tuple]:
            for item, item_id, text in tuples:
                if n := len(words(text)):
                    yield item, item_id, text, n

        plain = pick(benchmark, "item_id", "text").withColumn("item", F.monotonically_increasing_id())
        schema = "item long, item_id long, text string, n int"
        self.items = arrow_map(plain.select("item", "item_id", "text"), schema, counted).checkpoint()
        least = F.least("n", F.lit(SEED)).alias("n")
        self.lengths = sorted(row["n"] for row in self.items.select(least).distinct().collect())  # SEED at most

        def of_items(tuples: Iterator[tuple]) -> Iterator[tuple]:
            for item, text, n in tuples:
                yield from ((h, item) for h in np.unique(seeds([text], [n])[0].view(np.int64)).tolist())

        short = self.items.select("item", "text", least)
        self.seeds = arrow_map(short, "seed long, item long", of_items).checkpoint()
        at = self.seeds.select(F.pmod("seed", F.lit(FILTER_BITS)).alias("bit"))
        words_ = at.groupBy(F.floor(F.col("bit") / 64).alias("place")).agg(
            F.expr("bit_or(shiftleft(1L, CAST(bit % 64 AS INT)))").alias("bits")
        )
        bits = np.zeros(FILTER_BITS // 64, np.int64)
        for row in words_.collect():  # FILTER_BITS / 64 rows at most
            bits[row["place"]] = row["bits"]
        self.bits = spark.sparkContext.broadcast(bits.view(np.uint64))


def _possible(bits: np.ndarray, lengths: list[int], texts: list[str | None]) -> list[list[int]]:
    """For each text its seeds that the bits do not rule out, each once."""
    found, place = seeds(texts, lengths)
    at = found & np.uint64(64 * len(bits) - 1)
    hit = bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1) == 1
    found, place = found[hit].view(np.int64), place[hit]
    out: list[list[int]] = [[]] * len(texts)
    for i, own in zip(np.unique(place).tolist(), np.split(found, np.flatnonzero(np.diff(place)) + 1)):
        out[i] = np.unique(own).tolist()
    return out


def _suspected(bits, lengths: list[int], tuples: Iterator[tuple]) -> Iterator[tuple[tuple, list[int]]]:
    """Each tuple, whose last value is a text, with its possible seeds."""
    group: list[tuple] = []
    size = 0
    for row in tuples:
        group.append(row)
        size += len(row[-1] or "")
        if size > TOGETHER:
            yield from zip(group, _possible(bits, lengths, [r[-1] for r in group]))
            group, size = [], 0
    yield from zip(group, _possible(bits, lengths, [r[-1] for r in group]))


def _contaminated(suspects: DataFrame, bench: Benchmark, coverage: float) -> DataFrame:
    """row, item_id, coverage, n_tiles and longest of the pairs that reach the coverage, from rows of row, text, seeds.

    The rows of one seed are dealt into SALTS parts, so a passage of very many
    documents goes to as many tasks.
    """
    salt = F.pmod(F.xxhash64("row"), F.lit(SALTS))
    asked = suspects.select("row", F.explode("seeds").alias("seed")).withColumn("salt", salt)
    offered = bench.seeds.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    pairs = asked.join(offered, ["seed", "salt"]).select("row", "item").distinct()
    items = bench.items.select("item", "item_id", F.col("text").alias("item_text"))
    both = pairs.join(items, "item").join(suspects.select("row", "text"), "row")
    ordered = both.select("row", "item_id", "item_text", "text").sortWithinPartitions("row")

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        last, own = None, []
        for row, item_id, item_text, text in tuples:
            if row != last:
                last, own = row, words(text)
            item = words(item_text)
            code = {w: i for i, w in enumerate(dict.fromkeys(item), 1)}
            tiles = tile(
                np.array([code[w] for w in item], np.uint64), np.array([code.get(w, 0) for w in own], np.uint64), SEED
            )
            share = sum(n for _, _, n in tiles) / len(item)
            if tiles and share >= coverage:
                yield row, item_id, share, len(tiles), max(n for _, _, n in tiles)

    return arrow_map(ordered, "row long, item_id long, coverage double, n_tiles int, longest int", rows)


def tile(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in item, place in document, length), longest first.

    Of matches of equal length the first in the item, then in the document, is
    marked first.
    """
    least = min(least, len(item))
    matches = _matches(item, doc, least)
    if matches is None:
        return _one_by_one(item, doc, least)
    free_item, free_doc = np.ones(len(item), bool), np.ones(len(doc), bool)
    tiles = []
    # a match is marked at its turn if no word of it is marked; what is left of it comes again, shorter
    heap = [(-n, a, b) for a, b, n in matches]
    heapq.heapify(heap)
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        own = free_item[a : a + n] & free_doc[b : b + n]
        if own.all():
            free_item[a : a + n] = False
            free_doc[b : b + n] = False
            tiles.append((a, b, n))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if stop - start >= least:
                heapq.heappush(heap, (start - stop, a + start, b + start))
    return tiles


class _Runs:
    """Karp-Rabin hashes of runs of any length, from running sums."""

    def __init__(self, codes: np.ndarray) -> None:
        powers = np.cumprod(np.full(len(codes), _BASE))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers)])
        self.back = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(codes), _INVERSE)]))

    def hashes(self, n: int) -> np.ndarray:
        return (self.sums[n:] - self.sums[:-n]) * self.back[: len(self.sums) - n]


def _one_by_one(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """The same tiles, each found by halving the length it may have: memory in proportion to the words.

    If free runs of some length agree, shorter ones do; so the longest length is
    found by halving. There are as many rounds as tiles, at most the words of the
    item over ``least``.
    """
    own, theirs = _Runs(item), _Runs(doc)
    marked_item, marked_doc = np.zeros(len(item) + 1, np.int64), np.zeros(len(doc) + 1, np.int64)
    tiles: list[tuple[int, int, int]] = []

    def first(n: int) -> tuple[int, int] | None:
        """The first free match of n words, by place in the item, then in the document."""
        if n > min(len(item), len(doc)):
            return None
        at_item = np.flatnonzero(marked_item[n:] == marked_item[:-n])
        at_doc = np.flatnonzero(marked_doc[n:] == marked_doc[:-n])
        ours, others = own.hashes(n)[at_item], theirs.hashes(n)[at_doc]
        order = np.argsort(others, kind="stable")
        low = np.searchsorted(others[order], ours, "left")
        high = np.searchsorted(others[order], ours, "right")
        for i in np.flatnonzero(low < high).tolist():
            a = int(at_item[i])
            for j in range(int(low[i]), int(high[i])):
                b = int(at_doc[order[j]])
                if np.array_equal(item[a : a + n], doc[b : b + n]):  # a hash is no proof
                    return a, b
        return None

    longest = len(item)
    while True:
        low, high, found = least, longest, None
        while low <= high:
            n = (low + high) // 2
            match = first(n)
            if match is None:
                high = n - 1
            else:
                low, found = n + 1, (*match, n)
        if found is None:
            return tiles
        a, b, n = found
        tiles.append(found)
        longest = n
        marked_item[1:] += np.clip(np.arange(1, len(item) + 1) - a, 0, n)
        marked_doc[1:] += np.clip(np.arange(1, len(doc) + 1) - b, 0, n)


def _matches(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]] | None:
    """All maximal matches of at least this many words: equal hashes on a diagonal, then the words compared.

    None where equal words of both repeat so often that there are more than PAIRS.
    """
    if not least:
        return []
    own = rolling(item, least)
    order = np.argsort(own, kind="stable")
    theirs = rolling(doc, least)
    low = np.searchsorted(own[order], theirs, "left")
    count = np.searchsorted(own[order], theirs, "right") - low
    if int(count.sum()) > PAIRS:
        return None
    at_doc = np.repeat(np.arange(len(theirs)), count)
    if not len(at_doc):
        return []
    step = np.arange(len(at_doc)) - np.repeat(np.cumsum(count) - count, count)
    at_item = order[np.repeat(low, count) + step]
    same = np.ones(len(at_doc), bool)
    for i in range(least):  # a hash is no proof
        same &= item[at_item + i] == doc[at_doc + i]
    at_doc, at_item = at_doc[same], at_item[same]
    place = np.lexsort((at_doc, at_doc - at_item))
    at_doc, at_item = at_doc[place], at_item[place]
    diagonal = at_doc - at_item
    new = np.flatnonzero(np.r_[True, (np.diff(diagonal) != 0) | (np.diff(at_doc) != 1)]) if len(at_doc) else []
    ends = np.r_[new[1:], len(at_doc)] if len(new) else []
    return [(int(at_item[a]), int(at_doc[a]), int(b - a) + least - 1) for a, b in zip(new, ends)]


def matches(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id, coverage, n_tiles and longest tile (words) of every contaminating pair.

    One row per input row of documents and item that reaches the coverage. Texts
    without words, nulls included, match nothing; items without words are left
    out; repeated rows give repeated pairs; empty tables give an empty result.
    Whole texts are read once, where they are; only texts with a possible seed
    are written and shuffled. A benchmark of any size is searched in this one pass.
    """
    bench = Benchmark(benchmark)
    bits, lengths = bench.bits, bench.lengths

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        for (doc_id, text), found in _suspected(bits.value, lengths, tuples):
            if found:
                yield doc_id, text, found

    suspects = arrow_map(pick(docs, "doc_id", "text"), "doc_id long, text string, seeds array<bigint>", rows)
    suspects = suspects.withColumn("row", F.monotonically_increasing_id()).checkpoint()
    found = _contaminated(suspects, bench, coverage)
    return found.join(suspects.select("row", "doc_id"), "row").select(
        "doc_id", "item_id", "coverage", "n_tiles", "longest"
    )


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of documents that no benchmark item contaminates, all columns kept.

    Rows without words, nulls included, and repeated rows stay (repeated ones all
    or none); an empty table stays empty, an empty benchmark changes nothing; no
    column is looked at but ``text``, whatever others are called. The rows are
    written once with their possible seeds; those without any pass, the others
    are judged and found again by a number that is written with them.
    """
    names = docs.columns
    plain = numbered(docs)
    text = f"_{names.index('text')}"
    bench = Benchmark(benchmark)
    bits, lengths = bench.bits, bench.lengths

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        for _, found in _suspected(bits.value, lengths, tuples):
            yield (found,)

    folder = scratch_path(docs.sparkSession, "suspects")
    flagged = arrow_extend(plain, [text], "seeds array<bigint>", rows).withColumn("row", F.monotonically_increasing_id())
    flagged.write.parquet(folder)
    flagged = docs.sparkSession.read.schema(flagged.schema).parquet(folder)
    suspects = flagged.where(F.size("seeds") > 0)
    bad = _contaminated(suspects.select("row", F.col(text).alias("text"), "seeds"), bench, coverage).select("row").distinct()
    kept = flagged.where(F.size("seeds") == 0).unionAll(suspects.join(bad, "row", "left_anti").select(*flagged.columns))
    return kept.select(*plain.columns).toDF(*names)

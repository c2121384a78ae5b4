"""SimHash near-duplicates by segment popcounts on a grid.

A fingerprint of 64 bits is embedded as the bit counts of 32 segments of two
bits. Manhattan distance of the counts never exceeds the Hamming distance of the
fingerprints. The segments are dealt into GROUPS groups; fingerprints that differ
in at most DISTANCE bits have equal counts in all but DISTANCE groups at most, so
each choice of ``GROUPS - DISTANCE`` groups is a grid whose cells bring every
pair together that differs elsewhere only. Within a cell, pairs whose Manhattan
distance is within bounds are verified on the bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, groupby, islice

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from paddock.llm.common import arrow_extend, arrow_map, numbered, pick
from paddock.llm.components import smallest_reachable
from paddock.session import scratch_path

#: Words of a shingle, most differing bits of a link, and the seed of the hash.
SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Groups of segments of the grid.
GROUPS = 6
#: Fingerprints of a cell that are compared all with all; a larger cell is cut finer first.
CELL = 2048

_ODD = np.uint64(0x5555555555555555)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority of the bits of the shingles' XXH64, repeats included (null and empty: zero)."""
    found = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space alone
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(found) - shingle + 1
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    step = 1 << 15  # long texts are counted in parts
    for low in range(0, n, step):
        high = min(n, low + step)
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(starts[low:high].tolist(), ends[low + shingle - 1 : high + shingle - 1].tolist())],
            np.uint64,
        )
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def popcounts(prints: np.ndarray) -> np.ndarray:
    """The embedding: counts (0 to 2) of the 32 two-bit segments, two bits each, in one number."""
    return (prints & _ODD) + (prints >> np.uint64(1) & _ODD)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of the differences of the 32 counts of two embeddings."""
    # per segment |x - y| for x, y in 0..2: 1 where the low bits differ, 2 where they agree and the high bits differ
    apart = a ^ b
    ones = apart & _ODD
    twos = apart >> np.uint64(1) & _ODD & ~ones
    return np.bitwise_count(ones) + 2 * np.bitwise_count(twos)


def _masks(groups: int, kept: int) -> list[int]:
    """Bit masks of the embedding for each choice of kept groups of segments."""
    edges = np.linspace(0, 32, groups + 1).astype(int)
    parts = [sum(3 << 2 * s for s in range(a, b)) for a, b in zip(edges, edges[1:])]
    return [sum(choice) for choice in combinations(parts, kept)]


def _mixed(cells: np.ndarray, grid: int) -> np.ndarray:
    """Cell and grid as one number, spread over all bits; cells that collide are only compared in vain."""
    x = cells ^ np.uint64((grid + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift in (33, 29):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ x >> np.uint64(32)


def links_within(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect all fingerprints (distinct, one cell) of at most this distance: a forest, not all pairs."""
    n = len(prints)
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    out: list[tuple[int, int]] = []

    def link(pairs: Iterator[tuple[int, int]]) -> None:
        for i, j in pairs:
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((i, j))

    def compare(places: np.ndarray) -> None:
        """All with all, in blocks."""
        for low in range(0, len(places), 256):
            own = places[low : low + 256]
            rest = places[low:]
            counts = manhattan(embedded[own][:, None], embedded[rest][None, :])
            x, y = np.nonzero(counts <= distance)
            i, j = own[x], rest[y]
            close = (i != j) & (np.bitwise_count(prints[i] ^ prints[j]) <= distance)
            link(zip(i[close].tolist(), j[close].tolist()))

    embedded = popcounts(prints)
    if n <= CELL:
        compare(np.arange(n))
        return out
    # a crowded cell: of distance + 1 parts of the bits one agrees in every pair that is sought
    edges = np.linspace(0, 64, distance + 2).astype(int)
    for a, b in zip(edges, edges[1:]):
        part = prints >> np.uint64(a) & np.uint64((1 << int(b - a)) - 1)
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order])) + 1
        for places in np.split(order, cuts):
            if len(places) > 1:
                compare(places)
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and print (the fingerprint as a signed long) of each row."""

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in tuples:
            yield doc_id, _signed(fingerprint(text, shingle))

    return arrow_map(pick(docs, "doc_id", "text"), "doc_id long, print long", rows)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(prints: DataFrame, distance: int = DISTANCE, groups: int = GROUPS) -> DataFrame:
    """Links (a, b) that connect fingerprints at most ``distance`` bits apart, from distinct values in column print.

    Every fingerprint goes to one cell of each grid. A task reads its cells in
    order and holds the fingerprints of one cell, eight bytes each; a crowded
    cell is cut finer inside the task. What a cell gives is a forest, so no
    group of copies is expanded into its pairs.
    """
    masks = _masks(groups, groups - distance)

    def cells(tuples: Iterator[tuple]) -> Iterator[tuple]:
        while values := [value for (value,) in islice(tuples, 4096)]:
            embedded = popcounts(np.array(values, np.int64).view(np.uint64))
            for grid, mask in enumerate(masks):
                keys = _mixed(embedded & np.uint64(mask), grid)
                yield from zip(keys.view(np.int64).tolist(), values)

    def verified(tuples: Iterator[tuple]) -> Iterator[tuple]:
        for _, cell in groupby(tuples, key=lambda row: row[0]):
            own = np.unique(np.fromiter((value for _, value in cell), np.int64))
            if len(own) > 1:
                for i, j in links_within(own.view(np.uint64), distance):
                    yield int(own[i]), int(own[j])

    dealt = arrow_map(prints.select("print"), "cell long, print long", cells)
    together = dealt.repartition("cell").sortWithinPartitions("cell", "print")
    return arrow_map(together, "a long, b long", verified)


def _rooted(distinct: DataFrame, distance: int) -> DataFrame:
    """print and root (a fingerprint that names the group) of distinct fingerprints."""
    roots = smallest_reachable(links(distinct, distance)).withColumnRenamed("node", "print")
    return distinct.select("print").join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))


def components(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, print, root and component_id of each row."""
    every = fingerprints(docs, shingle).checkpoint()  # the texts are read once
    distinct = every.groupBy("print").agg(F.min("doc_id").alias("first")).checkpoint()
    rooted = _rooted(distinct, distance).join(distinct, "print")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    # dealt by root, so that the join deals both sides anew and Spark can split a fingerprint of very many rows
    named = rooted.select("print", "root").join(least, "root").repartition("root")
    return every.join(named, "print")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of each row.

    Null, empty and blank texts have fingerprint zero and are linked like any
    other; repeated rows stay; null ids are never the smallest, and a component
    of null ids alone has a null component_id; an empty table gives an empty
    one; other columns are not read.
    """
    found = components(docs, shingle, distance)
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each component, the one of the smallest doc_id, all columns kept.

    Of rows that share this id the one with the least text stays (null first,
    then by the other columns). Null ids come last; null and blank texts are one
    component; an empty table stays empty. Rows are found again by fingerprint,
    not by a number given to them, so a task that runs twice cannot name another
    row. The rows are written once with their fingerprints, so no text is hashed
    twice; only components whose smallest id is repeated are reduced to one row.
    """
    names = docs.columns
    plain = numbered(docs)
    doc_id, text = (f"_{names.index(name)}" for name in ("doc_id", "text"))

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        for (whole,) in tuples:
            yield (_signed(fingerprint(whole, shingle)),)

    folder = scratch_path(docs.sparkSession, "fingerprints")
    extended = arrow_extend(plain, [text], "print long", rows)
    extended.write.parquet(folder)
    extended = docs.sparkSession.read.schema(extended.schema).parquet(folder)
    counted = extended.groupBy("print", F.col(doc_id).alias("doc_id")).agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "n")).alias("first")
    firsts = counted.groupBy("print").agg(first).checkpoint()  # the smallest id of each fingerprint and its rows
    rooted = _rooted(firsts, distance).join(firsts, "print").select("print", "root", "first.*")
    equal = rooted.groupBy("root", "null", "doc_id").agg(F.sum("n").alias("n"))
    chosen = equal.groupBy("root").agg(F.min(F.struct("null", "doc_id", "n")).alias("least"))
    # dealt by root, so that the join deals both sides anew and Spark can split a fingerprint of very many rows
    named = rooted.select("print", "root").join(chosen, "root").repartition("root")
    named = named.select("print", "root", F.col("least.doc_id").alias("least"), F.col("least.n").alias("equal"))
    kept = extended.join(named, "print").where(F.col(doc_id).eqNullSafe(F.col("least")))
    order = F.struct(F.col(text), F.to_json(F.struct(*plain.columns)))
    repeated = kept.where("equal > 1").groupBy("root").agg(F.min_by(F.struct(*plain.columns), order).alias("row"))
    return kept.where("equal = 1").select(*plain.columns).union(repeated.select("row.*")).toDF(*names)

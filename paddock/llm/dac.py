"""Token ids in directly addressable codes.

Every id is cut into chunks of eight bits. Level k holds the k-th chunk of all
ids that have one, and a bitmap that tells which of them go on; a directory of
counts at every 512 bits gives the rank of a bit, which is the place of the next
chunk one level below. So any token is read without decoding what stands before.

File format, a segment: ``DAC1``, number of levels (u8), number of ids (u64);
for each level the number of chunks (u64), the chunks, the bitmap (bits in
little order, padded to whole words of 512), the rank directory (u32 each).
A table of such segments carries, per row, the range of documents it holds.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from paddock.llm.bpe import _encoded, default_path
from paddock.llm.common import arrow_map, pick
from paddock.session import scratch_path

_MAGIC = b"DAC1"
_WORD = 64  # bytes of bitmap between two entries of the rank directory
#: A segment is closed by the document that brings it to this many ids.
SEGMENT_IDS = 1 << 18
#: Id that ends a document.
END_ID = 1


def pack(ids: np.ndarray) -> bytes:
    """The segment of ids (unsigned, below 2**32)."""
    levels = []
    rest = ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bitmap = np.packbits(more, bitorder="little")
        bitmap = np.concatenate([bitmap, np.zeros(-len(bitmap) % _WORD, np.uint8)])
        counts = np.bitwise_count(bitmap).reshape(-1, _WORD).sum(axis=1, dtype=np.uint32)
        ranks = np.cumsum(counts, dtype=np.uint32) - counts
        chunks = (rest & 0xFF).astype(np.uint8)
        levels.append(struct.pack("<Q", len(rest)) + chunks.tobytes() + bitmap.tobytes() + ranks.tobytes())
        rest = rest[more] >> 8
        if not len(rest):
            break
    return _MAGIC + struct.pack("<BQ", len(levels), len(ids)) + b"".join(levels)


class Segment:
    """Random access to the ids of a segment."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        n_levels, self.n = struct.unpack_from("<BQ", data, 4)
        at, self.levels = 13, []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            words = -(-(-(-n // 8)) // _WORD)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            bitmap = np.frombuffer(data, np.uint8, words * _WORD, at + 8 + n)
            ranks = np.frombuffer(data, np.uint32, words, at + 8 + n + words * _WORD)
            self.levels.append((chunks, bitmap, ranks))
            at += 8 + n + words * (_WORD + 4)

    def _rank(self, level: int, i: int) -> int:
        """Set bits before bit i."""
        _, bitmap, ranks = self.levels[level]
        word, byte = i // (8 * _WORD), i // 8
        if word >= len(ranks):
            return int(ranks[-1]) + int(np.bitwise_count(bitmap[-_WORD:]).sum()) if len(ranks) else 0
        whole = int(np.bitwise_count(bitmap[word * _WORD : byte]).sum(dtype=np.int64))
        part = int(bitmap[byte]) & ((1 << i % 8) - 1) if i % 8 else 0
        return int(ranks[word]) + whole + part.bit_count()

    def get(self, i: int) -> int:
        """The i-th id."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value, shift, level = 0, 0, 0
        while True:
            chunks, bitmap, _ = self.levels[level]
            value |= int(chunks[i]) << shift
            if not bitmap[i // 8] >> (i % 8) & 1:
                return value
            i, level, shift = self._rank(level, i), level + 1, shift + 8

    def range(self, start: int, stop: int) -> np.ndarray:
        """Ids from start to stop, end exclusive."""
        return self._range(0, start, stop)

    def _range(self, level: int, start: int, stop: int) -> np.ndarray:
        if start >= stop:
            return np.zeros(0, np.uint32)
        chunks, bitmap, _ = self.levels[level]
        values = chunks[start:stop].astype(np.uint32)
        first = start // 8
        bits = np.unpackbits(bitmap[first : -(-stop // 8)], bitorder="little")
        more = bits[start - 8 * first : stop - 8 * first].astype(bool)
        if more.any():
            below = self._rank(level, start)
            values[more] |= self._range(level + 1, below, below + int(more.sum())) << 8
        return values


SEGMENTS = "part int, seq int, part_offset long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, data binary"


def write_segments(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> None:
    """Encode documents and write their ids, each document closed by ``end_id``, in ascending doc_id order.

    The texts are dealt into ranges of doc_id (nulls first; rows of one doc_id
    follow each other by a hash of their text, whatever files they come from),
    so ids are made once and never shuffled. The folder holds one Parquet row per
    segment: partition number and sequence give the order of the segments.
    """
    file = path or default_path()

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        part, seq, offset, n = 0, 0, 0, 0
        kept: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        end = np.array([end_id], np.uint32)

        def closed() -> tuple:
            lengths = [len(k) + 1 for k in kept]
            ids = np.concatenate([x for k in kept for x in (k, end)])
            return part, seq, offset, n, doc_ids, lengths, pack(ids)

        def pairs() -> Iterator[tuple]:
            nonlocal part
            for number, doc_id, text in tuples:
                part = number
                yield doc_id, text

        for doc_id, ids in _encoded(pairs(), file):
            kept.append(ids)
            doc_ids.append(doc_id)
            n += len(ids) + 1
            if n >= SEGMENT_IDS:
                yield closed()
                seq, offset, n, kept, doc_ids = seq + 1, offset + n, 0, [], []
        if kept:
            yield closed()

    ordered = (
        pick(docs, "doc_id", "text")
        .withColumn("row", F.xxhash64("text"))
        .repartitionByRange("doc_id", "row")
        .sortWithinPartitions("doc_id", "row", "text")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    arrow_map(ordered, SEGMENTS, rows).write.mode("errorifexists").parquet(folder)


def _placed(segments: DataFrame) -> DataFrame:
    """Segments with ``start``, the number of ids in all segments before."""
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("total"))
    # one row for each partition of the writer, however large the table is
    starts = totals.selectExpr(
        "part", "sum(total) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - total AS start"
    )
    return segments.join(F.broadcast(starts), "part").withColumn("start", F.col("start") + F.col("part_offset"))


def read_segments(segments: DataFrame) -> DataFrame:
    """Per document from written segments: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""
    placed = _placed(segments).select("start", "doc_ids", "lengths", "data")

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        for start, doc_ids, lengths, data in tuples:
            segment, at = Segment(data), 0
            for doc_id, length in zip(doc_ids, lengths):
                ids = segment.range(at, at + length)
                yield doc_id, start + at, length, zlib.crc32(ids.astype("<u4").tobytes())
                at += length

    return arrow_map(placed, "doc_id long, start long, n_tokens long, ids_crc32 long", rows)


def tokens_at(segments: DataFrame, positions: DataFrame) -> DataFrame:
    """position and id of tokens asked for by their place in the whole corpus (column ``position``).

    A position meets the one segment that holds it by the blocks of SEGMENT_IDS
    positions a segment reaches into; there each id is read from its codes
    without decoding others. Positions outside the corpus and null ones have no
    row, repeated ones are answered once.
    """
    block = lambda column: F.floor(column / SEGMENT_IDS).cast("long")
    placed = _placed(segments).select("start", "n_ids", "data")
    reach = F.sequence(block(F.col("start")), block(F.col("start") + F.col("n_ids") - 1))
    ranges = placed.select("start", "n_ids", F.explode(reach).alias("block"))
    asked = positions.select(F.col("position").cast("long").alias("position")).distinct()
    inside = F.col("position").between(F.col("start"), F.col("start") + F.col("n_ids") - 1)
    # at most SEGMENT_IDS positions and a document's length in each list
    by_segment = (
        asked.withColumn("block", block(F.col("position")))
        .join(ranges, "block")
        .where(inside)
        .groupBy("start")
        .agg(F.collect_list("position").alias("positions"))
    )

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        for start, data, wanted in tuples:
            segment = Segment(data)
            for position in wanted:
                yield position, segment.get(position - start)

    found = placed.join(by_segment, "start").select("start", "data", "positions")
    return arrow_map(found, "position long, id long", rows)


def written_and_read(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the documents' ids into the shared folder and read them back.

    Null and empty texts have the end id alone; repeated rows are written as
    often as they occur; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-ids")
    write_segments(docs, folder, path)
    return read_segments(spark.read.schema(SEGMENTS).parquet(folder))

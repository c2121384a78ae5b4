"""Approximate nearest neighbours by a block matrix join on int8 tiles.

Vectors are quantised to int8 with a scale of their own. Query blocks meet
candidate blocks in tiles; the product of a tile, computed on the integers, gives
every distance with a bound on the error of quantisation. A candidate whose lower
bound exceeds the k-th smallest upper bound of its query is out; the others are
computed again in double precision, and the short lists of all tiles are merged
by heaps. The bounds hold, so the result is exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paddock.llm.common import arrow_map, pick

#: Vectors of a tile on either side; a task holds one tile.
SIDE = 16_384
#: Rows of a product that are held at a time.
STRIP = 256


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale, length of the vector and length of what quantisation lost, per row (doubles)."""
    scale = np.abs(vectors).max(axis=1) / 127.0
    codes = np.rint(vectors / scale[:, None])
    lost = vectors - codes * scale[:, None]
    return codes.astype(np.int8), scale, np.linalg.norm(vectors, axis=1), np.linalg.norm(lost, axis=1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows; float32 holds the sums of 1024 components."""
    total = np.zeros((len(a), len(b)))
    for low in range(0, a.shape[1], 1024):
        total += a[:, low : low + 1024].astype(np.float32) @ b[:, low : low + 1024].astype(np.float32).T
    return total


def distances(query: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, components summed in order."""
    return np.sqrt(np.cumsum((others - query) ** 2, axis=1)[:, -1])


def nearest_in_tile(
    q_rows: np.ndarray, q_ids: np.ndarray, q: np.ndarray, c_rows: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int
) -> Iterator[tuple[int, int, int, float]]:
    """Row of the query, its id, id of the candidate and distance, of the k nearest candidates in a tile."""
    codes, scale, norm, lost = quantise(c)
    own = norm * norm
    q_codes, q_scale, q_norm, q_lost = quantise(q)
    for low in range(0, len(q), STRIP):
        part = slice(low, low + STRIP)
        inner = products(q_codes[part], codes) * q_scale[part, None] * scale
        square = q_norm[part, None] ** 2 + own - 2 * inner
        # |xy - x'y'| <= |x - x'||y| + |x'||y - y'|, and |x'| <= |x| + |x - x'|; the rest covers rounding
        error = 2 * (q_lost[part, None] * norm + (q_norm[part, None] + q_lost[part, None]) * lost)
        error += 1e-9 * (q_norm[part, None] ** 2 + own)
        upper = square + error
        upper[q_rows[part, None] == c_rows] = np.inf
        square -= error
        for i in range(upper.shape[0]):
            mine = upper[i]
            bound = np.partition(mine, k - 1)[k - 1] if len(mine) > k else np.inf
            left = np.flatnonzero((square[i] <= bound) & (mine < np.inf))
            exact = distances(q[low + i], c[left])
            for at in np.lexsort((c_ids[left], exact))[:k].tolist():
                yield int(q_rows[low + i]), int(q_ids[low + i]), int(c_ids[left[at]]), float(exact[at])


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """row, vec_id and vector of rows that take part, the vector as bytes of doubles.

    Null ids, null or empty vectors, zero vectors and vectors that hold null,
    NaN or infinite components take no part.
    """
    numbered = pick(vectors, "vec_id", vector).toDF("vec_id", "vector").withColumn("row", F.monotonically_increasing_id())

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        for row, vec_id, values in tuples:
            if vec_id is None or not values or None in values:
                continue
            own = np.array(values, np.float64)
            if np.isfinite(own).all() and own.any() and np.abs(own).max() / 127.0 > 0:
                yield row, vec_id, own.tobytes()

    return arrow_map(numbered.select("row", "vec_id", "vector"), "row long, vec_id long, vector binary", rows)


def search(vectors: DataFrame, every: int = 100, k: int = 10, vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest of each query, ties to the smaller vec_id.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all
    rows but the query's own. Repeated ids and vectors are rows of their own, so
    a repeated query has a list for each of its rows. An empty table, or one
    without queries, gives an empty result; vectors of unequal length only meet
    their like. Which vectors
    take no part says ``usable``.

    Blocks have SIDE vectors. Candidates go to one tile for each query block
    and queries to one for each candidate block; a tile is a group of at most
    twice SIDE rows, whatever ids and values repeat.
    """
    table = usable(vectors, vector).withColumn("size", F.length("vector")).checkpoint()
    sizes = table.agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    c_blocks, q_blocks = -(-sizes["n"] // SIDE) or 1, -(-sizes["q"] // SIDE) or 1
    spread = F.pmod(F.xxhash64("row"), F.lit(1 << 40))
    candidates = table.withColumn("c", (spread % c_blocks).cast("int")).withColumn(
        "q", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))
    )
    queries = table.where(F.col("vec_id") % every == 0).withColumn("q", (spread % q_blocks).cast("int")).withColumn(
        "c", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1)))
    )
    columns = ["q", "c", "size", "row", "vec_id", "vector"]
    tiles = candidates.select(*columns, F.lit(False).alias("asks")).union(queries.select(*columns, F.lit(True)))

    def tile(group: pa.Table) -> pa.Table:
        asks = group["asks"].to_numpy(zero_copy_only=False).astype(bool)
        rows, ids = group["row"].to_numpy(), group["vec_id"].to_numpy()
        data = np.frombuffer(b"".join(group["vector"].to_pylist()), np.float64).reshape(len(rows), -1)
        found = list(nearest_in_tile(rows[asks], ids[asks], data[asks], rows[~asks], ids[~asks], data[~asks], k)) if asks.any() and not asks.all() else []
        return pa.Table.from_arrays(
            [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
            names=["row", "query_id", "vec_id", "score"],
        )

    found = tiles.groupBy("q", "c", "size").applyInArrow(tile, "row long, query_id long, vec_id long, score double")

    def merged(group: pa.Table) -> pa.Table:
        best = heapq.nsmallest(k, zip(group["score"].to_pylist(), group["vec_id"].to_pylist()))
        query = group["query_id"][0].as_py()
        return pa.table(
            {
                "query_id": pa.array([query] * len(best), pa.int64()),
                "rank": pa.array(range(1, len(best) + 1), pa.int32()),
                "vec_id": pa.array([v for _, v in best], pa.int64()),
                "score": pa.array([s for s, _ in best], pa.float64()),
            }
        )

    # a query has k rows of each candidate block
    return found.groupBy("row").applyInArrow(merged, "query_id long, rank int, vec_id long, score double")


#: Oracle over ``embeddings``: all candidates of every query.
SQL = """
WITH usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.v, c.v),
      lambda x: (x[1] - x[2]) * (x[1] - x[2])), lambda a, b: a + b)) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

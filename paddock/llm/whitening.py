"""Whitening of vectors by the eigenvectors of their covariance, found in mixed precision.

Spark sums the vectors exactly and adds up the centred products. The covariance,
a matrix of dimension x dimension, is all the driver gets: float32 eigenvectors
of it are corrected by the iteration of Ogita and Aishima, a few products of
matrices in extended precision that double the correct digits each time.
Eigenvalues too close together for float32 form clusters in which the iteration
cannot tell the vectors apart; each cluster is solved again inside its own
subspace, where the common part of its eigenvalues is taken off first.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from paddock.llm.common import pick

#: Components that are returned.
COMPONENTS = 8
#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024.0, 100_000
#: Scaled entries of this size or more are no exact doubles; their vectors take no part.
_LARGEST = 2.0**53
#: Rows whose products are added in one multiplication.
_ROWS = 4096
#: Corrections that are tried at most; each doubles the digits, float32 begins with seven.
_ROUNDS = 12
_WIDE = np.longdouble


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """vec_id and scaled entries (rows x dimension) of rows that take part, by length, some thousand rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            lists = part["vector"]
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            entries = pc.cast(lists.flatten(), pa.float64()).to_numpy(zero_copy_only=False)  # null as NaN
            scaled = np.floor(SCALE * entries)
            good = np.abs(scaled) < _LARGEST  # false for NaN too
            owner = np.repeat(np.arange(part.num_rows), lengths)
            whole = (lengths > 0) & (np.bincount(owner[~good], minlength=part.num_rows) == 0)
            for size in np.unique(lengths[whole]).tolist():
                own = whole & (lengths == size)
                x = scaled[own[owner]].astype(np.int64).reshape(-1, size) + SHIFT
                yield part["vec_id"].filter(pa.array(own)), x


def sums(table: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """By length of the vectors: number of rows, and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, list[int]]] = {}
        for _, x in _blocks(batches):
            size = x.shape[1]
            n, total = found.get(size, (0, [0] * size))
            # halves of 32 bits: their sums over a block fit into a long
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            found[size] = n + len(x), [t + (h << 32) + l for t, h, l in zip(total, high, low)]
        for size, (n, total) in found.items():
            columns = [[size] * size, list(range(size)), [n] * size, list(map(str, total))]
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, columns)), schema=schema)

    schema = pa.schema([("size", pa.int32()), ("dimension", pa.int32()), ("n", pa.int64()), ("total", pa.string())])
    parts = table.mapInArrow(run, "size int, dimension int, n long, total string")
    exact = F.sum(F.col("total").cast("decimal(38, 0)")).alias("total")
    added = parts.groupBy("size", "dimension").agg(F.sum("n").alias("n"), exact).orderBy("size", "dimension")
    found: dict[int, tuple[int, list[int]]] = {}
    for row in added.collect():
        found.setdefault(row["size"], (row["n"], []))[1].append(int(row["total"]))
    return found


@dataclass(frozen=True)
class Centre:
    """n and S: a row x lies at x - S/n, computed without losing digits to the common part."""

    n: int
    total: list[int]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: whole parts are subtracted as longs, then the fraction."""
        whole = [t // self.n for t in self.total]
        fraction = np.array([(t - w * self.n) / self.n for t, w in zip(self.total, whole)])
        return (x - np.array(whole, np.int64)).astype(np.float64) - fraction

    def squares(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n*x - S)^2 of each row, exact; None where it exceeds a long."""
        whole = np.array([t // self.n for t in self.total], np.int64)
        rest = [t - int(w) * self.n for t, w in zip(self.total, whole)]
        near = x - whole
        largest = self.n * (int(np.abs(near).max(initial=0)) + 1)
        if largest * largest * x.shape[1] < 1 << 63:
            own = self.n * near - np.array(rest, np.int64)
            return (own * own).sum(axis=1).tolist()
        exact = [sum((self.n * v - r) ** 2 for v, r in zip(row, rest)) for row in near.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def products(table: DataFrame, centre: Centre, onto: np.ndarray | None = None) -> np.ndarray:
    """Covariance (divisor n) of the centred rows, or of their projections by the columns of ``onto``.

    Each task adds up one matrix; Spark adds the matrices entry by entry.
    """
    size = len(centre.total)
    width = size if onto is None else onto.shape[1]
    upper = np.triu_indices(width)
    schema = pa.schema([("entry", pa.int32()), ("value", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added, any_rows = np.zeros((width, width)), False
        for _, x in _blocks(batches):
            if x.shape[1] != size:
                continue
            rows = centre.deviations(x)
            if onto is not None:
                rows = rows @ onto
            added += rows.T @ rows
            any_rows = True
        if any_rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(upper[0]), dtype=np.int32)), pa.array(added[upper])], schema=schema
            )

    parts = table.mapInArrow(run, "entry int, value double")
    found = parts.groupBy("entry").agg(F.sum("value").alias("value")).toArrow()
    matrix = np.zeros((width, width))
    places = found["entry"].to_numpy()
    matrix[upper[0][places], upper[1][places]] = found["value"].to_numpy()
    return (matrix + np.triu(matrix, 1).T) / centre.n


# eigenvectors


def corrected(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One step of Ogita and Aishima: eigenvalues, better eigenvectors, and the gap below which two are one cluster.

    With R = I - X'X and S = X'AX the correction of X is XE; eigenvalues that
    differ by no more than the gap only have their vectors made orthonormal.
    """
    n = len(matrix)
    r = np.eye(n, dtype=_WIDE) - vectors.T @ vectors
    s = vectors.T @ (matrix @ vectors)
    s = (s + s.T) / 2  # rounding that differs between the halves would be divided by small gaps
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    gap = 2 * (_norm(off) + _norm(matrix) * _norm(r))
    apart = values[None, :] - values[:, None]
    near = np.abs(apart) <= gap
    e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, apart))
    return values, vectors + vectors @ e, float(gap)


def _norm(matrix: np.ndarray) -> _WIDE:
    return np.sqrt((matrix * matrix).sum())


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Places of eigenvalues that follow each other within the gap, two or more."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, to double precision.

    The corrections end when they no longer get smaller. Where clusters remain,
    each is solved in its own subspace, shifted by its mean eigenvalue, in
    double precision, and the corrections go on from there. Equal eigenvalues
    have any orthonormal vectors of their space.
    """
    wide = matrix.astype(_WIDE)
    scale = _norm(wide)
    if not scale > 0:
        return np.zeros(len(matrix)), np.eye(len(matrix))
    wide = wide / scale  # float32 has room for any size then
    vectors = np.linalg.eigh(wide.astype(np.float32))[1].astype(_WIDE)
    smallest = 4 * len(matrix) * float(np.finfo(_WIDE).eps)
    last = np.inf
    for _ in range(_ROUNDS):
        values, better, gap = corrected(wide, vectors)
        vectors = better
        for cluster in _clusters(values, gap):
            basis = vectors[:, cluster]
            middle = values[cluster].mean()
            inner = basis.T @ (wide @ basis) - middle * (basis.T @ basis)
            size = np.abs(inner).max()
            if size > smallest:  # else the eigenvalues are equal as far as the matrix tells
                turned = np.linalg.eigh((inner / size).astype(np.float64))[1].astype(_WIDE)
                vectors[:, cluster] = basis @ turned
        if gap <= smallest or gap >= last / 2 and gap < 1e-15:
            break
        last = gap
    values, vectors, _ = corrected(wide, vectors)
    vectors = vectors + vectors @ (np.eye(len(wide), dtype=_WIDE) - vectors.T @ vectors) / 2
    order = np.argsort(-values, kind="stable")
    return (values[order] * scale).astype(np.float64), vectors[:, order].astype(np.float64)


# rows


def whiten(vectors: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """Each usable row on each of the first components, scaled to unit variance.

    Columns: vec_id, component (from 1 by falling eigenvalue), n, deviation (sum
    of (n*x - S)^2, null where it exceeds a long), whitened, explained (share of
    the variance), identity_error (largest entry of the covariance of whitened
    values minus the identity, over components with variance). Null or empty
    vectors and vectors that hold null, NaN or infinite entries, or entries too
    large to be scaled exactly, take no part; rows with a null vec_id do, and
    repeated rows count as often as they occur. Of vectors of different length only those of the
    most frequent length do (ties: the longest). Components without variance
    (fewer distinct rows than dimensions, or constant entries) have a null
    whitened value and are explained 0. An empty table gives an empty result;
    vectors with fewer dimensions than components have as many as dimensions.
    """
    columns = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    table = pick(vectors, "vec_id", vector).toDF("vec_id", "vector")
    by_size = sums(table)
    if not by_size:
        return vectors.sparkSession.createDataFrame([], columns)
    size = max(by_size, key=lambda length: (by_size[length][0], length))
    centre = Centre(*by_size[size])
    values, axes = eigen(products(table, centre))
    count = min(components, size)
    total = values.sum()
    # what rounding leaves of a variance of nothing
    real = int((values[:count] > max(values[0], 0) * size * 1e-14).sum())
    onto = axes[:, :real] / np.sqrt(values[:real])
    error = float(np.abs(products(table, centre, onto) - np.eye(real)).max()) if real else 0.0
    explained = [float(v / total) if k < real else 0.0 for k, v in enumerate(values[:count])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches):
            if x.shape[1] != size:
                continue
            rows = len(x)
            white = np.zeros((rows, count))
            white[:, :real] = centre.deviations(x) @ onto
            known = np.tile(np.arange(count) < real, rows)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(np.repeat(np.arange(rows), count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * count, centre.n)),
                    pa.array(centre.squares(x), pa.int64()).take(pa.array(np.repeat(np.arange(rows), count))),
                    pa.array(white.ravel(), mask=~known),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * count, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return table.mapInArrow(run, columns)

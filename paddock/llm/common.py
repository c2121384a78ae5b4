"""Helpers shared by the operators: exact column choice, Arrow maps, digests."""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows of an Arrow batch that are turned into Python objects at a time.
ROWS_AT_ONCE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The columns of exactly these names, whatever other columns are called.

    Spark resolves names without regard to case, so columns such as ``TEXT``
    beside ``text`` would make a plain select ambiguous. Of repeated names the
    first column counts.
    """
    columns = df.columns
    places = [columns.index(name) for name in names]
    plain = df.toDF(*[f"_{i}" for i in range(len(columns))])
    return plain.select(*[F.col(f"_{i}").alias(name) for i, name in zip(places, names)])


def arrow_map(
    df: DataFrame, schema: str | T.StructType, rows: Callable[[Iterator[tuple]], Iterable[tuple]]
) -> DataFrame:
    """Apply ``rows`` to an iterator over all input tuples of a task; it yields output tuples.

    Input is turned into Python objects a few rows at a time, output is sent in
    batches that are bounded in rows and bytes.
    """
    out = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(out)

        def tuples() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                    part = batch.slice(at, ROWS_AT_ONCE)
                    yield from zip(*[column.to_pylist() for column in part.columns])

        kept: list[tuple] = []
        weight = 0
        for row in rows(tuples()):
            kept.append(row)
            weight += 64 + sum(len(v) for v in row if isinstance(v, (str, bytes)))
            if len(kept) >= 4096 or weight > 8_000_000:
                yield _batch(kept, arrow)
                kept, weight = [], 0
        if kept:
            yield _batch(kept, arrow)

    return df.mapInArrow(run, out)


def numbered(df: DataFrame) -> DataFrame:
    """The table with its columns named ``_0``, ``_1``, ...; no new column can clash with them."""
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))])


def arrow_extend(
    df: DataFrame,
    read: list[str],
    schema: str,
    rows: Callable[[Iterator[tuple]], Iterable[tuple]],
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns to keep (all) as they are, and new ones that ``rows`` makes from the columns read.

    ``rows`` yields one tuple for each it takes, in order, and may read ahead by
    a bounded number. Kept columns stay Arrow arrays throughout.
    """
    new = T.StructType.fromDDL(schema)
    names = df.columns if keep is None else keep
    sent = df.select(*dict.fromkeys([*names, *read]))
    out = T.StructType([*sent.select(*names).schema.fields, *new.fields])
    kept_at = [sent.columns.index(n) for n in names]
    read_at = [sent.columns.index(n) for n in read]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = list(to_arrow_schema(new))
        waiting: deque[pa.RecordBatch] = deque()

        def tuples() -> Iterator[tuple]:
            for batch in batches:
                waiting.append(batch)
                for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                    yield from zip(*[batch.column(i).slice(at, ROWS_AT_ONCE).to_pylist() for i in read_at])

        made: list[tuple] = []
        for row in rows(tuples()):
            made.append(row)
            while waiting and len(made) >= waiting[0].num_rows:
                batch = waiting.popleft()
                own, made = made[: batch.num_rows], made[batch.num_rows :]
                if not own:
                    continue
                arrays = [pa.array(list(v), f.type) for v, f in zip(zip(*own), fields)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in kept_at), *arrays],
                    schema=pa.schema([*(batch.schema.field(i) for i in kept_at), *fields]),
                )

    return sent.mapInArrow(run, out)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(list(values), field.type) for values, field in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def join_spans(spans: Iterable[tuple[str, int, int]], order: dict[str, int]) -> str:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    placed = sorted(spans, key=lambda s: (s[1], order[s[0]], s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in placed)

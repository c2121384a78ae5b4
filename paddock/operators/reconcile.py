"""Comparison of two large tables by digests of ranges; only ranges that differ are compared by rows.

Rows are told apart into ranges of one key column, at borders taken from the left table. Each
range has the number of its rows and two sums of their hashes, which do not depend on the
order or place of rows. Ranges with equal digests hold the same rows, but for a chance of
about 2^-64 per range; the others are read again, with the bounds pushed down to the scan,
and compared exactly.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from paddock.operators import sets
from paddock.operators.borders import borders, default_parts, with_part


@dataclass(frozen=True)
class Range:
    """Keys from ``low`` (none: from the smallest) up to ``high`` (none: to the largest); or the rows without a key."""

    low: Any = None
    high: Any = None
    without_key: bool = False

    def holds(self, key: str) -> Column:
        if self.without_key:
            return F.col(key).isNull()
        bounds = []
        if self.low is not None:
            bounds.append(F.col(key) >= F.lit(self.low))
        if self.high is not None:
            bounds.append(F.col(key) < F.lit(self.high))
        return reduce(lambda a, b: a & b, bounds, F.col(key).isNotNull())


def _alike(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames in the types a union gives them: equal values have equal hashes then."""
    kinds = left.unionAll(right).schema.fields
    cast = lambda df: df.select(*[F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(df.columns, kinds)])
    return cast(left), cast(right.toDF(*left.columns))


def digests(df: DataFrame, key: str, cuts: DataFrame, parts: int) -> DataFrame:
    """Per range (``part``, NULL for rows without a key): number of rows and sums of row hashes."""
    # a hash leaves out NULLs; whether a value is NULL is hashed beside it
    row = [c for name in df.columns for c in (F.col(name), F.col(name).isNull())]
    first, second = F.xxhash64(*row), F.xxhash64(F.lit("second"), *row)
    low = lambda h: F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))
    high = lambda h: F.sum(F.shiftright(h, 32))
    return with_part(df, key, cuts, parts, "part").groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"),
        F.struct(low(first), high(first), low(second), high(second)).alias("sums"),
    )


def differing_ranges(left: DataFrame, right: DataFrame, key: str, parts: int | None = None) -> list[Range]:
    """Ranges whose digests differ, next to each other merged. At most ``parts`` lines reach the driver."""
    parts = default_parts(left) if parts is None else parts
    left, right = _alike(left, right)
    spark = left.sparkSession
    found = borders(left, key, parts, left.columns).first()["borders"]
    kind = T.StructType([T.StructField("borders", T.ArrayType(left.schema[key].dataType))])
    cuts = spark.createDataFrame([(found,)], kind)
    a, b = digests(left, key, cuts, parts), digests(right, key, cuts, parts)
    both = a.withColumnsRenamed({"part": "p", "rows": "r", "sums": "s"}).join(b, F.col("p").eqNullSafe(F.col("part")), "full")
    same = F.col("rows").eqNullSafe(F.col("r")) & F.col("sums").eqNullSafe(F.col("s"))
    places = [row[0] for row in both.where(~same).select(F.coalesce("p", "part")).collect()]
    ranges = [Range(without_key=True)] if None in places else []
    edges = [None, *found, None]
    for place in sorted(p for p in places if p is not None):
        low, high = edges[place], edges[place + 1]
        if ranges and place and not ranges[-1].without_key and ranges[-1].high == low:
            low = ranges.pop().low
        ranges.append(Range(low, high))
    return ranges


def both_differences(
    left: DataFrame, right: DataFrame, key: str, keep_duplicates: bool = False, parts: int | None = None
) -> DataFrame:
    """Rows found on one side only, labelled as by ``sets.both_differences``.

    Digests are compared at once; the rows of ranges that differ are read when the result is.
    Equal tables are not read again. ``key`` should be a column the tables are sorted or
    partitioned by, so that a range is a part of their files.
    """
    left, right = _alike(left, right)
    ranges = differing_ranges(left, right, key, parts)
    if not ranges:
        return sets.both_differences(left.limit(0), left.limit(0), keep_duplicates)
    inside = reduce(lambda a, b: a | b, [r.holds(key) for r in ranges])
    return sets.both_differences(left.where(inside), right.where(inside), keep_duplicates)


def difference(left: DataFrame, right: DataFrame, key: str, keep_duplicates: bool = False) -> DataFrame:
    """Rows of left that are not in right, as by ``sets.difference``."""
    found = both_differences(left, right, key, keep_duplicates)
    return found.where("which_diff = 'a_minus_b'").drop("which_diff")

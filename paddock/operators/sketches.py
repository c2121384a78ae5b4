"""Distinct counts that can be refreshed: sketches per part of a table, merged for any set of parts.

A sketch of one round is stored beside its exact count; a count over many rounds merges the
stored sketches and reads no rows. The error of a merged sketch is that of one sketch over
all rows: its relative standard error is about 0.8 / sqrt(2 ** precision).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of the register number: 16 KB per sketch at most, standard error 0.7 %.
PRECISION = 14
SKETCH = "sketch"
EXACT = "exact"


def standard_error(precision: int = PRECISION) -> float:
    """Relative standard error of an estimate."""
    return 0.83 / 2 ** (precision / 2)


def sketch_by(df: DataFrame, keys: Sequence[str], column: str, precision: int = PRECISION) -> DataFrame:
    """Per group: the exact number of distinct values (NULL is none) and a sketch of them.

    Distinct values are taken first, partly before the shuffle, so no group's rows meet in one
    task; an empty group of NULLs has a count of 0.
    """
    distinct = df.select(*keys, column).distinct()
    # a sketch of numbers and text only; other types by their text
    kind = df.schema[column].dataType.simpleString()
    value = F.col(column) if kind in ("int", "bigint", "string", "binary") else F.col(column).cast("string")
    return distinct.groupBy(*keys).agg(
        F.count(column).alias(EXACT), F.hll_sketch_agg(value, F.lit(precision)).alias(SKETCH)
    )


def merged(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser groups, one for all rows without ``keys``; the exact counts do not add up and are left out."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg(SKETCH).alias(SKETCH))


def estimate(sketch: str | Column = SKETCH) -> Column:
    """Estimated number of distinct values."""
    return F.hll_sketch_estimate(sketch)

"""Borders that cut rows into parts of about equal size, taken from the data inside the plan.

The borders are a scalar subquery: a bounded sample of the values (the rows of
the smallest hashes, so a repeated plan takes the same ones), its quantiles as
an array. Nothing runs before the plan does, and no value goes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: Sampled values for each border.
SAMPLED = 64
_CUTS = "_borders_of_parts"
#: Parts a table is cut into at least.
LEAST_PARTS = 32


def default_parts(df: DataFrame) -> int:
    """As many parts as shuffles have partitions: none is larger than a fair share of all rows."""
    return max(LEAST_PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def borders(
    df: DataFrame, column: str, parts: int, unique: Sequence[str] = (), sampled: int = SAMPLED
) -> DataFrame:
    """One row, ``borders``: at most ``parts - 1`` values of ``column``, rising, none null, each once.

    ``unique`` names columns that tell rows of an equal value apart, so that a
    frequent value is as frequent in the sample, which has ``sampled`` rows for each part. A table without values has no borders.
    """
    hashed = df.where(F.col(column).isNotNull()).select(
        F.col(column).alias("value"), F.xxhash64(*dict.fromkeys([column, *unique])).alias("hash")
    )
    sample = hashed.orderBy("hash", "value").limit(sampled * parts).agg(F.sort_array(F.collect_list("value")).alias("sample"))
    place = lambda i: F.floor(i * F.size("sample") / parts).cast("int")
    quantiles = F.transform(F.sequence(F.lit(1), F.lit(max(parts - 1, 1))), lambda i: F.get("sample", place(i)))
    return sample.select(F.array_sort(F.array_distinct(F.filter(quantiles, lambda v: v.isNotNull()))).alias("borders"))


def with_part(
    df: DataFrame, column: str, cuts: DataFrame, parts: int, name: str, on_border: str | None = None
) -> DataFrame:
    """The rows with the number of borders that are not above their value (null: null).

    A binary search, one comparison for each halving, in generated code. ``on_border``
    names a column that tells whether the value is a border itself.
    """
    found = df.withColumns({_CUTS: cuts.scalar(), name: F.when(F.col(column).isNotNull(), 0)})
    step = 1 << max(parts - 1, 1).bit_length() - 1
    while step:
        reached = F.get(_CUTS, F.col(name) + (step - 1)) <= F.col(column)
        found = found.withColumn(name, F.when(reached, F.col(name) + step).otherwise(F.col(name)))
        step //= 2
    if on_border is not None:
        same = F.get(_CUTS, F.col(name) - 1) == F.col(column)
        found = found.withColumn(on_border, F.coalesce(same, F.lit(False)))
    return found.drop(_CUTS)

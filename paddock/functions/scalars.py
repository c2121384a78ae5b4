"""Null-safe arithmetic, keys, buckets and conversions as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

# Fixed value: stands for NULL inside a surrogate key.
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"


def _columns(fields: Sequence) -> list[Column]:
    if isinstance(fields, str) or not isinstance(fields, Sequence):
        raise TypeError("fields must be a list of columns")
    return [F.col(f) if isinstance(f, str) else f for f in fields]


def _zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def safe_add(fields: Sequence) -> Column:
    """Sum with NULL as 0."""
    return reduce(lambda a, b: a + b, [_zero(c) for c in _columns(fields)])


def safe_subtract(fields: Sequence) -> Column:
    """First field minus the others, with NULL as 0."""
    return reduce(lambda a, b: a - b, [_zero(c) for c in _columns(fields)])


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL for a zero or NULL denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def round_half_up(value: Column, digits: int) -> Column:
    """Value rounded as a decimal, half away from zero.

    The cast keeps ten decimals, so noise in the last bits of a mean does not decide a tie.
    """
    return F.round(value.cast("decimal(28, 10)"), digits).cast("double")


def surrogate_key(fields: Sequence, nulls_as_empty: bool = False) -> Column:
    """MD5 of the fields as text, joined by ``-``."""
    token = F.lit("" if nulls_as_empty else NULL_KEY_TOKEN)
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), token) for c in _columns(fields)]))


def with_surrogate_key(
    df: DataFrame, fields: Sequence, name: str = "surrogate_key", nulls_as_empty: bool = False
) -> DataFrame:
    return df.withColumn(name, surrogate_key(fields, nulls_as_empty))


def key_collisions(df: DataFrame, fields: Sequence[str], nulls_as_empty: bool = False) -> DataFrame:
    """Keys shared by more than one combination of the fields."""
    combinations = df.select(*fields).distinct()
    keyed = with_surrogate_key(combinations, list(fields), "surrogate_key", nulls_as_empty)
    return keyed.groupBy("surrogate_key").agg(F.count(F.lit(1)).alias("combinations")).where("combinations > 1")


def width_bucket(value: Column, low: float, high: float, buckets: int, count_multiples: bool = False) -> Column:
    """Bucket 1..n of equal width, 0 below ``low`` and n + 1 from ``high`` on.

    With ``count_multiples`` as dialects without the function count: the rounded-up number of
    widths above ``low``, at most n + 1, and one more for a multiple of the width. The two
    agree inside buckets; they differ at edges where ``low`` is no multiple of the width, below
    ``low`` (0 and less), and for multiples above ``high`` (n + 2).
    """
    if count_multiples:
        width = (high - low) / buckets
        exact = lambda c: c.cast("decimal(28, 10)")
        on_multiple = (exact(value) % exact(F.lit(width)) == 0).cast("int")
        widths = F.ceil((value.cast("double") - low) / width)
        return on_multiple + F.least(widths, F.lit(buckets + 1).cast("long"))
    return F.width_bucket(value.cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(buckets))


def histogram(df: DataFrame, column: str, low: float, high: float, buckets: int) -> DataFrame:
    """Rows per bucket."""
    bucket = width_bucket(F.col(column), low, high, buckets).alias("bucket")
    return df.groupBy(bucket).agg(F.count(F.lit(1)).alias("rows"))


def to_seconds(milliseconds: Column, digits: int | None = None) -> Column:
    seconds = milliseconds / 1000.0
    return seconds if digits is None else round_half_up(seconds, digits)


def bool_to_text(column: Column) -> Column:
    return column.cast("boolean").cast("string")


def as_text(df: DataFrame, name: str) -> Column:
    """A column as text, booleans as 'true' and 'false'."""
    column = F.col(name)
    return bool_to_text(column) if isinstance(df.schema[name].dataType, T.BooleanType) else column.cast("string")


def add_parts(column: Column, part: str, count: Column) -> Column:
    """Timestamp or date shifted by ``count`` parts (day, hour, month, ...)."""
    return F.timestamp_add(part.upper(), count, column)


def diff_parts(part: str, start: Column, end: Column) -> Column:
    """Whole parts from start to end."""
    return F.timestamp_diff(part.upper(), start, end)

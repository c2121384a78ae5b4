"""First row per key, frequent values, single values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """First row of each key in the given order.

    Each map task keeps only its first row per key before the shuffle (Spark plans a
    partial WindowGroupLimit), so a huge group never travels to one task.
    """
    first = F.row_number().over(W.partitionBy(*partition_by).orderBy(*order_by))
    return df.withColumn("_rn", first).where(F.col("_rn") == 1).drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Values of the row with the highest order per key, by a partial aggregate and no sort."""
    newest = F.max_by(F.struct(*values), F.struct(*order_by)).alias("_latest")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_latest.{v}").alias(v) for v in values])


def column_values(
    df: DataFrame,
    column: str,
    order_by: Sequence[Column] | None = None,
    max_records: int | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """Distinct values with their counts as (value, n), most frequent first unless ``order_by`` is given.

    ``order_by`` may use ``value`` and ``n``.
    """
    rows = df if where is None else df.where(where)
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(*(order_by or [F.desc("n"), F.asc("value")]))
    return ordered if max_records is None else ordered.limit(max_records)


def column_value_list(df: DataFrame, column: str, max_records: int, default: list | None = None, **options) -> list:
    """The first ``max_records`` values as a list; ``default`` if there are none."""
    values = [r["value"] for r in column_values(df, column, max_records=max_records, **options).collect()]
    return values if values else default


def pivot_values(df: DataFrame, column: str, at_most: int = 1000) -> list:
    """All values of a column that becomes columns; raises when there are more than ``at_most``."""
    values = column_value_list(df, column, at_most + 1, default=[])
    if len(values) > at_most:
        raise ValueError(f"{column} has more than {at_most} values")
    return values


def single_value(source: DataFrame, order_by: Sequence[Column | str], default: object = None) -> DataFrame:
    """One row with the first column of the first row, or the default if there is none."""
    name = source.columns[0]
    top = source.orderBy(*order_by).select(F.struct(F.col(name).alias("v")).alias("s")).limit(1)
    found = top.agg(F.first("s").alias("s"))
    return found.select(F.when(F.col("s").isNotNull(), F.col("s.v")).otherwise(F.lit(default)).alias(name))


def with_single_value(
    df: DataFrame, source: DataFrame, order_by: Sequence[Column | str], name: str, default: object = None
) -> DataFrame:
    """Every row with the first value of another query, read as a scalar subquery."""
    return df.withColumn(name, single_value(source, order_by, default).scalar())

"""Grouping helpers: group by leading columns, pivot, proportions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, GroupedData, functions as F

from paddock.operators.projection import slugify


def group_by_first(df: DataFrame, n: int) -> GroupedData:
    """Group by the first ``n`` columns."""
    return df.groupBy(*df.columns[:n])


def not_null_share(column: str) -> Column:
    """Share of rows in which the column is not NULL."""
    return F.avg(F.when(F.col(column).isNotNull(), 1.0).otherwise(0.0))


# Comparison operators of a pivot.
COMPARE: dict[str, Callable[[Column, object], Column]] = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "like": lambda c, v: c.like(v),
    "ilike": lambda c, v: c.ilike(v),
}


def pivot_columns(
    column: str,
    values: Sequence,
    agg: Callable[[Column], Column] = F.sum,
    compare: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: object = 1,
    else_value: object = 0,
    quote_names: bool = True,
    distinct: bool = False,
    alias: bool = True,
) -> list[Column]:
    """One conditional aggregate per value, for ``groupBy(...).agg(*...)``.

    Without ``alias`` the columns keep the names Spark gives the expressions. ``then_value`` and ``else_value`` may be columns. Without ``quote_names`` the column
    names are slugified. ``distinct`` works with sum and count.
    """
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    if distinct:
        try:
            agg = {"sum": F.sum_distinct, "count": F.count_distinct}[agg.__name__]
        except KeyError:
            raise ValueError("distinct is supported for sum and count") from None
    name = (lambda v: f"{prefix}{v}{suffix}") if quote_names else (lambda v: slugify(f"{prefix}{v}{suffix}"))
    test = COMPARE[compare]
    cases = [agg(F.when(test(F.col(column), v), lit(then_value)).otherwise(lit(else_value))) for v in values]
    return [case.alias(name(v)) if alias else case for case, v in zip(cases, values)]


def pivot(df: DataFrame, keys: Sequence[str], column: str, values: Sequence, **options) -> DataFrame:
    """Values of ``column`` as columns: one scan, partial aggregation per group."""
    return df.groupBy(*keys).agg(*pivot_columns(column, values, **options))

"""Past-only features: frames that end one row before the current one.

The histories run over rows that are unique per race (driver x race, or team x race
after an aggregate), so a window partition never has more rows than there were races,
whatever the size of the tables. For orders without such a bound use
``paddock.operators.ordered``, which cuts groups of any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window as W, WindowSpec, functions as F

SEASON_ORDER = ("season", "round_number")


def prior(keys: Sequence[str], order: Sequence[str] = SEASON_ORDER, last: int | None = None) -> WindowSpec:
    """Rows before the current one, all of them or the ``last`` n."""
    start = W.unboundedPreceding if last is None else -last
    return W.partitionBy(*keys).orderBy(*order).rowsBetween(start, -1)


def prior_count(window: WindowSpec) -> Column:
    return F.count(F.lit(1)).over(window)


def prior_count_if(condition: Column, window: WindowSpec) -> Column:
    return F.count(F.when(condition, 1)).over(window)


def prior_sum(value: Column, window: WindowSpec) -> Column:
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def prior_avg(value: Column, window: WindowSpec, default: float = 0.0) -> Column:
    return F.coalesce(F.avg(value).over(window), F.lit(default))


def prior_stddev(value: Column, window: WindowSpec) -> Column:
    return F.stddev(value).over(window)


def prior_rate(hits: Column, total: Column) -> Column:
    """Share of earlier rows that hit, 0 without earlier rows."""
    return F.when(total > 0, hits.cast("double") / total).otherwise(F.lit(0.0))

"""Slowly changing dimensions, type 2."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from paddock.operators.topk import latest_per_key

# Names of the snapshot columns.
SCD_ID = "scd_id"
UPDATED_AT = "updated_at"
VALID_FROM = "valid_from"
VALID_TO = "valid_to"
SNAPSHOT_COLUMNS = [SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO]


def driver_teams(results: DataFrame) -> DataFrame:
    """One row per driver and team with the smallest name."""
    return results.groupBy("driver_abbr", "team_name").agg(F.min("driver_name").alias("driver_name"))


def current_driver_teams(results: DataFrame) -> DataFrame:
    """One row per driver: the team of the latest race. Input of the snapshot, which needs unique keys."""
    return latest_per_key(results, ["driver_abbr"], ["season", "round_number"], ["team_name", "driver_name"])


def _scd_id(keys: Sequence[str], at: Column) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], at.cast("string")))


def first_snapshot(incoming: DataFrame, keys: Sequence[str], at: Column) -> DataFrame:
    """Snapshot in which every incoming row is open since ``at``."""
    return incoming.withColumns(
        {SCD_ID: _scd_id(keys, at), UPDATED_AT: at, VALID_FROM: at, VALID_TO: F.lit(None).cast("timestamp")}
    )


def snapshot_merge(
    history: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    at: Column,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """The history after comparing its open rows with ``incoming``.

    A changed row is closed at ``at`` and opened again with the new values, a new key is
    opened, a vanished key is closed if asked for. Closed rows pass through untouched; only
    open rows take part in the join.
    """
    columns = incoming.columns
    fresh = incoming.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in columns if c not in keys], F.lit(True).alias("_arrived")
    )
    closed = history.where(F.col(VALID_TO).isNotNull())
    open_rows = history.where(F.col(VALID_TO).isNull()).withColumn("_known", F.lit(True))
    both = open_rows.join(fresh, list(keys), "full")
    arrived, known = F.col("_arrived").isNotNull(), F.col("_known").isNotNull()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in check_cols])
    changed = arrived & known & ~same
    ends = changed | (known & ~arrived) if invalidate_hard_deletes else changed
    old_values = [F.col(c) for c in history.columns if c != VALID_TO]
    old = F.struct(*old_values, F.when(ends, at).alias(VALID_TO))
    opened = F.struct(
        *[F.col(c if c in keys else f"_new_{c}").alias(c) for c in columns],
        _scd_id(keys, at).alias(SCD_ID),
        at.alias(UPDATED_AT),
        at.alias(VALID_FROM),
        F.lit(None).cast("timestamp").alias(VALID_TO),
    )
    order = history.columns
    shaped = lambda s: F.struct(*[s[c].alias(c) for c in order])
    versions = F.filter(
        F.array(F.when(known, shaped(old)), F.when(changed | (arrived & ~known), shaped(opened))),
        lambda v: v.isNotNull(),
    )
    return closed.select(*order).unionByName(both.select(F.explode(versions).alias("v")).select("v.*"))


def history_from_facts(
    facts: DataFrame,
    key: str,
    value: str,
    order: Sequence[str] = ("season", "round_number"),
) -> DataFrame:
    """Validity intervals of ``value`` per key, read off ordered facts (gaps and islands).

    Gives key, value, the first and last order position of each stretch, and the position at
    which the next one starts (NULL for the open one). A key has at most one row for each
    position (a driver one for each race), so one window over the key serves all steps: the
    facts are read and shuffled once.
    """
    position = F.struct(*order)
    of_key = W.partitionBy(key).orderBy(*order)
    here = F.struct(F.col(value).alias("v"), position.alias("p"))
    previous = facts.select(key, value, *order).withColumns(
        {"_prev": F.lag(here).over(of_key), "_newest": F.max(position).over(W.partitionBy(key))}
    )
    starts = previous.where(F.col("_prev").isNull() | ~F.col("_prev.v").eqNullSafe(F.col(value)))
    start = F.struct(position.alias("p"), F.col("_prev.p").alias("last"))
    named = starts.withColumn("_next", F.lead(start).over(of_key)).select(
        key,
        value,
        position.alias("_from"),
        F.coalesce("_next.last", "_newest").alias("_last"),
        F.col("_next.p").alias("_to"),
    )
    return named.select(
        key,
        value,
        *[F.col(f"_from.{c}").alias(f"from_{c}") for c in order],
        *[F.col(f"_last.{c}").alias(f"last_{c}") for c in order],
        *[F.col(f"_to.{c}").alias(f"to_{c}") for c in order],
    )

"""Joins that reduce the repeated side before the shuffle.

Catalyst and AQE choose broadcast or sort-merge from measured sizes and split skewed
partitions; what they cannot know is that only the distinct keys of one side matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paddock.operators.borders import default_parts


def semi_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of left whose key occurs in right."""
    return left.join(right.select(*keys).distinct(), list(keys), "left_semi")


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of left whose key does not occur in right."""
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")


def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """Rows of a child table without a partner, where any key may hold most of the rows.

    The distinct keys of the child, with their counts, are joined; then rows go by their key.
    Frequent keys are those with more than 1 / ``parts`` of the rows, so there are fewer than
    ``parts`` of them: they are broadcast and decide over their rows in place. Only rows of
    other keys are shuffled, to the keys that were lost. NULL keys have no partner.
    """
    frequent, lost, rest = _by_frequency(child, parent, keys, parts)
    kept = frequent.where("_lost").drop("_key", "_lost")
    return kept.unionAll(rest.join(lost, "_key", "left_semi").select(*child.columns))


def _by_frequency(
    child: DataFrame, parent: DataFrame, keys: Sequence[str], parts: int | None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of frequent keys with ``_lost``, the other keys that are lost, and the rows of these and of found ones."""
    parts = default_parts(child) if parts is None else parts
    # NULLs in a struct equal each other
    key = F.struct(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    counted = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    partners = parent.select(*keys).distinct().withColumn("_found", F.lit(True))
    judged = counted.join(partners, list(keys), "left").select(
        key.alias("_key"), "_n", F.col("_found").isNull().alias("_lost")
    )
    share = child.agg(F.count(F.lit(1)) / parts).scalar()
    frequent_keys = F.broadcast(judged.where(F.col("_n") > share).select("_key", "_lost"))
    marked = child.withColumn("_key", key).join(frequent_keys, "_key", "left").select(*child.columns, "_key", "_lost")
    lost = judged.where((F.col("_n") <= share) & F.col("_lost")).select("_key")
    return marked.where("_lost IS NOT NULL"), lost, marked.where("_lost IS NULL")


def aggregate_then_join(
    left: DataFrame, many: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], how: str = "left"
) -> DataFrame:
    """Left joined to aggregates of the many side, which is reduced to one row per key first."""
    return left.join(many.groupBy(*keys).agg(*aggregates), list(keys), how)


def compare_counts(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts of both frames per key, with keys of either side."""
    counts = lambda df, name: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return counts(a, "rows_a").join(counts(b, "rows_b"), list(keys), "full")

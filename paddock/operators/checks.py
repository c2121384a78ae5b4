"""Data checks. A check returns the rows that break a rule; no rows means it passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paddock.functions.scalars import add_parts
from paddock.operators.aggregates import not_null_share
from paddock.operators import reconcile
from paddock.operators.joins import orphans
from paddock.operators.ordered import shifted
from paddock.operators.sets import both_differences, sides


def accepted_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    """Values outside the range; NULL passes, a missing bound is no bound."""
    return df.where(outside_range(F.col(column), low, high, inclusive))


def outside_range(value: Column, low=None, high=None, inclusive: bool = True) -> Column:
    outside = F.lit(False)
    if low is not None:
        outside = outside | (value < low if inclusive else value <= low)
    if high is not None:
        outside = outside | (value > high if inclusive else value >= high)
    return outside


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups without any non-NULL value."""
    return df.groupBy(*group_by).agg(F.count(column).alias("non_null")).where("non_null = 0")


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Values whose number of rows differs between two columns."""
    counts = sides(df.select(F.col(column).alias("value")), to.select(field))
    differing = counts.where(F.col("_left") != F.col("_right"))
    found = differing.select("value", F.explode(F.array("_left", "_right")).alias("num_rows"))
    return found.where("num_rows > 0")


def _paired_counts(df: DataFrame, compare: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Row counts of both frames per group, groups matched by equality (a NULL group never matches)."""
    group = [F.col(g) for g in group_by] or [F.lit(1).alias("_all")]
    names = list(group_by) or ["_all"]
    a = df.groupBy(*group).agg(F.count(F.lit(1)).alias("count_a"))
    b = compare.groupBy(*group).agg(F.count(F.lit(1)).alias("count_b"))
    a = a.withColumnsRenamed({n: f"{n}_a" for n in names})
    b = b.withColumnsRenamed({n: f"{n}_b" for n in names})
    condition = F.lit(True)
    for n in names:
        condition = condition & (F.col(f"{n}_a") == F.col(f"{n}_b"))
    joined = a.join(b, condition, "full")
    return joined.drop("_all_a", "_all_b")


def equal_rowcount(
    df: DataFrame, compare: DataFrame, group_by: Sequence[str] = (), count_missing: bool = False
) -> DataFrame:
    """Row counts per group with ``diff_count``; the metric is its sum.

    A group that only one frame has counts as no difference unless ``count_missing``.
    """
    pairs = _paired_counts(df, compare, group_by)
    a, b = F.col("count_a"), F.col("count_b")
    if count_missing:
        a, b = F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))
    return pairs.withColumn("diff_count", F.abs(a - b))


def fewer_rows_than(
    df: DataFrame, compare: DataFrame, group_by: Sequence[str] = (), count_missing: bool = False
) -> DataFrame:
    """Row counts per group with ``row_count_delta``: the surplus, 1 when equal, else 0."""
    pairs = _paired_counts(df, compare, group_by)
    a, b = F.col("count_a"), F.col("count_b")
    if count_missing:
        a, b = F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))
    return pairs.withColumn(
        "row_count_delta", F.when(a > b, a - b).when(a == b, F.lit(1)).otherwise(F.lit(0)).cast("long")
    )


def equality(
    df: DataFrame,
    compare: DataFrame,
    columns: Sequence[str] | None = None,
    keep_duplicates: bool = False,
    range_key: str | None = None,
) -> DataFrame:
    """Rows on one side only, with ``which_diff``; duplicates count only if asked for.

    With a ``range_key`` digests of its ranges are compared first, and only ranges that differ by rows.
    """
    chosen = df.columns if columns is None else list(columns)
    if range_key is not None:
        return reconcile.both_differences(df.select(*chosen), compare.select(*chosen), range_key, keep_duplicates)
    return both_differences(df.select(*chosen), compare.select(*chosen), keep_duplicates)


def equality_metric(differences: DataFrame) -> DataFrame:
    """Number of differing rows plus the imbalance between the sides."""
    side = lambda label: F.count_if(F.col("which_diff") == label)
    return differences.agg((F.count(F.lit(1)) + F.abs(side("a_minus_b") - side("b_minus_a"))).alias("metric"))


def expression_is_true(df: DataFrame, expression: str | Column, column: str | None = None) -> DataFrame:
    """Rows for which the expression is false; NULL passes. With ``column`` the text follows its name."""
    text = expression if column is None else f"`{column}` {expression}"
    return df.where(~(F.expr(f"({text})") if isinstance(text, str) else text))


# How an upper bound must compare to the next lower bound.
_GAPS = {
    "not_allowed": lambda upper, following: upper == following,
    "allowed": lambda upper, following: upper <= following,
    "required": lambda upper, following: upper < following,
}


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str | Column,
    upper: str | Column,
    partition_by: str | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
) -> DataFrame:
    """Ranges that overlap the next one, leave a forbidden gap, or are empty or open."""
    if gaps not in _GAPS:
        raise ValueError(f"gaps must be one of {sorted(_GAPS)}, got {gaps!r}")
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    keys = [] if partition_by is None else ["partition_by_col"]
    named = [] if partition_by is None else [F.col(partition_by).alias("partition_by_col")]
    ranges = df.select(*named, as_column(lower).alias("lower_bound"), as_column(upper).alias("upper_bound"))
    # open bounds come last
    marked = ranges.withColumns({"_open": F.col("lower_bound").isNull(), "_endless": F.col("upper_bound").isNull()})
    order = ["_open", "lower_bound", "_endless", "upper_bound"]
    following = shifted(marked, keys, order, {"_next": F.struct(F.col("lower_bound").alias("v"))}, offset=-1)
    low, high, nxt = F.col("lower_bound"), F.col("upper_bound"), F.col("_next.v")
    ordered = low <= high if zero_length_range_allowed else low < high
    checked = following.select(
        *keys,
        "lower_bound",
        "upper_bound",
        nxt.alias("next_lower_bound"),
        F.col("_next").isNull().alias("is_last_record"),
        F.coalesce(ordered, F.lit(False)).alias("bounds_ordered"),
        F.coalesce(_GAPS[gaps](high, nxt), F.col("_next").isNull()).alias("next_follows"),
    )
    return checked.where(~(F.col("bounds_ordered") & F.col("next_follows")))


def not_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Distinct values that are on the ban list."""
    return df.where(F.col(column).isin(list(values))).select(F.col(column).alias("value_field")).distinct()


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups with exactly one distinct value."""
    return df.groupBy(*group_by).agg(F.count_distinct(column).alias("distinct_values")).where("distinct_values = 1")


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    """Empty strings, after trimming if asked for; NULL passes."""
    text = F.trim(column) if trim_whitespace else F.col(column)
    return df.select(text.alias(column)).where(F.col(column) == "")


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = ()
) -> DataFrame:
    """Groups whose share of non-NULL values is out of bounds."""
    share = df.groupBy(*group_by).agg(not_null_share(column).alias("not_null_proportion"))
    return share.where(~F.col("not_null_proportion").between(at_least, at_most))


def recency(
    df: DataFrame,
    field: str,
    datepart: str,
    interval: int,
    ignore_time: bool = False,
    group_by: Sequence[str] = (),
    as_of: Column | None = None,
) -> DataFrame:
    """Groups whose newest value is older than ``interval`` parts before now, or before ``as_of``."""
    kind = df.schema[field].dataType.simpleString()
    now = F.current_timestamp() if as_of is None else as_of
    threshold = add_parts(now, datepart, F.lit(-interval)).cast("date" if ignore_time else kind)
    newest = F.max(field).cast("date") if ignore_time else F.max(field)
    return (
        df.groupBy(*group_by)
        .agg(newest.alias("most_recent"))
        .withColumn("threshold", threshold)
        .where(F.col("most_recent") < F.col("threshold"))
    )


def relationships_where(
    df: DataFrame,
    column: str,
    to: DataFrame,
    field: str,
    from_condition: str | Column = "true",
    to_condition: str | Column = "true",
) -> DataFrame:
    """Non-NULL values without a partner in the other frame."""
    child = df.where(from_condition).where(F.col(column).isNotNull()).select(F.col(column).alias("id"))
    parent = to.where(to_condition).select(F.col(field).alias("id"))
    return orphans(child, parent, ["id"])


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Rows whose value is not the previous one plus the interval."""
    previous = f"previous_{column}"
    rows = df.select(*group_by, column)
    lagged = shifted(rows, list(group_by), [column], {previous: F.col(column)})
    step = F.lit(interval)
    expected = F.col(previous) + step if datepart is None else add_parts(F.col(previous), datepart, step)
    return lagged.where(~(F.col(column) == expected))


def unique_combination_of_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL is not counted."""
    return unique_combination_of_columns(df.where(F.col(column).isNotNull()), [column])


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their counts; NULL passes."""
    return (
        df.where(~F.col(column).isin(list(values)))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    """Rows in which two columns differ; a NULL on either side passes."""
    return df.where(F.col(actual) != F.col(expected))


def no_orphan_laps(laps: DataFrame, results: DataFrame) -> DataFrame:
    """Laps without a result of the same driver and race."""
    entry = ["season", "round_number", "driver_abbr"]
    return orphans(laps.select(*entry), results, entry)


def valid_finish_positions(results: DataFrame) -> DataFrame:
    """Results with a position outside 1 to 30, or one shared within the race."""
    spot = ["season", "round_number", "finish_position"]
    shared = (
        results.where(F.col("finish_position").isNotNull())
        .groupBy(*spot)
        .agg((F.count(F.lit(1)) > 1).alias("_shared"))
        .where("_shared")
    )
    flagged = results.select(*spot, "driver_abbr").join(shared, spot, "left")
    outside = outside_range(F.col("finish_position"), 1, 30)
    return flagged.where(F.coalesce(outside, F.lit(False)) | F.col("_shared").isNotNull()).drop("_shared")

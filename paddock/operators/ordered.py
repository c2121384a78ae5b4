"""Ordered computations that stay distributed when one group is huge.

A window sends each group to a single task. Here every group is cut into chunks along
its order, at borders taken from the data (``paddock.operators.borders``): no chunk has more
than a fair share of all rows, whatever the values look like. Windows run inside a chunk, one
row per chunk carries the result on, and the window over chunks is as short as the number of
chunks of a group. The same steps are taken for groups of any size; a caller whose groups are
bounded by what they mean (the laps of a driver in a race) uses a plain window instead.

Orders are lists of column names, ``-name`` for descending, with Spark's default place of
NULLs. Sums of doubles are taken over DECIMAL(38, 18), so they do not depend on the order in
which chunks are added; a value that does not fit raises an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import takewhile

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql import types as T

from paddock.operators.borders import borders, default_parts, with_part

KEY = "_key"
#: Rows between two cuts of a group for frames of a fixed number of rows.
BLOCK_ROWS = 100_000
_EXACT = "decimal(38, 18)"


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL keys match each other; keeps the left key columns."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys], F.lit(True))
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def _sorts(order: Sequence[str]) -> list[Column]:
    return [F.desc(name[1:]) if name.startswith("-") else F.asc(name) for name in order]


def _chunked(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int | None
) -> tuple[DataFrame, Column, Column]:
    """The rows with their chunk in ``_key``, the order of the chunks of a group, and the group.

    Chunks are cut along the leading order columns of one direction, taken together.
    """
    parts = default_parts(df) if parts is None else parts
    down = order[0].startswith("-")
    leading = [name.removeprefix("-") for name in takewhile(lambda name: name.startswith("-") == down, order)]
    # fields of a struct compare one after the other, NULL first, as the rows are ordered
    placed = df.withColumn("_at", F.struct(*leading))
    told_apart = [*keys, *[name.removeprefix("-") for name in order]]
    placed = with_part(placed, "_at", borders(placed, "_at", parts, told_apart), parts, "_chunk")
    # one struct, in which NULLs equal each other: the window and the join below use one shuffle
    own = placed.withColumn(KEY, F.struct(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_chunk"))
    if keys:
        group = F.struct(*[f"{KEY}._k{i}" for i in range(len(keys))])
    else:  # all chunks, one row each, belong together
        group = F.pmod(F.hash(f"{KEY}._chunk"), F.lit(1))
    chunk = F.col(f"{KEY}._chunk")
    return own.drop("_at", "_chunk"), chunk.desc() if down else chunk.asc(), group


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
    past_only: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """Running sums per group. ``order`` should be unique within a group.

    ``past_only`` leaves the current row out.
    """
    end = -1 if past_only else W.currentRow
    kinds = {n: df.select(c.alias(n)).schema[n].dataType for n, c in sums.items()}
    exact = {n: isinstance(kind, (T.DoubleType, T.FloatType)) for n, kind in kinds.items()}
    inputs = {f"_in_{n}": c.cast(_EXACT) if exact[n] else c for n, c in sums.items()}
    base, chunk_order, group = _chunked(df.withColumns(inputs), keys, order, parts)
    local = W.partitionBy(KEY).orderBy(*_sorts(order)).rowsBetween(W.unboundedPreceding, end)
    inside = base.withColumns({n: F.sum(f"_in_{n}").over(local) for n in sums})
    totals = base.groupBy(KEY).agg(*[F.sum(f"_in_{n}").alias(f"_t_{n}") for n in sums])
    before = W.partitionBy(group).orderBy(chunk_order).rowsBetween(W.unboundedPreceding, -1)
    carried = totals.select(KEY, *[F.sum(f"_t_{n}").over(before).alias(f"_c_{n}") for n in sums])

    def both(name: str) -> Column:
        own, earlier = F.col(name), F.col(f"_c_{name}")
        total = F.when(own.isNull(), earlier).when(earlier.isNull(), own).otherwise(own + earlier)
        return total.cast("double") if exact[name] else total

    return inside.join(carried, KEY).withColumns({n: both(n) for n in sums}).select(*df.columns, *sums)


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "row_number", parts: int | None = None
) -> DataFrame:
    """Row number per group, 1-based."""
    return running(df, keys, order, {name: F.lit(1).cast("long")}, parts=parts)


def shifted(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Column],
    offset: int = 1,
    parts: int | None = None,
) -> DataFrame:
    """Value of the previous (``offset`` 1) or next (``offset`` -1) row in the group."""
    if offset not in (1, -1):
        raise ValueError("offset must be 1 or -1")
    base, chunk_order, group = _chunked(df.withColumns({f"_in_{n}": c for n, c in values.items()}), keys, order, parts)
    local = W.partitionBy(KEY).orderBy(*_sorts(order))
    inside = base.withColumns({n: F.lag(f"_in_{n}", offset).over(local) for n in values}).withColumns(
        {
            "_enters": F.lag(F.lit(1), offset).over(local).isNull(),
            "_leaves": F.lag(F.lit(1), -offset).over(local).isNull(),
        }
    )
    across = W.partitionBy(group).orderBy(chunk_order)
    edges = inside.where("_leaves").select(KEY, *[f"_in_{n}" for n in values])
    carried = edges.select(KEY, *[F.lag(f"_in_{n}", offset).over(across).alias(f"_c_{n}") for n in values])
    both = {n: F.when(F.col("_enters"), F.col(f"_c_{n}")).otherwise(F.col(n)) for n in values}
    return inside.join(carried, KEY).withColumns(both).select(*df.columns, *values)


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    preceding: int,
    aggregates: Mapping[str, Column],
    block_rows: int = BLOCK_ROWS,
    parts: int | None = None,
) -> DataFrame:
    """Aggregates over the ``preceding`` rows before the current one (it is left out).

    Groups are cut by position into blocks of ``block_rows`` rows; the last ``preceding``
    rows of a block are also given to the next one. Every frame holds the same rows in the
    same order wherever the cuts are.
    """
    block = max(block_rows, preceding)
    placed = numbered(df, keys, order, "_pos", parts=parts)
    slot = F.col("_pos") % block
    spread = placed.withColumn("_home", F.floor(F.col("_pos") / block)).withColumn(
        "_block",
        F.explode(
            F.when(slot >= block - preceding, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))
        ),
    )
    frame = W.partitionBy("_block", *keys).orderBy("_pos").rowsBetween(-preceding, -1)
    return (
        spread.withColumns({n: c.over(frame) for n, c in aggregates.items()})
        .where(F.col("_block") == F.col("_home"))
        .select(*df.columns, *aggregates)
    )


def ranked(
    df: DataFrame, keys: Sequence[str], by: str, name: str = "rank", descending: bool = True, parts: int | None = None
) -> DataFrame:
    """Rank per group (ties share a rank and leave a gap).

    Ranks are computed on the distinct values and their counts, then joined back.
    """
    counts = df.groupBy(*keys, by).agg(F.count(F.lit(1)).alias("_n"))
    order = [f"-{by}" if descending else by]
    places = running(counts, keys, order, {"_ahead": F.col("_n")}, past_only=True, parts=parts)
    ranks = places.select(*keys, by, (F.coalesce("_ahead", F.lit(0)) + 1).cast("long").alias(name))
    return join_null_safe(df, ranks, [*keys, by], "inner").select(*df.columns, name)


#: Relative rank error of the sketches that enclose a median.
MEDIAN_ERROR = 1e-4


def exact_median(
    df: DataFrame, keys: Sequence[str], value: str, name: str, error: float = MEDIAN_ERROR
) -> DataFrame:
    """Exact continuous median per group, by counting.

    A mergeable quantile sketch gives each group an interval that holds its middle positions.
    Then values below the interval are counted and those inside, a share of some ``error`` of
    the group, are kept by value; the middle positions are found among them. Only sketches,
    counts and inner values are shuffled; no group is sorted or kept whole. NaN comes last.
    """
    narrow = df.select(*keys, F.col(value).alias("_v"))
    # a sketch takes no NaN
    ranked_as = F.when(F.isnan(F.col("_v").cast("double")), float("inf")).otherwise(F.col("_v").cast("double"))
    accuracy = int(1 / error)
    sides = F.lit([max(0.5 - 3 * error, 0.0), min(0.5 + 3 * error, 1.0)])
    enclosing = narrow.withColumn("_r", ranked_as).groupBy(*keys).agg(
        F.count("_v").alias("_total"), F.percentile_approx("_r", sides, accuracy).alias("_side")
    )
    placed = join_null_safe(narrow.withColumn("_r", ranked_as), enclosing, keys, "inner")
    inside = F.col("_r").between(F.col("_side")[0], F.col("_side")[1])
    # of values below the interval only the number matters; a group without values keeps its rows as one count
    counts = (
        placed.where(F.coalesce(F.col("_r") <= F.col("_side")[1], F.col("_total") == 0))
        .groupBy(*keys, F.when(inside, F.col("_v")).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"), F.first("_total").alias("_total"))
    )
    upto = counts.withColumn("_upto", F.sum("_n").over(W.partitionBy(*keys).orderBy("_v")))
    low, high = F.floor((F.col("_total") + 1) / 2), F.floor((F.col("_total") + 2) / 2)
    middle = [
        F.max(F.when((F.col("_upto") >= p) & (F.col("_upto") - F.col("_n") < p), F.col("_v"))) for p in (low, high)
    ]
    mid = (middle[0] + middle[1]) / 2
    outside = F.raise_error(F.lit("a sketch missed the median of a group; ask for a larger error")).cast("double")
    return upto.groupBy(*keys).agg(F.when(mid.isNull() & (F.max("_total") > 0), outside).otherwise(mid).alias(name))


def with_median(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Every row with the exact median of its group."""
    return join_null_safe(df, exact_median(df, keys, value, name), keys, "inner").select(*df.columns, name)

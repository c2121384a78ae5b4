"""Check suites: expectations on one table in one pass, options and verdicts around checks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from paddock.operators.checks import outside_range


@dataclass(frozen=True)
class Expectation:
    """One line of a suite.

    kind: row_count_between, column_exists, columns_match_set, not_null, between or
    compound_unique.
    """

    kind: str
    columns: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None

    @property
    def target(self) -> str:
        return ",".join(self.columns)


def row_count_between(low: float | None, high: float | None) -> Expectation:
    return Expectation("row_count_between", (), low, high)


def column_exists(column: str) -> Expectation:
    return Expectation("column_exists", (column,))


def columns_match_set(columns: Sequence[str]) -> Expectation:
    return Expectation("columns_match_set", tuple(columns))


def values_not_null(column: str) -> Expectation:
    return Expectation("not_null", (column,))


def values_between(column: str, low: float | None, high: float | None) -> Expectation:
    return Expectation("between", (column,), low, high)


def compound_unique(*columns: str) -> Expectation:
    return Expectation("compound_unique", columns)


_SCHEMA_ONLY = ("column_exists", "columns_match_set")


def _schema_problems(df: DataFrame, expectation: Expectation) -> int:
    have, want = {c.lower() for c in df.columns}, {c.lower() for c in expectation.columns}
    return len(want - have) if expectation.kind == "column_exists" else len(want ^ have)


def _line(expectation: Expectation, success: Column, observed: Column, unexpected: Column) -> Column:
    return F.struct(
        F.lit(expectation.kind).alias("check"),
        F.lit(expectation.target).alias("column"),
        success.alias("success"),
        observed.cast("long").alias("observed"),
        unexpected.cast("long").alias("unexpected_count"),
    )


def _row_metric(expectation: Expectation) -> Column:
    if expectation.kind == "row_count_between":
        return F.count(F.lit(1))
    value = F.col(expectation.columns[0])
    if expectation.kind == "not_null":
        return F.count_if(value.isNull())
    return F.count_if(outside_range(value, expectation.low, expectation.high))


def _missing(df: DataFrame, expectation: Expectation) -> bool:
    known = {c.lower() for c in df.columns}
    return expectation.kind not in _SCHEMA_ONLY and not {c.lower() for c in expectation.columns} <= known


def _fused(df: DataFrame, expectations: Sequence[Expectation]) -> list[Expectation]:
    """Expectations on rows and columns, which share one aggregate."""
    return [
        e for e in expectations if e.kind not in (*_SCHEMA_ONLY, "compound_unique") and not _missing(df, e)
    ]


def _row_metrics(fused: Sequence[Expectation]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[_row_metric(e).alias(f"m{i}") for i, e in enumerate(fused)]]


def counted_while_written(df: DataFrame, *metrics: Column) -> tuple[DataFrame, Callable[[], Mapping[str, int]]]:
    """The frame, whose next action also computes aggregates over its rows, and what gives these afterwards.

    Put it last before a write: there every task counts once, also when tasks or executors
    are lost. Rows of an empty frame are counted as 0.
    """
    observation = Observation(f"rows-{uuid.uuid4().hex}")
    return df.observe(observation, *metrics), lambda: observation.get


def suite_while_written(
    df: DataFrame, expectations: Sequence[Expectation]
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The frame, whose write also counts for the suite, and what makes the report of it from the stored table.

    Only uniqueness expectations read the stored table.
    """
    fused = _fused(df, expectations)
    watched, counts = counted_while_written(df, *_row_metrics(fused))
    return watched, lambda stored: run_suite(stored, expectations, counts())


def run_suite(
    df: DataFrame, expectations: Sequence[Expectation], counted: Mapping[str, int] | None = None
) -> DataFrame:
    """Report (check, column, success, observed, unexpected_count), one line per expectation.

    Schema expectations cost no job. All row and column expectations share one aggregate
    over the table, or none if they were ``counted`` while it was written; only each
    uniqueness expectation adds a grouping. A column that is missing fails its expectations.
    """
    lines, reports, fused = [], [], _fused(df, expectations)
    for expectation in expectations:
        missing = _missing(df, expectation)
        if expectation.kind in _SCHEMA_ONLY or missing:
            problems = 1 if missing else _schema_problems(df, expectation)
            lines.append(_line(expectation, F.lit(problems == 0), F.lit(len(df.columns)), F.lit(problems)))
        elif expectation.kind == "compound_unique":
            groups = df.groupBy(*expectation.columns).agg(F.count(F.lit(1)).alias("n"))
            repeated = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
            counts = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), repeated.alias("bad"))
            line = _line(expectation, F.col("bad") == 0, F.col("rows"), F.col("bad"))
            reports.append(counts.select(F.inline(F.array(line))))
    if counted is None:
        once = df.agg(*_row_metrics(fused))
    else:
        known = {name: int(counted.get(name, 0)) for name in ["rows", *[f"m{i}" for i in range(len(fused))]]}
        once = df.sparkSession.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in known.items()])
    for i, expectation in enumerate(fused):
        metric = F.col(f"m{i}")
        if expectation.kind == "row_count_between":
            off = outside_range(metric, expectation.low, expectation.high)
            lines.append(_line(expectation, ~off, metric, F.when(off, 1).otherwise(0)))
        else:
            lines.append(_line(expectation, metric == 0, F.col("rows"), metric))
    if lines:
        reports.insert(0, once.select(F.inline(F.array(*lines))))
    return reduce(DataFrame.unionByName, reports)


class SuiteFailed(Exception):
    """Raised when a suite has failed lines; carries them."""

    def __init__(self, failed: list):
        super().__init__(f"{len(failed)} expectations failed: {failed}")
        self.failed = failed


def enforce(report: DataFrame) -> None:
    """Raise if a line of the report failed. A report has one row per expectation."""
    failed = [row.asDict() for row in report.where(~F.col("success")).collect()]
    if failed:
        raise SuiteFailed(failed)


def evaluate(
    check,
    df: DataFrame,
    *args,
    where: str | Column | None = None,
    fail_calc: str = "count(*)",
    warn_if: str = "!= 0",
    error_if: str = "!= 0",
    **kwargs,
) -> DataFrame:
    """Run a check on the rows that pass ``where`` and judge its metric: (metric, verdict).

    ``fail_calc`` is an aggregate over the violating rows; the thresholds are comparisons
    such as ``"> 10"``.
    """
    rows = df if where is None else df.where(where)
    metric = check(rows, *args, **kwargs).agg(F.coalesce(F.expr(fail_calc), F.lit(0)).cast("long").alias("metric"))
    verdict = F.when(F.expr(f"metric {error_if}"), "error").when(F.expr(f"metric {warn_if}"), "warn").otherwise("pass")
    return metric.withColumn("verdict", verdict)

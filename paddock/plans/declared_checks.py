"""The declared checks of all relations, counted while relations are written or with one aggregate each."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from paddock.operators.checks import no_orphan_laps, outside_range, valid_finish_positions
from paddock.operators.suite import (
    Expectation,
    column_exists,
    compound_unique,
    counted_while_written,
    row_count_between,
    values_between,
    values_not_null,
)
from paddock.plans.staging import RACE

# Columns that must not be NULL.
NOT_NULL = {
    "races": ["season", "round_number"],
    "results": ["driver_abbr", "round_number"],
    "lap_times": ["driver_abbr", "lap_number"],
    "stg_races": ["round_number"],
    "stg_results": ["driver_abbr", "round_number", "grid_position"],
    "stg_lap_times": ["driver_abbr", "lap_time_seconds"],
    "int_driver_cumulative_stats": ["driver_abbr", "round_number", "prev_cumulative_points", "dnf_rate"],
    "int_lap_analysis": ["driver_abbr", "round_number", "mean_lap_time"],
    "int_driver_race_features": [
        "driver_abbr",
        "round_number",
        "grid_log",
        "top3_rate",
        "dnf_rate",
        "team_reliability",
    ],
    "dim_drivers": ["driver_abbr", "driver_name", "current_team"],
    "dim_teams": ["team_name", "reliability_rate"],
    "dim_circuits": ["circuit_name", "country"],
    "fct_race_results": ["driver_abbr", "round_number", "season", "finish_position", "points"],
    "fct_championship_standings": ["driver_abbr", "round_number", "championship_position", "total_points"],
    "fct_driver_performance": ["driver_abbr", "wins", "podiums", "avg_finish"],
    "fct_race_summary": ["round_number", "winner", "total_starters", "total_dnfs"],
}

# Accepted ranges, both ends included.
RANGES = {
    "int_driver_cumulative_stats": {"dnf_rate": (0, 1)},
    "int_driver_race_features": {"top3_rate": (0, 1), "dnf_rate": (0, 1), "team_reliability": (0, 1)},
    "dim_teams": {"reliability_rate": (0, 1)},
    "dim_circuits": {"circuit_dnf_rate": (0, 1)},
    "fct_race_results": {"finish_position": (1, 30), "points": (0, 25)},
    "fct_championship_standings": {"championship_position": (1, 30), "total_points": (0, 1000)},
    "fct_driver_performance": {"wins": (0, 24), "podiums": (0, 72), "avg_finish": (1, 30)},
    "fct_race_summary": {"total_starters": (1, 30), "total_dnfs": (0, 30)},
}

# Keys that must be unique. A round number is unique within its season.
UNIQUE = {
    "races": RACE,
    "stg_races": RACE,
    "dim_drivers": ["driver_abbr"],
    "dim_teams": ["team_name"],
    "fct_race_summary": RACE,
}

# The expectations on the raw results of one season.
RAW_RESULTS_SUITE: list[Expectation] = [
    row_count_between(400, 600),
    column_exists("driver_abbr"),
    column_exists("round_number"),
    column_exists("finish_position"),
    column_exists("grid_position"),
    column_exists("points"),
    column_exists("is_dnf"),
    values_not_null("driver_abbr"),
    values_not_null("round_number"),
    values_not_null("finish_position"),
    values_between("finish_position", 1, 30),
    values_between("round_number", 1, 24),
    values_between("points", 0, 25),
    compound_unique("round_number", "driver_abbr"),
]


def _metric(relation: str, check: str, column: str, failures: Column) -> Column:
    return F.struct(
        F.lit(relation).alias("relation"),
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        F.coalesce(failures, F.lit(0)).cast("long").alias("failures"),
    )


def _failing(name: str) -> dict[tuple[str, str], Column]:
    """Conditions on a row under which it fails, by check and column."""
    failing = {("not_null", c): F.col(c).isNull() for c in NOT_NULL.get(name, ())}
    return failing | {
        ("accepted_range", c): outside_range(F.col(c), *bounds) for c, bounds in RANGES.get(name, {}).items()
    }


class RowChecks:
    """Counts the rows that fail the declared row checks of relations while these are written."""

    def __init__(self) -> None:
        self._counts: dict[str, Callable[[], Mapping[str, int]]] = {}

    def watch(self, df: DataFrame, *names: str) -> DataFrame:
        """The frame; its next write also counts for these relations, whose checked columns it holds in its rows."""
        for name in names:
            metrics = [F.count_if(bad).alias(f"m{i}") for i, bad in enumerate(_failing(name).values())]
            df, self._counts[name] = counted_while_written(df, *metrics)
        return df

    def found(self) -> dict[str, list[int]]:
        """Failing rows by relation, in the order of its checks; call it when all are written."""
        return {
            name: [int(counts.get(f"m{i}", 0)) for i in range(len(_failing(name)))]
            for name, counts in ((name, get()) for name, get in self._counts.items())
        }


def _column_checks(name: str, df: DataFrame, counted: list[int] | None) -> DataFrame:
    """All NOT NULL and range checks of a relation: in one aggregate, or as counted while it was written."""
    failing = _failing(name)
    if counted is None:
        counts = df.agg(*[F.count_if(bad).alias(f"m{i}") for i, bad in enumerate(failing.values())])
    else:
        counts = df.sparkSession.range(1).select(*[F.lit(n).alias(f"m{i}") for i, n in enumerate(counted)])
    lines = [_metric(name, check, column, F.col(f"m{i}")) for i, (check, column) in enumerate(failing)]
    return counts.select(F.inline(F.array(*lines)))


def _unique_check(name: str, df: DataFrame) -> DataFrame:
    keys = UNIQUE[name]
    counts = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    repeated = counts.agg(F.count_if(F.col("n") > 1).alias("bad"))
    return repeated.select(F.inline(F.array(_metric(name, "unique", ",".join(keys), F.col("bad")))))


def _row_check(name: str, check: str, violations: DataFrame) -> DataFrame:
    counted = violations.agg(F.count(F.lit(1)).alias("bad"))
    return counted.select(F.inline(F.array(_metric(name, check, "", F.col("bad")))))


def run_checks(relations: Mapping[str, DataFrame], counted: Mapping[str, list[int]] | None = None) -> DataFrame:
    """(relation, check, column, failures, verdict) for every declared check of the given relations.

    Relations ``counted`` while they were written (``RowChecks.found``) are not read again for
    their row checks.
    """
    known = counted or {}
    parts = [_column_checks(n, df, known.get(n)) for n, df in relations.items() if n in NOT_NULL]
    parts += [_unique_check(n, df) for n, df in relations.items() if n in UNIQUE]
    if {"stg_lap_times", "stg_results"} <= set(relations):
        laps, results = relations["stg_lap_times"], relations["stg_results"]
        parts.append(_row_check("stg_lap_times", "no_orphan_laps", no_orphan_laps(laps, results)))
        parts.append(_row_check("stg_results", "valid_finish_positions", valid_finish_positions(results)))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.withColumn("verdict", F.when(F.col("failures") == 0, "pass").otherwise("error"))

"""All relations of the product, from the raw tables to marts, checks and snapshot."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession

from paddock.operators import scd
from paddock.operators.suite import suite_while_written
from paddock.plans import declared_checks, features, marts, staging
from paddock.plans.declared_checks import RowChecks
from paddock.sources.catalog import read_raw
from paddock.session import remove, scratch_scope
from paddock.sources.sinks import materialize_table, read_version, versions
from paddock.sources.snapshots import write_snapshot

MARTS = [
    "dim_drivers",
    "dim_teams",
    "dim_circuits",
    "fct_race_results",
    "fct_championship_standings",
    "fct_driver_performance",
    "fct_race_summary",
]


def build(
    raw_races: DataFrame, raw_results: DataFrame, raw_laps: DataFrame, checks: RowChecks | None = None
) -> dict[str, DataFrame]:
    """Raw, staged, intermediate and mart relations by name.

    Parents that several relations read (staged tables, lap analysis, feature frame) are
    written once; everything else stays lazy. With ``checks`` these writes also count the rows
    that fail: raw races and results go into their staged table without a shuffle, so the same
    tasks see both; a feature frame has the rows and checked columns of both history relations.
    """
    watch = (lambda df, *names: df) if checks is None else checks.watch
    races = watch(staging.stg_races(watch(raw_races, "races")), "stg_races")
    results = watch(staging.stg_results(watch(raw_results, "results")), "stg_results")
    races = materialize_table(races, label="staged-races")
    results = materialize_table(results, label="staged-results")
    laps = materialize_table(watch(staging.stg_lap_times(raw_laps), "stg_lap_times"), label="staged-laps")
    analysis = features.int_lap_analysis(laps, results)
    analysis = materialize_table(watch(analysis, "int_lap_analysis"), label="analysis")
    frame = features.feature_frame(results, analysis)
    histories = ("int_driver_race_features", "int_driver_cumulative_stats")
    frame = materialize_table(watch(frame, *histories), label="features")
    return {
        "races": raw_races,
        "results": raw_results,
        "lap_times": raw_laps,
        "stg_races": races,
        "stg_results": results,
        "stg_lap_times": laps,
        "int_driver_cumulative_stats": features.int_driver_cumulative_stats(results),
        "int_lap_analysis": analysis,
        "int_driver_race_features": features.int_driver_race_features(frame),
        "dim_drivers": marts.dim_drivers(frame),
        "dim_teams": marts.dim_teams(results),
        "dim_circuits": marts.dim_circuits(races, results),
        "fct_race_results": marts.fct_race_results(frame, races),
        "fct_championship_standings": marts.fct_championship_standings(results),
        "fct_driver_performance": marts.fct_driver_performance(frame),
        "fct_race_summary": marts.fct_race_summary(races, results, analysis),
    }


def write_marts(
    relations: Mapping[str, DataFrame], root: str, checks: RowChecks | None = None
) -> dict[str, DataFrame]:
    """The relations with the marts stored as new versions of tables below ``root``.

    ``read_mart`` gives the newest version that is written in full, so a reader never meets
    half a table; the version before it stays for readers that have begun, older ones go. With
    ``checks`` the write of a mart also counts its failing rows.
    """
    watch = (lambda df, name: df) if checks is None else checks.watch
    return {n: _new_version(watch(df, n), f"{root}/{n}") if n in MARTS else df for n, df in relations.items()}


def _new_version(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    known = versions(spark, path)
    stored = materialize_table(df, f"{path}/version={known[-1] + 1 if known else 1}")
    for old in known[:-1]:
        remove(spark, f"{path}/version={old}")
    return stored


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """Newest version of a mart below ``root``, None before the first."""
    return read_version(spark, f"{root}/{name}")


def refresh_snapshot(results: DataFrame, path: str, at: Column | None = None) -> DataFrame:
    """Compare the drivers' current teams with the stored snapshot and store what changed."""
    return write_snapshot(scd.current_driver_teams(results), path, ["driver_abbr"], ["team_name"], at)


def refresh(spark: SparkSession, raw_root: str, root: str) -> dict[str, DataFrame]:
    """Models, declared checks, snapshot and raw suite over stored raw tables.

    Gives ``checks``, ``snapshot`` and ``suite``; the marts are stored below ``root``. Row
    checks and the row expectations of the suite are counted by the writes; only raw laps,
    uniqueness and orphans are read for their checks.
    """
    races, results, laps = (read_raw(spark, raw_root, name) for name in ("races", "results", "lap_times"))
    watched, suite_report = suite_while_written(results, declared_checks.RAW_RESULTS_SUITE)
    checks = RowChecks()
    with scratch_scope(spark):  # the shared parents are removed in the end
        relations = write_marts(build(races, watched, laps, checks), f"{root}/marts", checks)
        relations |= {"results": results, "races": races}
        report = declared_checks.run_checks(relations, checks.found())
        return {
            "checks": materialize_table(report, f"{root}/checks"),
            "snapshot": refresh_snapshot(relations["stg_results"], f"{root}/snapshots/driver_teams"),
            "suite": materialize_table(suite_report(results), f"{root}/suite"),
        }

"""Dimensions and facts.

The marts read one ``feature_frame`` instead of joining results, features and lap
analysis again on the entry key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from paddock.functions.scalars import round_half_up, safe_divide
from paddock.operators import sketches
from paddock.plans.features import FEATURES
from paddock.plans.staging import ENTRY, RACE


def _finished(condition):
    return F.count_if(condition & ~F.col("is_dnf"))


def dim_drivers(frame: DataFrame) -> DataFrame:
    """One row per driver, from ``feature_frame`` or the narrower ``driver_frame``."""
    return frame.groupBy("driver_abbr").agg(
        F.min("driver_name").alias("driver_name"),
        F.max_by("team_name", F.struct(*RACE)).alias("current_team"),
        round_half_up(F.avg("top3_rate"), 3).alias("career_top3_rate"),
        round_half_up(F.avg("dnf_rate"), 3).alias("career_dnf_rate"),
        round_half_up(F.avg("finish_consistency"), 3).alias("career_finish_consistency"),
    )


def dim_teams(results: DataFrame) -> DataFrame:
    finish = F.col("finish_position")
    return results.groupBy("team_name").agg(
        F.count(F.lit(1)).alias("total_race_entries"),
        _finished(finish == 1).alias("total_wins"),
        _finished(finish <= 3).alias("total_podiums"),
        F.count_if("is_dnf").alias("total_dnfs"),
        round_half_up(F.avg(F.when(F.col("is_dnf"), 0.0).otherwise(1.0)), 3).alias("reliability_rate"),
        F.sum("points").alias("total_constructor_points"),
    )


def dim_circuits(races: DataFrame, results: DataFrame) -> DataFrame:
    stats = results.groupBy(*RACE).agg(
        F.count_distinct("driver_abbr").alias("total_starters"), F.count_if("is_dnf").alias("dnf_count")
    )
    starters = F.coalesce("total_starters", F.lit(0)).cast("long")
    dnfs = F.coalesce("dnf_count", F.lit(0)).cast("long")
    return races.join(stats, RACE, "left").select(
        "circuit_name",
        "country",
        "race_name",
        F.col("round_number").alias("most_recent_round"),
        "race_date",
        starters.alias("total_starters"),
        dnfs.alias("dnf_count"),
        round_half_up(safe_divide(dnfs, starters), 3).alias("circuit_dnf_rate"),
    )


def fct_race_results(frame: DataFrame, races: DataFrame, with_history_pace: bool = False) -> DataFrame:
    """Results with race, same-race lap metrics and features.

    ``relative_pace`` is the gap in this race; the past-only feature of that name is added
    as ``relative_pace_hist`` on request.
    """
    named = races.select(*RACE, "race_name", "circuit_name", "country", "race_date")
    features = [F.col(c) for c in FEATURES if c != "relative_pace"]
    if with_history_pace:
        features.append(F.col("_hist_pace").alias("relative_pace_hist"))
    return (
        frame.withColumn("_hist_pace", F.col("relative_pace"))
        .join(named, RACE, "left")
        .select(
            *ENTRY,
            "team_name",
            "race_name",
            "circuit_name",
            "country",
            "race_date",
            "finish_position",
            "grid_position",
            "points",
            "is_dnf",
            "finish_category",
            "mean_lap_time",
            "lap_time_std",
            F.col("race_pace").alias("relative_pace"),
            *features,
        )
    )


def fct_championship_standings(results: DataFrame) -> DataFrame:
    """Running points per season and the rank in each race.

    A race is ranked on its distinct totals, of which there are at most (rounds x 25 + 1), so
    no task orders all its drivers; the ranks are joined back.
    """
    so_far = W.partitionBy("season", "driver_abbr").orderBy("round_number")
    totals = results.select(*ENTRY, "team_name", F.col("points").alias("race_points")).withColumn(
        "total_points", F.sum("race_points").over(so_far)
    )
    return race_positions(totals)


def race_positions(totals: DataFrame) -> DataFrame:
    """Entries with the rank of their ``total_points`` in the race."""
    drivers = totals.groupBy(*RACE, "total_points").agg(F.count(F.lit(1)).alias("_drivers"))
    better = W.partitionBy(*RACE).orderBy(F.desc("total_points")).rowsBetween(W.unboundedPreceding, -1)
    position = (F.coalesce(F.sum("_drivers").over(better), F.lit(0)) + 1).alias("championship_position")
    return totals.join(drivers.select(*RACE, "total_points", position), [*RACE, "total_points"]).select(
        *totals.columns, "championship_position"
    )


def fct_driver_performance(frame: DataFrame) -> DataFrame:
    finish = F.col("finish_position")
    classified = F.when(~F.col("is_dnf"), finish)
    return frame.groupBy("driver_abbr", "team_name").agg(
        F.count(F.lit(1)).alias("races_entered"),
        F.count_if(~F.col("is_dnf")).alias("races_finished"),
        _finished(finish <= 3).alias("podiums"),
        _finished(finish == 1).alias("wins"),
        F.sum("points").alias("total_points"),
        round_half_up(F.avg(classified), 2).alias("avg_finish"),
        round_half_up(F.avg("grid_position"), 2).alias("avg_grid"),
        round_half_up(F.avg("perf_vs_expected"), 2).alias("avg_perf_vs_expected"),
        round_half_up(F.avg("lap_time_consistency"), 2).alias("avg_lap_consistency"),
        round_half_up(F.avg("relative_pace"), 2).alias("avg_relative_pace"),
        round_half_up(F.stddev(classified), 2).alias("finish_stddev"),
        round_half_up(F.max("top3_rate"), 3).alias("final_top3_rate"),
        round_half_up(F.max("dnf_rate"), 3).alias("final_dnf_rate"),
    )


def fct_race_summary(races: DataFrame, results: DataFrame, lap_analysis: DataFrame) -> DataFrame:
    stats = results.groupBy(*RACE).agg(
        F.count_distinct("driver_abbr").alias("total_starters"),
        F.count_if("is_dnf").alias("total_dnfs"),
        round_half_up(F.avg(F.when(~F.col("is_dnf"), F.col("finish_position"))), 2).alias("avg_finish_position"),
    )
    first = F.min_by(F.struct("driver_abbr", "team_name"), "driver_abbr")
    winners = results.where(F.col("finish_position") == 1).groupBy(*RACE).agg(first.alias("_winner"))
    pace = lap_analysis.groupBy(*RACE).agg(
        round_half_up(F.min("mean_lap_time"), 3).alias("fastest_avg_pace"),
        round_half_up(F.avg("lap_time_std"), 3).alias("avg_lap_consistency"),
    )
    return (
        races.join(stats, RACE, "left")
        .join(pace, RACE, "left")
        .join(winners, RACE, "left")
        .select(
            *RACE,
            "race_name",
            "circuit_name",
            "country",
            "race_date",
            F.col("_winner.driver_abbr").alias("winner"),
            F.col("_winner.team_name").alias("winning_team"),
            "total_starters",
            "total_dnfs",
            "avg_finish_position",
            "fastest_avg_pace",
            "avg_lap_consistency",
        )
    )


def starters_by_round(results: DataFrame) -> DataFrame:
    """Exact number of starters of each round, and a sketch of them to be stored beside it."""
    return sketches.sketch_by(results, RACE, "driver_abbr")


def starters_by_season(stored: DataFrame) -> DataFrame:
    """Estimated number of different starters of each season, from the stored sketches of its rounds."""
    return sketches.merged(stored, ["season"]).select("season", sketches.estimate().alias("starters"))

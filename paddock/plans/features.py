"""Lap analysis and the past-only features of each driver in each race."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paddock.operators.history import (
    prior,
    prior_avg,
    prior_count,
    prior_count_if,
    prior_rate,
    prior_stddev,
    prior_sum,
)
from paddock.operators.ordered import running
from paddock.plans.staging import ENTRY, RACE, grid_log

# Fill values of features without history, and frame lengths in races.
FILL = {
    "finish_consistency": 5.0,
    "perf_vs_expected": 0.0,
    "lap_time_consistency": 3.0,
    "relative_pace": 5.0,
    "team_reliability": 0.9,
}
MOMENTUM_RACES = 5
ROLLING_RACES = 6
MIN_CLEAN_LAPS = 5
TOP_N = (3, 5, 10, 15)

CARRIED = [*ENTRY, "team_name", "finish_position", "grid_position", "points", "is_dnf"]


def lap_statistics(staged_laps: DataFrame, min_laps: int = MIN_CLEAN_LAPS) -> DataFrame:
    return (
        staged_laps.where(~F.col("is_outlier"))
        .groupBy(*ENTRY)
        .agg(
            F.count(F.lit(1)).alias("valid_laps"),
            F.avg("lap_time_seconds").alias("mean_lap_time"),
            F.stddev("lap_time_seconds").alias("lap_time_std"),
        )
        .where(F.col("valid_laps") >= min_laps)
    )


def int_lap_analysis(staged_laps: DataFrame, results: DataFrame, min_laps: int = MIN_CLEAN_LAPS) -> DataFrame:
    """Clean-lap statistics and the gap to the race winner's mean lap.

    Winners and leaders have about one row per race; adaptive execution broadcasts them by
    the size they turn out to have.
    """
    stats = lap_statistics(staged_laps, min_laps)
    winners = results.where(F.col("finish_position") == 1).select(*ENTRY)
    leader = stats.join(winners, ENTRY, "inner").select(*RACE, F.col("mean_lap_time").alias("leader_mean_lap_time"))
    return stats.join(leader, RACE, "left").select(
        *ENTRY,
        "valid_laps",
        "mean_lap_time",
        "lap_time_std",
        "leader_mean_lap_time",
        (F.col("mean_lap_time") - F.col("leader_mean_lap_time")).alias("relative_pace"),
    )


def team_history(results: DataFrame) -> DataFrame:
    """Per team and race: points of earlier races, and the share of them without a retirement."""
    races = results.groupBy("team_name", *RACE).agg(
        F.sum("points").alias("_points"), F.bool_or("is_dnf").cast("int").alias("_dnf")
    )
    before = prior(["team_name"])
    entries = prior_count(before)
    rate = 1.0 - F.sum("_dnf").over(before).cast("double") / entries
    return races.select(
        "team_name",
        *RACE,
        prior_sum(F.col("_points"), before).alias("prev_team_points"),
        F.when(entries > 0, rate).otherwise(F.lit(FILL["team_reliability"])).alias("team_reliability"),
    )


def with_team_history(
    results: DataFrame, mode: str = "races", history: DataFrame | None = None
) -> DataFrame:
    """Results with ``prev_team_points`` and ``team_reliability``.

    Mode ``races`` sums whole earlier races. Mode ``rows`` runs over single rows ordered by
    race and driver, so the second driver of a team also sees the first one's points of the
    same race. ``history`` is the ``team_history`` if the caller has it.
    """
    if mode not in ("races", "rows"):
        raise ValueError("mode must be 'races' or 'rows'")
    teams = team_history(results) if history is None else history
    joined = results.join(teams, ["team_name", *RACE], "left").withColumn(
        "prev_team_points", F.coalesce("prev_team_points", F.lit(0))
    )
    if mode == "races":
        return joined
    summed = running(
        joined.drop("prev_team_points"),
        ["team_name"],
        [*RACE, "driver_abbr"],
        {"prev_team_points": F.col("points")},
        past_only=True,
    )
    return summed.withColumn("prev_team_points", F.coalesce("prev_team_points", F.lit(0)))


def grid_expectations(results: DataFrame) -> DataFrame:
    """Mean finish of each grid slot, over races that were finished."""
    return (
        results.where(~F.col("is_dnf"))
        .groupBy("grid_position")
        .agg(F.avg("finish_position").alias("expected_finish"))
    )


def past_grid_expectations(results: DataFrame) -> DataFrame:
    """Mean finish of each grid slot over earlier races only."""
    races = (
        results.where(~F.col("is_dnf"))
        .groupBy("grid_position", *RACE)
        .agg(F.sum("finish_position").alias("_sum"), F.count("finish_position").alias("_n"))
    )
    before = prior(["grid_position"])
    return races.select(
        "grid_position", *RACE, (F.sum("_sum").over(before) / F.sum("_n").over(before)).alias("expected_finish")
    )


def _cumulative(frame: DataFrame, keys: list[str]) -> DataFrame:
    """History columns of a driver over the result rows of ``frame``."""
    window = prior(keys)
    finish, dnf = F.col("finish_position"), F.col("is_dnf")
    counts = {f"prev_top{n}_count": prior_count_if((finish <= n) & ~dnf, window) for n in TOP_N}
    counted = frame.withColumns(
        {
            "prev_races_started": prior_count(window),
            **counts,
            "prev_dnf_count": prior_count_if(dnf, window),
            "prev_cumulative_points": prior_sum(F.col("points"), window),
            "points_momentum": prior_avg(F.col("points"), prior(keys, last=MOMENTUM_RACES)),
            "finish_consistency": prior_stddev(F.when(~dnf, finish), prior(keys, last=ROLLING_RACES)),
        }
    )
    started = F.col("prev_races_started")
    return counted.withColumns(
        {
            **{f"top{n}_rate": prior_rate(F.col(f"prev_top{n}_count"), started) for n in TOP_N},
            "dnf_rate": prior_rate(F.col("prev_dnf_count"), started),
            "finish_consistency_filled": F.coalesce("finish_consistency", F.lit(FILL["finish_consistency"])),
        }
    )


def int_driver_cumulative_stats(results: DataFrame, team_mode: str = "races") -> DataFrame:
    """Past-only history of each driver; a driver has one row per race."""
    return _cumulative(with_team_history(results.select(*CARRIED), team_mode), ["driver_abbr"]).select(
        *CARRIED,
        "prev_races_started",
        *[f"prev_top{n}_count" for n in TOP_N],
        "prev_dnf_count",
        "prev_cumulative_points",
        "prev_team_points",
        "points_momentum",
        "finish_consistency",
        *[f"top{n}_rate" for n in TOP_N],
        "dnf_rate",
        "finish_consistency_filled",
    )


def driver_frame(results: DataFrame) -> DataFrame:
    """Result rows with the driver's own history, without team and lap columns."""
    return _cumulative(results, ["driver_abbr"]).withColumn("finish_consistency", F.col("finish_consistency_filled"))


def feature_frame(
    results: DataFrame, lap_analysis: DataFrame, as_of: bool = False, team_mode: str = "races"
) -> DataFrame:
    """Result rows with every feature and the same-race lap metrics.

    Results and lap analysis are joined once on the entry; then all driver histories share
    one shuffle on the driver. Rows that count for a history are told apart by a flag in the
    window partition, so each history still runs only over its own rows.
    """
    pace = F.col("relative_pace").alias("race_pace")
    laps = lap_analysis.select(*ENTRY, "mean_lap_time", "lap_time_std", pace, F.lit(True).alias("_has_laps"))
    slots = past_grid_expectations(results) if as_of else grid_expectations(results)
    slot_keys = ["grid_position", *RACE] if as_of else ["grid_position"]
    extra = [c for c in results.columns if c not in CARRIED and c != "grid_log"]
    entries = (
        with_team_history(results.select(*CARRIED, *extra), team_mode)
        .join(slots, slot_keys, "left")
        .withColumn("_has_result", F.lit(True))
    )
    both = entries.join(laps, ENTRY, "full").repartition("driver_abbr").withColumns(
        {
            "_has_result": F.coalesce("_has_result", F.lit(False)),
            "_has_laps": F.coalesce("_has_laps", F.lit(False)),
            "_finished": F.coalesce(~F.col("is_dnf"), F.lit(False)),
        }
    )
    lap_window = prior(["driver_abbr", "_has_laps"], last=ROLLING_RACES)
    finish_window = prior(["driver_abbr", "_finished"], last=ROLLING_RACES)
    surplus = F.col("expected_finish") - F.col("finish_position")
    features = _cumulative(both, ["driver_abbr", "_has_result"]).withColumns(
        {
            "perf_vs_expected": F.when(F.col("_finished"), F.avg(surplus).over(finish_window)),
            "lap_time_consistency": F.when(F.col("_has_laps"), F.avg("lap_time_std").over(lap_window)),
            "relative_pace": F.when(F.col("_has_laps"), F.avg("race_pace").over(lap_window)),
        }
    )
    filled = {c: F.coalesce(c, F.lit(FILL[c])) for c in FILL if c != "finish_consistency"}
    return (
        features.where("_has_result")
        .withColumns({**filled, "finish_consistency": F.col("finish_consistency_filled")})
        .withColumns(
            {
                "grid_log": grid_log(F.col("grid_position")),
                "driver_points": F.col("prev_cumulative_points"),
                "team_points": F.col("prev_team_points"),
            }
        )
    )


FEATURES = [
    "grid_log",
    *[f"top{n}_rate" for n in TOP_N],
    "finish_consistency",
    "perf_vs_expected",
    "lap_time_consistency",
    "relative_pace",
    "dnf_rate",
    "team_reliability",
    "driver_points",
    "team_points",
    "points_momentum",
]


def int_driver_race_features(frame: DataFrame) -> DataFrame:
    """The 14 features per driver and race, from ``feature_frame``."""
    return frame.select(*[c for c in CARRIED if c != "points"], *FEATURES)

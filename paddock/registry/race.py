"""Models, window histories and marts over the race view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from paddock.operators.history import (
    prior,
    prior_avg,
    prior_count,
    prior_count_if,
    prior_rate,
    prior_stddev,
    prior_sum,
)
from paddock.operators import sketches
from paddock.operators.ordered import ranked
from paddock.plans import features, incremental, marts, race_view, staging
from paddock.registry import query, rounded, rounded_sql
from paddock.registry.race_sql import race_sql
from paddock.session import scratch_path
from paddock.sources import sinks
from paddock.sources.sinks import materialize_table

ENTRY = staging.ENTRY
RACE = staging.RACE


def staged_results(spark: SparkSession, sf: str) -> DataFrame:
    """Staged results of the race view, whose raw results are written once as the raw table they stand for."""
    return staging.stg_results(materialize_table(race_view.results(spark, sf), label="raw-results"))


def staged_races(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_races(race_view.races(spark, sf))


def lap_analysis(spark: SparkSession, sf: str, results: DataFrame) -> DataFrame:
    return features.int_lap_analysis(staging.stg_lap_times(race_view.laps(spark, sf)), results)


def feature_frame(spark: SparkSession, sf: str, as_of: bool = False) -> DataFrame:
    results = staged_results(spark, sf)
    return features.feature_frame(results, lap_analysis(spark, sf, results), as_of=as_of)


# --- staging and features -------------------------------------------------------------


@query("pl1_stg_races", race_sql("SELECT * FROM stg_races"))
def pl1(spark, sf):
    return staged_races(spark, sf)


@query("pl2_stg_results", race_sql(rounded_sql("SELECT * FROM stg_results", "grid_log")))
def pl2(spark, sf):
    return rounded(staging.stg_results(race_view.results(spark, sf)))


_LAP_DOUBLES = ["lap_time_seconds", "sector1_seconds", "sector2_seconds", "sector3_seconds", "median_lap_time"]


@query("pl3_stg_lap_times", race_sql(rounded_sql("SELECT * FROM stg_lap_times", *_LAP_DOUBLES)))
def pl3(spark, sf):
    return rounded(staging.stg_lap_times(race_view.laps(spark, sf, with_numbers=True)))


@query(
    "pl4_int_lap_analysis",
    race_sql(
        rounded_sql(
            "SELECT * FROM int_lap_analysis", "mean_lap_time", "lap_time_std", "leader_mean_lap_time", "relative_pace"
        )
    ),
)
def pl4(spark, sf):
    return rounded(lap_analysis(spark, sf, staged_results(spark, sf)))


_RATES = ["points_momentum", "top3_rate", "top5_rate", "top10_rate", "top15_rate", "dnf_rate"]


@query(
    "pl5_int_driver_cumulative_stats",
    race_sql(
        rounded_sql(
            "SELECT * EXCLUDE (team_reliability) FROM history",
            "finish_consistency",
            "finish_consistency_filled",
            *_RATES,
        )
    ),
)
def pl5(spark, sf):
    return rounded(features.int_driver_cumulative_stats(staged_results(spark, sf)))


_FEATURE_DOUBLES = [
    *_RATES,
    "grid_log",
    "finish_consistency",
    "perf_vs_expected",
    "lap_time_consistency",
    "relative_pace",
    "team_reliability",
]


@query("pl6_int_driver_race_features", race_sql(rounded_sql("SELECT * FROM features", *_FEATURE_DOUBLES)))
def pl6(spark, sf):
    return rounded(features.int_driver_race_features(feature_frame(spark, sf)))


# --- dimensions and facts ---------------------------------------------------------------


@query("pl7_dim_drivers", race_sql("SELECT * FROM dim_drivers"))
def pl7(spark, sf):
    return marts.dim_drivers(features.driver_frame(staging.stg_results(race_view.results(spark, sf))))


@query("pl8_dim_teams", race_sql("SELECT * FROM dim_teams"))
def pl8(spark, sf):
    return marts.dim_teams(staging.stg_results(race_view.results(spark, sf)))


@query(
    "top3_teams_ordered", race_sql("SELECT * FROM dim_teams ORDER BY total_constructor_points DESC, team_name")
)
def top3(spark, sf):
    teams = marts.dim_teams(staging.stg_results(race_view.results(spark, sf)))
    return teams.orderBy(F.desc("total_constructor_points"), "team_name")


@query("pl9_dim_circuits", race_sql("SELECT * FROM dim_circuits"))
def pl9(spark, sf):
    return marts.dim_circuits(staged_races(spark, sf), staging.stg_results(race_view.results(spark, sf)))


_FACT_FEATURES = [c for c in _FEATURE_DOUBLES if c != "relative_pace"]


@query(
    "pl10_fct_race_results",
    race_sql(
        rounded_sql(
            "SELECT * FROM fct_race_results", "mean_lap_time", "lap_time_std", "relative_pace", *_FACT_FEATURES
        )
    ),
)
def pl10(spark, sf):
    return rounded(marts.fct_race_results(feature_frame(spark, sf), staged_races(spark, sf)))


@query("pl11_fct_championship_standings", race_sql("SELECT * FROM fct_championship_standings"))
def pl11(spark, sf):
    return marts.fct_championship_standings(staged_results(spark, sf))


@query("pl12_fct_driver_performance", race_sql("SELECT * FROM fct_driver_performance"))
def pl12(spark, sf):
    return marts.fct_driver_performance(feature_frame(spark, sf))


@query("pl13_fct_race_summary", race_sql("SELECT * FROM fct_race_summary"))
def pl13(spark, sf):
    results = staged_results(spark, sf)
    return marts.fct_race_summary(staged_races(spark, sf), results, lap_analysis(spark, sf, results))


# --- window histories, one by one --------------------------------------------------------

_PAST = "OVER (PARTITION BY driver_abbr ORDER BY season, round_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_LAST6 = "OVER (PARTITION BY driver_abbr ORDER BY season, round_number ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)"
_LAST5 = "OVER (PARTITION BY driver_abbr ORDER BY season, round_number ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"
_DRIVER = ["driver_abbr"]


def _history(spark, sf, **columns):
    results = staging.stg_results(race_view.results(spark, sf))
    return rounded(results.select(*ENTRY, *[c.alias(n) for n, c in columns.items()]))


def _history_sql(expressions: str) -> str:
    return race_sql(f"SELECT season, round_number, driver_abbr, {expressions} FROM stg_results")


@query("wn1_prior_count", _history_sql(f"count(*) {_PAST} AS races"))
def wn1(spark, sf):
    return _history(spark, sf, races=prior_count(prior(_DRIVER)))


@query(
    "wn2_prior_count_if",
    _history_sql(
        ", ".join(
            f"count(CASE WHEN finish_position <= {n} AND NOT is_dnf THEN 1 END) {_PAST} AS top{n}" for n in (3, 5, 10, 15)
        )
        + f", count(CASE WHEN is_dnf THEN 1 END) {_PAST} AS dnfs"
    ),
)
def wn2(spark, sf):
    top = lambda n: prior_count_if((F.col("finish_position") <= n) & ~F.col("is_dnf"), prior(_DRIVER))
    tops = {f"top{n}": top(n) for n in features.TOP_N}
    return _history(spark, sf, **tops, dnfs=prior_count_if(F.col("is_dnf"), prior(_DRIVER)))


@query("wn3_prior_sum", _history_sql(f"CAST(coalesce(sum(points) {_PAST}, 0) AS BIGINT) AS points_before"))
def wn3(spark, sf):
    return _history(spark, sf, points_before=prior_sum(F.col("points"), prior(_DRIVER)))


@query(
    "wn4_team_points",
    race_sql("""
    SELECT season, round_number, driver_abbr, team_name, prev_team_points
    FROM stg_results JOIN team_history USING (team_name, season, round_number)"""),
)
def wn4(spark, sf):
    results = staged_results(spark, sf)
    return features.with_team_history(results).select(*ENTRY, "team_name", "prev_team_points")


@query(
    "wn4_team_points_by_row",
    race_sql("""
    SELECT season, round_number, driver_abbr, team_name,
           CAST(coalesce(sum(points) OVER (PARTITION BY team_name ORDER BY season, round_number, driver_abbr
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS prev_team_points
    FROM stg_results"""),
)
def wn4_rows(spark, sf):
    results = staged_results(spark, sf)
    return features.with_team_history(results, mode="rows").select(*ENTRY, "team_name", "prev_team_points")


@query("wn5_rolling_avg", _history_sql(f"round(CAST(coalesce(avg(points) {_LAST5}, 0) AS DECIMAL(28, 10)), 6)::DOUBLE AS momentum"))
def wn5(spark, sf):
    return _history(spark, sf, momentum=prior_avg(F.col("points"), prior(_DRIVER, last=5)))


@query(
    "wn6_rolling_stddev",
    _history_sql(
        f"round(CAST(stddev_samp(CASE WHEN NOT is_dnf THEN finish_position END) {_LAST6} AS DECIMAL(28, 10)), 6)::DOUBLE AS consistency, "
        f"round(CAST(coalesce(stddev_samp(CASE WHEN NOT is_dnf THEN finish_position END) {_LAST6}, 5.0) AS DECIMAL(28, 10)), 6)::DOUBLE AS filled"
    ),
)
def wn6(spark, sf):
    finish = F.when(~F.col("is_dnf"), F.col("finish_position"))
    spread = prior_stddev(finish, prior(_DRIVER, last=6))
    return _history(spark, sf, consistency=spread, filled=F.coalesce(spread, F.lit(5.0)))


@query(
    "wn7_prior_rate",
    _history_sql(
        f"round(CAST(CASE WHEN count(*) {_PAST} > 0 THEN CAST(count(CASE WHEN is_dnf THEN 1 END) {_PAST} AS DOUBLE)"
        f" / count(*) {_PAST} ELSE 0 END AS DECIMAL(28, 10)), 6)::DOUBLE AS dnf_rate"
    ),
)
def wn7(spark, sf):
    past = prior(_DRIVER)
    return _history(spark, sf, dnf_rate=prior_rate(prior_count_if(F.col("is_dnf"), past), prior_count(past)))


@query(
    "wn8_rolling_lap_stats",
    race_sql(rounded_sql("SELECT * FROM rolling_laps", "avg_lap_consistency", "avg_relative_pace")),
)
def wn8(spark, sf):
    laps = lap_analysis(spark, sf, staged_results(spark, sf))
    recent = prior(_DRIVER, last=features.ROLLING_RACES)
    return rounded(
        laps.select(
            *ENTRY,
            F.avg("lap_time_std").over(recent).alias("avg_lap_consistency"),
            F.avg("relative_pace").over(recent).alias("avg_relative_pace"),
        )
    )


@query(
    "wn9_prior_reliability",
    race_sql("SELECT team_name, season, round_number, round(CAST(team_reliability AS DECIMAL(28, 10)), 6)::DOUBLE AS team_reliability FROM team_history"),
)
def wn9(spark, sf):
    results = staging.stg_results(race_view.results(spark, sf))
    return rounded(features.team_history(results).select("team_name", *RACE, "team_reliability"))


@query("wn10_perf_vs_expected", race_sql(rounded_sql("SELECT * FROM perf", "avg_perf_vs_expected")))
def wn10(spark, sf):
    results = staged_results(spark, sf)
    finished = results.where(~F.col("is_dnf")).join(features.grid_expectations(results), "grid_position", "left")
    surplus = F.col("expected_finish") - F.col("finish_position")
    return rounded(
        finished.select(
            *ENTRY, F.avg(surplus).over(prior(_DRIVER, last=features.ROLLING_RACES)).alias("avg_perf_vs_expected")
        )
    )


@query(
    "wn10_perf_vs_expected_as_of",
    race_sql("""
    SELECT season, round_number, grid_position, round(CAST(sum(s) OVER w / sum(n) OVER w AS DECIMAL(28, 10)), 6)::DOUBLE AS expected_finish
    FROM (SELECT grid_position, season, round_number, sum(finish_position) AS s, count(finish_position) AS n
          FROM stg_results WHERE NOT is_dnf GROUP BY ALL)
    WINDOW w AS (PARTITION BY grid_position ORDER BY season, round_number
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""),
)
def wn10_as_of(spark, sf):
    results = staging.stg_results(race_view.results(spark, sf))
    return rounded(features.past_grid_expectations(results))


@query(
    "wn11_running_sum",
    race_sql("""
    SELECT season, round_number, driver_abbr,
           CAST(sum(points) OVER (PARTITION BY season, driver_abbr ORDER BY round_number) AS BIGINT) AS total_points
    FROM stg_results"""),
)
def wn11(spark, sf):
    so_far = W.partitionBy("season", "driver_abbr").orderBy("round_number")
    results = staging.stg_results(race_view.results(spark, sf))
    return results.select(*ENTRY, F.sum("points").over(so_far).alias("total_points"))


@query(
    "wn12_rank",
    race_sql("""
    SELECT season, round_number, driver_abbr, points,
           rank() OVER (PARTITION BY season, round_number ORDER BY points DESC) AS place
    FROM stg_results"""),
)
def wn12(spark, sf):
    results = staged_results(spark, sf).select(*ENTRY, "points")
    return ranked(results, RACE, "points", "place")


# --- relations refreshed season by season ---------------------------------------------------


def _refreshed(spark: SparkSession, sf: str, relation: str) -> DataFrame:
    """The relation after one load and one refresh per season; later ones read the state and their season."""
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "refreshed")
    results = materialize_table(race_view.results(spark, sf).drop("loaded_at"), label="raw-results")
    laps = race_view.laps(spark, sf).drop("loaded_at")
    for season in sorted(row["season"] for row in results.select("season").distinct().collect()):
        sinks.load_results(results.where(F.col("season") == season), raw)
        sinks.load_laps(laps.where(F.col("season") == season), raw)
        got = incremental.refresh(spark, raw, root)
    return rounded(got[relation])


@query(
    "pl5_refreshed",
    race_sql(
        rounded_sql(
            "SELECT * EXCLUDE (team_reliability) FROM history",
            "finish_consistency",
            "finish_consistency_filled",
            *_RATES,
        )
    ),
)
def pl5_refreshed(spark, sf):
    return _refreshed(spark, sf, "int_driver_cumulative_stats")


# a slot's expected finish from earlier races only
_PAST_FINISHES = """
        SELECT r.season, r.round_number, r.driver_abbr,
               (SELECT avg(e.finish_position) FROM stg_results AS e
                WHERE NOT e.is_dnf AND e.grid_position = r.grid_position
                  AND (e.season < r.season OR e.season = r.season AND e.round_number < r.round_number))
                   - r.finish_position AS surplus,
               row_number() OVER (PARTITION BY r.driver_abbr ORDER BY r.season, r.round_number) AS n
        FROM stg_results AS r
        WHERE NOT r.is_dnf"""


@query(
    "pl6_refreshed",
    race_sql(rounded_sql("SELECT * FROM features", *_FEATURE_DOUBLES), {"finished_entries": _PAST_FINISHES}),
)
def pl6_refreshed(spark, sf):
    return _refreshed(spark, sf, "int_driver_race_features")


@query("pl11_refreshed", race_sql("SELECT * FROM fct_championship_standings"))
def pl11_refreshed(spark, sf):
    return _refreshed(spark, sf, "fct_championship_standings")


@query(
    "pl13_starters_from_sketches",
    race_sql("SELECT season, count(DISTINCT driver_abbr) AS starters, true AS within_error FROM stg_results GROUP BY season"),
)
def pl13_starters(spark, sf):
    """Starters of each season from the sketches of its rounds, held against the exact number."""
    results = staged_results(spark, sf)
    stored = materialize_table(marts.starters_by_round(results), label="sketches")
    exact = results.groupBy("season").agg(F.count_distinct("driver_abbr").alias("exact"))
    both = marts.starters_by_season(stored).join(exact, "season")
    allowed = 4 * sketches.standard_error() * F.col("exact") + 0.5
    return both.select("season", F.col("exact").alias("starters"), (F.abs(F.col("starters") - F.col("exact")) <= allowed).alias("within_error"))

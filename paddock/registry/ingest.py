"""Extraction of raw rows, keyed loads, copies and dimension history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from paddock.operators import scd
from paddock.plans import models, race_view, staging
from paddock.plans.race_view import race_events, table
from paddock.registry import query, rounded, rounded_sql
from paddock.registry.race_sql import race_sql
from paddock.session import scratch_path
from paddock.sources import catalog, extract, sinks

ENTRY = staging.ENTRY
RACE = staging.RACE

# --- session frames over events -----------------------------------------------------------


# Fixed values of the oracle: words in a status that mean the car did not finish.
_STATUS_WORDS = (
    "Retired", "Accident", "Collision", "Mechanical", "Engine", "Gearbox", "Hydraulic", "Electrical", "Spin", "Damage",
    "Puncture", "Brake", "Withdrew", "Disqualified", "DNS", "DNF", "Not Classified",
)
_STATUS_LIST = ", ".join(f"'{word}'" for word in _STATUS_WORDS)


def results_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Results as a session delivers them, with the finishing order as ``result_order``."""
    user = F.regexp_extract("driver_abbr", r"\d+", 0).cast("long")
    place = F.col("finish_position").cast("long")
    words = F.array(*[F.lit(w) for w in _STATUS_WORDS])
    return race_view.results(spark, sf).select(
        *RACE,
        (place * 10).alias("result_order"),
        F.col("driver_abbr").alias("Abbreviation"),
        F.when(user % 13 != 0, "Driver").alias("FirstName"),
        F.when(user % 19 != 0, user.cast("string")).alias("LastName"),
        F.when(user % 11 != 0, F.trim("team_name")).alias("TeamName"),
        F.when(
            (user + F.col("season") + 5 * F.col("round_number")) % 2 == 0,
            F.concat(F.lit("Lap: "), F.element_at(words, (1 + (user + 3 * F.col("round_number")) % 17).cast("int"))),
        )
        .when(place % 7 == 0, "+1 Lap")
        .when(place % 5 != 0, "Finished")
        .alias("Status"),
        F.when(place % 3 != 0, F.col("points")).alias("Points"),
    )


def laps_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Laps as a session delivers them: numbers as doubles, times in seconds."""
    user, value = F.col("user_id"), F.col("value")
    laps = race_events(spark, sf).withColumn("Driver", F.concat(F.lit("U"), user))
    of_driver = W.partitionBy(*RACE, "Driver").orderBy("ts", "event_id")
    ordered = laps.withColumn("lap", F.row_number().over(of_driver))
    return ordered.select(
        *RACE,
        "Driver",
        F.col("lap").cast("double").alias("LapNumber"),
        F.when(user % 11 != 0, ((user * 7 + F.col("round_number")) % 20 + 1).cast("double")).alias("Position"),
        F.when(F.col("event_type") != "signup", value).alias("LapTime"),
        *[F.when(F.col("event_id") % 4 != i, value / 4).alias(f"Sector{i}Time") for i in (1, 2, 3)],
        F.col("event_type").alias("Compound"),
        F.when(F.col("event_id") % 6 != 0, (F.col("event_id") % 30).cast("double")).alias("TyreLife"),
        F.when(F.col("event_id") % 8 != 0, F.col("event_type") == "purchase").alias("IsPersonalBest"),
    )


def schedule_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Rounds with a test session for round 1, some without a format."""
    rounds = race_events(spark, sf).select(*RACE).distinct()
    kind = F.when(F.col("round_number") == 1, "testing").when(F.col("round_number") != 4, "conventional")
    return rounds.withColumn("EventFormat", kind)


_SESSION = {
    "session_results": """
    SELECT season, round_number, driver_abbr, place, CASE WHEN u % 13 <> 0 THEN 'Driver' END AS first_name,
           CASE WHEN u % 19 <> 0 THEN CAST(u AS VARCHAR) END AS last_name,
           CASE WHEN u % 11 <> 0 THEN trim(team_name) END AS team,
           CASE WHEN (u + season + 5 * round_number) % 2 = 0
                THEN 'Lap: ' || list_extract([__WORDS__], CAST(1 + (u + 3 * round_number) % 17 AS INTEGER))
                WHEN place % 7 = 0 THEN '+1 Lap'
                WHEN place % 5 <> 0 THEN 'Finished' END AS session_status,
           CASE WHEN place % 3 <> 0 THEN points END AS session_points
    FROM (SELECT *, CAST(substr(driver_abbr, 2) AS BIGINT) AS u, CAST(finish_position AS BIGINT) AS place
          FROM raw_results)""".replace("__WORDS__", _STATUS_LIST),
    "grid": """
    SELECT season, round_number, driver_abbr, CAST(max((u * 7 + round_number) % 20 + 1) AS INTEGER) AS grid
    FROM (SELECT *, CAST(substr(driver_abbr, 2) AS BIGINT) AS u FROM raw_laps)
    WHERE lap_number = 1 AND u % 11 <> 0 GROUP BY ALL""",
    "driven": """
    SELECT season, round_number, driver_abbr, last_lap,
           max(last_lap) OVER (PARTITION BY season, round_number) AS race_laps
    FROM (SELECT season, round_number, driver_abbr, CAST(max(lap_number) AS DOUBLE) AS last_lap
          FROM raw_laps GROUP BY season, round_number, driver_abbr)""",
}


def _session_sql(body: str) -> str:
    return race_sql(body, _SESSION)


@query(
    "src1_read_raw",
    race_sql("""SELECT season, round_number, driver_abbr, driver_full_name, team_name, grid_position, finish_position,
    classified_position, status, points, is_dnf FROM raw_results"""),
)
def src1(spark, sf):
    root = scratch_path(spark, "raw")
    sinks.load_results(race_view.results(spark, sf).drop("loaded_at"), root)
    return catalog.read_raw(spark, root, "results").drop("loaded_at")


_DNF = """(coalesce(starts_with(session_status, 'Lap: '), false)
       OR coalesce(last_lap < race_laps * 0.9::DOUBLE, false))"""


@query(
    "src3_build_results",
    _session_sql(f"""SELECT season, round_number, driver_abbr,
       trim(coalesce(first_name, '') || ' ' || coalesce(last_name, '')) AS driver_full_name,
       coalesce(team, 'Unknown') AS team_name, CAST(coalesce(grid, place) AS INTEGER) AS grid_position,
       CAST(place AS DOUBLE) AS finish_position,
       CASE WHEN {_DNF} THEN 'R' ELSE CAST(place AS VARCHAR) END AS classified_position,
       coalesce(session_status, 'Unknown') AS status, coalesce(session_points, CAST(0 AS DOUBLE)) AS points,
       {_DNF} AS is_dnf
    FROM session_results LEFT JOIN grid USING (season, round_number, driver_abbr)
    LEFT JOIN driven USING (season, round_number, driver_abbr)"""),
)
def src3(spark, sf):
    return extract.build_results(results_frame(spark, sf), laps_frame(spark, sf))


@query(
    "src4_finish_from_order",
    _session_sql("SELECT season, round_number, driver_abbr, place AS finish_order FROM session_results"),
)
def src4(spark, sf):
    ordered = extract.finish_from_order(results_frame(spark, sf))
    return ordered.select(*RACE, F.col("Abbreviation").alias("driver_abbr"), "finish_order")


@query("src5_grid_from_lap1", _session_sql("SELECT season, round_number, driver_abbr, grid FROM grid "))
def src5(spark, sf):
    return extract.grid_from_lap1(laps_frame(spark, sf))


@query(
    "src6_dnf_from_status",
    _session_sql("""SELECT session_status AS status, coalesce(starts_with(session_status, 'Lap: '), false) AS dnf,
    count(*) AS entries FROM session_results GROUP BY ALL"""),
)
def src6(spark, sf):
    dnf = extract.dnf_from_status(F.col("Status"))
    frame = results_frame(spark, sf).groupBy(F.col("Status").alias("status"), dnf.alias("dnf"))
    return frame.agg(F.count(F.lit(1)).alias("entries"))


@query(
    "src7_dnf_from_laps",
    _session_sql("""SELECT season, round_number, driver_abbr, last_lap, race_laps,
    last_lap < race_laps * 0.9::DOUBLE AS dnf FROM driven """),
)
def src7(spark, sf):
    driven = extract.laps_driven(laps_frame(spark, sf))
    return driven.withColumn("dnf", extract.dnf_from_laps(F.col("last_lap"), F.col("race_laps")))


@query(
    "src8_result_defaults",
    _session_sql("""SELECT coalesce(team, 'Unknown') AS team_name, coalesce(session_status, 'Unknown') AS status,
    count(*) AS entries, sum(coalesce(session_points, CAST(0 AS DOUBLE))) AS points FROM session_results GROUP BY ALL"""),
)
def src8(spark, sf):
    built = extract.build_results(results_frame(spark, sf), laps_frame(spark, sf))
    grouped = built.groupBy("team_name", "status")
    return grouped.agg(F.count(F.lit(1)).alias("entries"), F.sum("points").alias("points"))


@query(
    "src9_build_laps",
    race_sql(
        rounded_sql(
            """SELECT season, round_number, 'U' || user_id AS driver_abbr,
       CAST(row_number() OVER (PARTITION BY season, round_number, user_id ORDER BY ts, event_id) AS INTEGER) AS lap_number,
       CASE WHEN event_type <> 'signup' THEN value * 1000 END AS lap_time_ms,
       CASE WHEN event_id % 4 <> 1 THEN value / 4 * 1000 END AS sector1_ms,
       CASE WHEN event_id % 4 <> 2 THEN value / 4 * 1000 END AS sector2_ms,
       CASE WHEN event_id % 4 <> 3 THEN value / 4 * 1000 END AS sector3_ms,
       event_type AS compound, CASE WHEN event_id % 6 <> 0 THEN CAST(event_id % 30 AS INTEGER) END AS tyre_life,
       event_id % 8 <> 0 AND event_type = 'purchase' AS is_personal_best
    FROM race_events """,
            "lap_time_ms",
            "sector1_ms",
            "sector2_ms",
            "sector3_ms",
        )
    ),
)
def src9(spark, sf):
    return rounded(extract.build_laps(laps_frame(spark, sf)))


_SCHEDULE = "(SELECT DISTINCT season, round_number FROM race_events )"


@query(
    "src10_non_test_rounds",
    race_sql(f"SELECT season, count(CASE WHEN round_number <> 1 THEN 1 END) AS total_rounds FROM {_SCHEDULE} GROUP BY ALL"),
)
def src10(spark, sf):
    return extract.non_test_rounds(schedule_frame(spark, sf))


@query(
    "src11_load_summary",
    race_sql(f"""SELECT season, count(rows) AS loaded, count(*) - count(rows) AS failed, count(*) AS total
    FROM {_SCHEDULE} LEFT JOIN (SELECT season, round_number, count(*) AS rows FROM raw_results GROUP BY ALL)
    USING (season, round_number) WHERE round_number <> 1 GROUP BY ALL"""),
)
def src11(spark, sf):
    return extract.load_summary(extract.load_log(schedule_frame(spark, sf), race_view.results(spark, sf)))


# --- keyed loads --------------------------------------------------------------------------


@query(
    "snk1_upsert_races",
    race_sql("""SELECT season, round_number, race_name, CASE WHEN round_number >= 4 THEN 'moved' ELSE circuit_name END
    AS circuit_name, country, race_date FROM raw_races"""),
)
def snk1(spark, sf):
    """The second load holds every race twice; its last row counts."""
    root = scratch_path(spark, "races")
    races = race_view.races(spark, sf).drop("loaded_at")
    sinks.load_races(races.where("round_number <= 4"), root)
    again = races.where("round_number >= 4")
    named = [again.withColumn("circuit_name", F.lit(name)) for name in ("draft", "moved")]
    sinks.load_races(named[0].unionAll(named[1]), root)
    return catalog.read_raw(spark, root, "races").drop("loaded_at")


@query(
    "snk2_upsert_results",
    race_sql("""SELECT season, round_number, driver_abbr,
       CASE WHEN round_number = 5 THEN upper(driver_full_name) ELSE driver_full_name END AS driver_full_name,
       CASE WHEN round_number < 3 THEN team_name WHEN u % 5 <> 0 THEN 'New ' || team_name END AS team_name, points
    FROM (SELECT *, CAST(substr(driver_abbr, 2) AS BIGINT) AS u FROM raw_results)"""),
)
def snk2(spark, sf):
    """Rounds 3 and 4 are loaded twice; the second load holds every entry twice, of which the last counts."""
    root = scratch_path(spark, "results")
    results = race_view.results(spark, sf).drop("loaded_at")
    user = F.regexp_extract("driver_abbr", r"\d+", 0).cast("long")
    sinks.load_results(results.where("round_number <= 4"), root)
    later = results.where("round_number >= 3").withColumns(
        {
            "driver_full_name": F.upper("driver_full_name"),
            "team_name": F.when(user % 5 != 0, F.concat(F.lit("New "), "team_name")),
        }
    )
    draft = later.withColumns({"team_name": F.lit("draft"), "points": F.lit(-1.0)})
    sinks.load_results(draft.unionAll(later), root)
    stored = catalog.read_raw(spark, root, "results")
    return stored.select(*ENTRY, "driver_full_name", "team_name", "points")


@query(
    "snk3_replace_partition",
    race_sql("""SELECT season, round_number, driver_abbr, round(lap_time_ms, 4) AS lap_time_ms FROM raw_laps
    WHERE NOT (season = 2024 AND round_number = 2 AND lap_time_ms < 50000)"""),
)
def snk3(spark, sf):
    root = scratch_path(spark, "laps")
    laps = race_view.laps(spark, sf).drop("loaded_at")
    sinks.load_laps(laps, root)
    again = laps.where("season = 2024 AND round_number = 2")
    sinks.load_laps(again.where("lap_time_ms >= 50000"), root)
    sinks.load_laps(again.where("false"), root)
    return rounded(catalog.read_raw(spark, root, "lap_times").select(*ENTRY, "lap_time_ms"), 4)


@query(
    "snk4_append_copy",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey, o_custkey, o_totalprice "
    "FROM orders WHERE o_orderstatus = 'P'",
)
def snk4(spark, sf):
    path = scratch_path(spark, "copy")
    orders = table(spark, sf, "orders")
    rows = orders.select("o_orderkey", "o_custkey", "o_totalprice", F.current_timestamp().alias("loaded_at"))
    pending = rows.join(orders.where("o_orderstatus = 'P'").select("o_orderkey"), "o_orderkey", "left_semi")
    draft = rows.withColumn("o_totalprice", F.col("o_totalprice") * 0)
    sinks.append_copy(draft.unionAll(rows), path, keys=["o_orderkey"])
    sinks.append_copy(rows, path, keys=["o_orderkey"])
    sinks.append_copy(pending, path)
    return spark.read.parquet(path)


@query(
    "snk5_materialize",
    "SELECT c_mktsegment, count(*) AS customers FROM customer WHERE c_acctbal > 0 GROUP BY ALL",
)
def snk5(spark, sf):
    good = sinks.materialize_view(table(spark, sf, "customer").where("c_acctbal > 0"), "snk5_good_customers")
    return sinks.materialize_table(good.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers")))


# --- dimension history ---------------------------------------------------------------------


@query(
    "scd1_snapshot_query",
    race_sql("""SELECT driver_abbr, team_name, min(driver_name) AS driver_name FROM stg_results
    GROUP BY driver_abbr, team_name"""),
)
def scd1(spark, sf):
    return scd.driver_teams(staging.stg_results(race_view.results(spark, sf)))


_FIRST, _SECOND = "2024-01-15 00:00:00", "2024-01-30 00:00:00"


def _wall_clock(snapshot: DataFrame) -> DataFrame:
    return snapshot.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in (scd.UPDATED_AT, scd.VALID_FROM, scd.VALID_TO)}
    )


def _snapshots(spark, sf, hard_deletes: bool) -> DataFrame:
    results = staging.stg_results(race_view.results(spark, sf))
    first, second = [F.lit(t).cast("timestamp") for t in (_FIRST, _SECOND)]
    before = scd.current_driver_teams(results.where("season = 2023"))
    history = sinks.materialize_table(scd.first_snapshot(before, ["driver_abbr"], first), label="snapshot")
    left = F.regexp_extract("driver_abbr", r"\d+", 0).cast("long") % 10 == 3
    after = scd.current_driver_teams(results.where(~left))
    merged = scd.snapshot_merge(history, after, ["driver_abbr"], ["team_name"], second, hard_deletes)
    return _wall_clock(merged)


def _snapshot_sql(hard_deletes: bool) -> str:
    vanished = f"TIMESTAMP '{_SECOND}'" if hard_deletes else "NULL"
    latest = "QUALIFY row_number() OVER (PARTITION BY driver_abbr ORDER BY season DESC, round_number DESC) = 1"
    version = (
        "md5(driver_abbr || '|' || '{t}') AS scd_id, TIMESTAMP '{t}' AS updated_at, "
        "TIMESTAMP '{t}' AS valid_from"
    )
    return race_sql(f"""
    SELECT driver_abbr, b.team_name, b.driver_name, {version.format(t=_FIRST)},
           CAST(CASE WHEN a.team_name IS NULL THEN {vanished} WHEN a.team_name <> b.team_name THEN TIMESTAMP '{_SECOND}'
                END AS TIMESTAMP) AS valid_to
    FROM (SELECT driver_abbr, team_name, driver_name FROM stg_results WHERE season = 2023 {latest}) AS b
    LEFT JOIN (SELECT driver_abbr, team_name FROM stg_results WHERE CAST(substr(driver_abbr, 2) AS BIGINT) % 10 <> 3
               {latest}) AS a USING (driver_abbr)
    UNION ALL
    SELECT driver_abbr, a.team_name, a.driver_name, {version.format(t=_SECOND)}, CAST(NULL AS TIMESTAMP)
    FROM (SELECT driver_abbr, team_name, driver_name FROM stg_results
          WHERE CAST(substr(driver_abbr, 2) AS BIGINT) % 10 <> 3 {latest}) AS a
    LEFT JOIN (SELECT driver_abbr, team_name FROM stg_results WHERE season = 2023 {latest}) AS b USING (driver_abbr)
    WHERE b.team_name IS NULL OR a.team_name <> b.team_name""")


@query("scd2_check_strategy_merge", _snapshot_sql(False))
def scd2(spark, sf):
    return _snapshots(spark, sf, hard_deletes=False)


@query("scd3_hard_deletes", _snapshot_sql(True))
def scd3(spark, sf):
    return _snapshots(spark, sf, hard_deletes=True)


@query("snk6_snapshot_table", _snapshot_sql(True))
def snk6(spark, sf):
    path = scratch_path(spark, "snapshots")
    results = staging.stg_results(sinks.materialize_table(race_view.results(spark, sf), label="results"))
    stays = F.regexp_extract("driver_abbr", r"\d+", 0).cast("long") % 10 != 3
    models.refresh_snapshot(results.where("season = 2023"), path, F.lit(_FIRST).cast("timestamp"))
    return _wall_clock(models.refresh_snapshot(results.where(stays), path, F.lit(_SECOND).cast("timestamp")))


@query(
    "scd4_history_from_facts",
    race_sql("""
    SELECT driver_abbr, team_name, s // 100 AS from_season, s % 100 AS from_round_number, e // 100 AS last_season,
           e % 100 AS last_round_number, n // 100 AS to_season, n % 100 AS to_round_number
    FROM (SELECT driver_abbr, team_name, min(p) AS s, max(p) AS e,
                 lead(min(p)) OVER (PARTITION BY driver_abbr ORDER BY island) AS n
          FROM (SELECT *, sum(starts) OVER (PARTITION BY driver_abbr ORDER BY p) AS island
                FROM (SELECT driver_abbr, team_name, season * 100 + round_number AS p,
                             CASE WHEN lag(team_name) OVER (PARTITION BY driver_abbr ORDER BY season, round_number)
                                       IS DISTINCT FROM team_name THEN 1 ELSE 0 END AS starts
                      FROM stg_results))
          GROUP BY driver_abbr, team_name, island)"""),
)
def scd4(spark, sf):
    return scd.history_from_facts(staging.stg_results(race_view.results(spark, sf)), "driver_abbr", "team_name")

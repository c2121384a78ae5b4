"""Schemas of the raw tables and of the lap event, as DDL text."""

RACES = (
    "season int, round_number int, race_name string, circuit_name string, country string, "
    "race_date date, loaded_at timestamp"
)

RESULTS = (
    "season int, round_number int, driver_abbr string, driver_full_name string, team_name string, "
    "grid_position int, finish_position double, classified_position string, status string, "
    "points double, is_dnf boolean, loaded_at timestamp"
)

LAP_TIMES = (
    "season int, round_number int, driver_abbr string, lap_number int, lap_time_ms double, "
    "sector1_ms double, sector2_ms double, sector3_ms double, compound string, tyre_life int, "
    "is_personal_best boolean, loaded_at timestamp"
)

RAW = {"races": RACES, "results": RESULTS, "lap_times": LAP_TIMES}

KEYS = {
    "races": ["season", "round_number"],
    "results": ["season", "round_number", "driver_abbr"],
    "lap_times": ["season", "round_number", "driver_abbr", "lap_number"],
}

# All numbers in the message are floats; reading 1.0 as int or boolean would give NULL.
LAP_EVENT = (
    "season double, race_id double, race_name string, driver_abbr string, lap_number double, lap_time_sec double, "
    "sector1_sec double, sector2_sec double, sector3_sec double, is_personal_best double, "
    "event_id string, event_timestamp timestamp"
)

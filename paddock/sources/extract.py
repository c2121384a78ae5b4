"""Raw rows from the results and laps frames of a session, all rounds in one job.

Results frame: season, round_number, result_order, Abbreviation, FirstName, LastName,
TeamName, Status, Points. Laps frame: season, round_number, Driver, LapNumber, Position,
LapTime, Sector1Time, Sector2Time, Sector3Time (day-time intervals or seconds), Compound,
TyreLife, IsPersonalBest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql import types as T

from paddock.plans.staging import ENTRY, RACE

# Words in a status that mean the car did not finish.
DNF_WORDS = [
    "retired",
    "accident",
    "collision",
    "mechanical",
    "engine",
    "gearbox",
    "hydraulic",
    "electrical",
    "spin",
    "damage",
    "puncture",
    "brake",
    "withdrew",
    "disqualified",
    "dns",
    "dnf",
    "not classified",
]

# Share of the race distance below which a driver counts as not finished,
# and the text for missing names.
DNF_DISTANCE = 0.9
UNKNOWN = "Unknown"
UNKNOWN_DRIVER = "UNK"


def finish_from_order(results: DataFrame) -> DataFrame:
    """Finish position: the place of the row in its race, which has a row for each car."""
    place = F.row_number().over(W.partitionBy(*RACE).orderBy("result_order"))
    return results.withColumn("finish_order", place.cast("long"))


def grid_from_lap1(laps: DataFrame) -> DataFrame:
    """Grid position per entry: the position on lap 1."""
    first = (F.col("LapNumber") == 1) & F.col("Position").isNotNull() & F.col("Driver").isNotNull()
    return laps.where(first).groupBy(*RACE, F.col("Driver").alias("driver_abbr")).agg(
        F.max(F.col("Position").cast("int")).alias("grid")
    )


def dnf_from_status(status: Column) -> Column:
    """Whether the status names a retirement; false for NULL."""
    return F.coalesce(F.lower(status).rlike("|".join(DNF_WORDS)), F.lit(False))


def lap_facts(laps: DataFrame) -> DataFrame:
    """Per entry from one aggregate over the laps: grid, last lap, and the race's last lap.

    The window over a race sees one row per driver.
    """
    first = (F.col("LapNumber") == 1) & F.col("Position").isNotNull()
    per_entry = laps.groupBy(*RACE, F.col("Driver").alias("driver_abbr")).agg(
        F.max(F.when(first, F.col("Position").cast("int"))).alias("grid"), F.max("LapNumber").alias("last_lap")
    )
    race = W.partitionBy(*RACE)
    return per_entry.withColumn("race_laps", F.max("last_lap").over(race))


def laps_driven(laps: DataFrame) -> DataFrame:
    """Last lap per entry and the race's last lap, as (entry, last_lap, race_laps)."""
    return lap_facts(laps).drop("grid")


def dnf_from_laps(last_lap: Column, race_laps: Column) -> Column:
    """Whether a driver with laps stopped before 90 % of the distance."""
    return F.coalesce(last_lap < race_laps * DNF_DISTANCE, F.lit(False))


def build_results(results: DataFrame, laps: DataFrame) -> DataFrame:
    """Rows of the raw results table."""
    ordered = finish_from_order(results).withColumn("driver_abbr", F.col("Abbreviation"))
    joined = ordered.join(lap_facts(laps), ENTRY, "left")
    dnf = dnf_from_status(F.col("Status")) | dnf_from_laps(F.col("last_lap"), F.col("race_laps"))
    finish = F.col("finish_order")
    return joined.withColumn("is_dnf", dnf).select(
        *ENTRY,
        F.trim(F.concat_ws(" ", F.coalesce("FirstName", F.lit("")), F.coalesce("LastName", F.lit("")))).alias(
            "driver_full_name"
        ),
        F.coalesce("TeamName", F.lit(UNKNOWN)).alias("team_name"),
        F.coalesce("grid", finish).cast("int").alias("grid_position"),
        finish.cast("double").alias("finish_position"),
        F.when(F.col("is_dnf"), "R").otherwise(finish.cast("string")).alias("classified_position"),
        F.coalesce("Status", F.lit(UNKNOWN)).alias("status"),
        F.coalesce(F.col("Points").cast("double"), F.lit(0.0)).alias("points"),
        "is_dnf",
    )


def _milliseconds(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.DayTimeIntervalType):
        return F.col(name).cast("interval second").cast("decimal(20, 6)").cast("double") * 1000
    return F.col(name).cast("double") * 1000


def build_laps(laps: DataFrame) -> DataFrame:
    """Rows of the raw lap table; missing times stay NULL."""
    return laps.select(
        *RACE,
        F.coalesce("Driver", F.lit(UNKNOWN_DRIVER)).alias("driver_abbr"),
        F.coalesce(F.col("LapNumber").cast("int"), F.lit(0)).alias("lap_number"),
        _milliseconds(laps, "LapTime").alias("lap_time_ms"),
        *[_milliseconds(laps, f"Sector{i}Time").alias(f"sector{i}_ms") for i in (1, 2, 3)],
        F.col("Compound").alias("compound"),
        F.col("TyreLife").cast("int").alias("tyre_life"),
        F.coalesce(F.col("IsPersonalBest").cast("boolean"), F.lit(False)).alias("is_personal_best"),
    )


def build_races(events: DataFrame) -> DataFrame:
    """Rows of the raw race table from the event frame."""
    return events.select(
        *RACE,
        F.col("EventName").alias("race_name"),
        F.coalesce("Location", F.lit(UNKNOWN)).alias("circuit_name"),
        F.coalesce("Country", F.lit(UNKNOWN)).alias("country"),
        F.col("EventDate").cast("date").alias("race_date"),
    )


def non_test_rounds(schedule: DataFrame) -> DataFrame:
    """Number of races per season, test sessions left out."""
    races = F.count_if(F.coalesce(F.col("EventFormat") != "testing", F.lit(True)))
    return schedule.groupBy("season").agg(races.alias("total_rounds"))


def load_log(schedule: DataFrame, results: DataFrame) -> DataFrame:
    """One row per scheduled race with the number of result rows that were built for it."""
    races = schedule.where(F.coalesce(F.col("EventFormat") != "testing", F.lit(True))).select(*RACE)
    built = results.groupBy(*RACE).agg(F.count(F.lit(1)).alias("rows"))
    return races.join(built, RACE, "left").select(
        *RACE, F.coalesce("rows", F.lit(0)).alias("rows"), F.col("rows").isNotNull().alias("loaded")
    )


def load_summary(log: DataFrame) -> DataFrame:
    """Loaded, failed and total races per season."""
    return log.groupBy("season").agg(
        F.count_if("loaded").alias("loaded"),
        F.count_if(~F.col("loaded")).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )

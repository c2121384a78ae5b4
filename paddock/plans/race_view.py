"""Races, results and laps derived from the ``events`` table.

A season has 15 days and a round 3 days. A user is a driver, an event is a lap. The finish
order of a round is the order of the drivers' summed values; a driver with more than a
quarter of error events did not finish.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from paddock.operators.ordered import numbered
from paddock.plans.staging import ENTRY, RACE

FIRST_DAY = "2024-01-01"
FIRST_SEASON = 2023


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def race_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.datediff(F.col("ts").cast("date"), F.lit(FIRST_DAY).cast("date"))
    return table(spark, sf_dir, "events").withColumns(
        {
            "season": (F.lit(FIRST_SEASON) + F.floor(day / 15)).cast("int"),
            "round_number": (1 + F.floor((day % 15) / 3)).cast("int"),
        }
    )


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = race_events(spark, sf_dir)
    entries = events.groupBy(*RACE, "user_id").agg(
        F.round(F.sum("value"), 2).alias("total"),
        (F.count_if(F.col("event_type") == "error") * 4 > F.count(F.lit(1))).alias("failed"),
        F.max("ts").alias("loaded_at"),
    )
    placed = numbered(entries, RACE, ["-total", "user_id"], "place")
    user, failed = F.col("user_id"), F.col("failed")
    moved = ((user % 7 == 0) & (F.col("round_number") >= 3)).cast("int")
    return placed.select(
        *RACE,
        F.concat(F.lit("U"), user).alias("driver_abbr"),
        F.concat(F.lit(" Driver "), user, F.lit(" ")).alias("driver_full_name"),
        F.concat(F.lit("Team "), (user + F.col("season") + moved) % 10, F.lit(" ")).alias("team_name"),
        F.when(user % 17 != 0, 1 + (user * 7 + F.col("round_number") * 3) % 20).cast("int").alias("grid_position"),
        F.col("place").cast("double").alias("finish_position"),
        F.when(failed, "R").otherwise(F.col("place").cast("string")).alias("classified_position"),
        F.when(failed, "Engine").otherwise("Finished").alias("status"),
        F.when(F.col("place") <= 10, 11.0 - F.col("place")).otherwise(0.0).alias("points"),
        F.when(failed | (user % 23 != 0), failed).alias("is_dnf"),
        "loaded_at",
    )


def laps(spark: SparkSession, sf_dir: str, with_numbers: bool = False) -> DataFrame:
    """Laps; ``lap_number`` is left NULL unless asked for, since it costs a shuffle."""
    drivers = race_events(spark, sf_dir).withColumn("driver_abbr", F.concat(F.lit("U"), F.col("user_id")))
    if with_numbers:
        of_driver = W.partitionBy(*ENTRY).orderBy("ts", "event_id")
        timed = drivers.withColumn("lap", F.row_number().over(of_driver))
    else:
        timed = drivers.withColumn("lap", F.lit(None).cast("long"))
    lap_ms = F.col("value") * 1000
    return timed.select(
        *ENTRY,
        F.col("lap").cast("int").alias("lap_number"),
        lap_ms.alias("lap_time_ms"),
        (lap_ms * 0.25).alias("sector1_ms"),
        (lap_ms * 0.25).alias("sector2_ms"),
        (lap_ms * 0.5).alias("sector3_ms"),
        F.upper("event_type").alias("compound"),
        (F.col("event_id") % 20).cast("int").alias("tyre_life"),
        (F.col("event_type") == "purchase").alias("is_personal_best"),
        F.col("ts").alias("loaded_at"),
    )


def races(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounds = race_events(spark, sf_dir).select(*RACE).distinct()
    regions, nations = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    start = (F.col("season") - FIRST_SEASON) * 15 + (F.col("round_number") - 1) * 3
    return (
        rounds.join(regions, F.col("r_regionkey") == F.col("round_number") % 5, "left")
        .join(nations, F.col("n_nationkey") == (F.col("season") + F.col("round_number")) % 25, "left")
        .select(
            *RACE,
            F.concat(F.lit(" Round "), F.col("round_number"), F.lit(" ")).alias("race_name"),
            F.col("r_name").alias("circuit_name"),
            F.col("n_name").alias("country"),
            F.date_add(F.lit(FIRST_DAY).cast("date"), start).alias("race_date"),
            F.lit(FIRST_DAY).cast("timestamp_ntz").alias("loaded_at"),
        )
    )

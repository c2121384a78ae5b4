"""Staging relations: cleaned races, typed results, laps with outlier flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from paddock.functions.scalars import to_seconds

RACE = ["season", "round_number"]
ENTRY = ["season", "round_number", "driver_abbr"]

# Points for finishing positions 1 to 10.
POINTS = [25, 18, 15, 12, 10, 8, 6, 4, 2, 1]

# Result categories by highest finishing position.
CATEGORIES = [(3, "Podium"), (5, "Top 5"), (10, "Points"), (15, "Midfield")]

# Grid slot for a missing one, outlier factor on the median lap.
DEFAULT_GRID = 20
OUTLIER_FACTOR = 1.25


def points_for(position: Column) -> Column:
    """Points of a finishing position, 0 outside the table and for NULL."""
    expr = F.when(position == 1, POINTS[0])
    for place, points in enumerate(POINTS[1:], start=2):
        expr = expr.when(position == place, points)
    return expr.otherwise(0)


def category_of(position: Column, dnf: Column) -> Column:
    expr = F.when(dnf, "DNF")
    for upper, label in CATEGORIES:
        expr = expr.when(position <= upper, label)
    return expr.otherwise("Backmarker")


def grid_log(grid: Column) -> Column:
    return F.ln(grid.cast("double") + 1)


def stg_races(races: DataFrame) -> DataFrame:
    return races.where(F.col("season").isNotNull() & F.col("round_number").isNotNull()).select(
        "season",
        "round_number",
        *[F.trim(c).alias(c) for c in ("race_name", "circuit_name", "country")],
        "race_date",
        "loaded_at",
    )


def stg_results(results: DataFrame) -> DataFrame:
    grid = F.coalesce("grid_position", F.lit(DEFAULT_GRID))
    finish = F.col("finish_position")
    return results.where(F.col("driver_abbr").isNotNull()).select(
        "season",
        "round_number",
        "driver_abbr",
        F.trim("driver_full_name").alias("driver_name"),
        F.trim("team_name").alias("team_name"),
        grid.alias("grid_position"),
        grid_log(grid).alias("grid_log"),
        "finish_position",
        "classified_position",
        "status",
        points_for(finish).alias("points"),
        F.coalesce("is_dnf", F.lit(False)).alias("is_dnf"),
        F.coalesce(F.col("points") > 0, F.lit(False)).alias("scored_points"),
        category_of(finish, F.col("is_dnf")).alias("finish_category"),
        "loaded_at",
    )


def lap_seconds(laps: DataFrame) -> DataFrame:
    """Laps with a positive time, in seconds."""
    parts = ("lap_time", "sector1", "sector2", "sector3")
    seconds = [to_seconds(F.col(f"{part}_ms")).alias(f"{part}_seconds") for part in parts]
    return laps.where((F.col("lap_time_ms") > 0) & F.col("driver_abbr").isNotNull()).select(
        *ENTRY, "lap_number", *seconds, "compound", "tyre_life", "is_personal_best", "loaded_at"
    )


def stg_lap_times(laps: DataFrame) -> DataFrame:
    """Laps with the driver's median lap of the race and the outlier flag.

    A driver has as many laps in a race as the race is long, so a window holds them: one shuffle.
    """
    median = F.median("lap_time_seconds").over(W.partitionBy(*ENTRY))
    timed = lap_seconds(laps).withColumn("median_lap_time", median)
    slow = F.col("lap_time_seconds") > F.col("median_lap_time") * OUTLIER_FACTOR
    return timed.withColumn("is_outlier", F.coalesce(slow, F.lit(False)))

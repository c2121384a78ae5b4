"""Great-circle distances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Earth radius in miles, kilometres per mile.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934

_FACTOR = {"mi": 1.0, "km": KM_PER_MILE}


def haversine_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "mi") -> Column:
    if unit not in _FACTOR:
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    half_lat = F.sin(F.radians((lat2 - lat1) / 2))
    half_lon = F.sin(F.radians((lon2 - lon1) / 2))
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return 2 * EARTH_RADIUS_MILES * F.asin(F.sqrt(chord)) * _FACTOR[unit]


def with_distance(
    df: DataFrame, lat1: str, lon1: str, lat2: str, lon2: str, unit: str = "mi", name: str = "distance"
) -> DataFrame:
    return df.withColumn(name, haversine_distance(F.col(lat1), F.col(lon1), F.col(lat2), F.col(lon2), unit))


def pair_distances(pairs: DataFrame, places: DataFrame, key: str, unit: str = "mi") -> DataFrame:
    """Distances over a table of pairs ``from_<key>``, ``to_<key>`` and a table of places (key, lat, lon)."""
    start = places.select(F.col(key).alias(f"from_{key}"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1"))
    end = places.select(F.col(key).alias(f"to_{key}"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    joined = pairs.join(start, f"from_{key}").join(end, f"to_{key}")
    return with_distance(joined, "lat1", "lon1", "lat2", "lon2", unit).drop("lat1", "lon1", "lat2", "lon2")

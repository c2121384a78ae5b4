"""Number series and date spines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from paddock.functions.scalars import add_parts, diff_parts


def generate_series(spark: SparkSession, n: int) -> DataFrame:
    """1 to ``n`` as ``generated_number``."""
    if n <= 0:
        raise ValueError("the upper bound must be positive")
    return spark.range(1, n + 1).toDF("generated_number")


def date_spine(spark: SparkSession, part: str, start: str | datetime, end: str | datetime) -> DataFrame:
    """start, start + 1 part, ... with the end left out, as ``date_<part>``."""
    first, last = [F.lit(str(v)).cast("timestamp_ntz") for v in (start, end)]
    count = spark.range(1).select(diff_parts(part, first, last)).first()[0]
    if count <= 0:
        raise ValueError("the start must lie before the end")
    return spark.range(count).select(add_parts(first, part, F.col("id")).alias(f"date_{part}"))


def spine_over(df: DataFrame, column: str, part: str) -> DataFrame:
    """Spine from the first to the last value of a column, both included."""
    low, high = [F.date_trunc(part, f(column)).cast("timestamp_ntz") for f in (F.min, F.max)]
    first, steps = df.agg(low, diff_parts(part, low, high)).first()
    start = F.lit(str(first)).cast("timestamp_ntz")
    return df.sparkSession.range(steps + 1).select(add_parts(start, part, F.col("id")).alias(f"date_{part}"))

"""Declared raw tables and their readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paddock.schemas import RAW


def read_raw(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A raw table stored as parquet below ``root``, with its declared schema."""
    if table not in RAW:
        raise ValueError(f"unknown raw table {table!r}, expected one of {sorted(RAW)}")
    return spark.read.schema(RAW[table]).parquet(f"{root}/{table}")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 16,
    **options: str,
) -> DataFrame:
    """A warehouse table over JDBC, read in ``partitions`` ranges of ``column``.

    Credentials and driver class are passed as options.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if column is not None:
        low, high = bounds
        reader = reader.options(
            partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(partitions)
        )
    return reader.load()


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with header and a declared schema; empty cells are NULL."""
    return spark.read.schema(schema).option("header", "true").csv(path)

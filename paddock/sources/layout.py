"""Tables stored by key: bucketed and sorted, so that joins and groupings on the key need no shuffle.

A bucketed table is a table of the session's catalog (Spark keeps the bucket specification
there); its files lie below the given path or in the warehouse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: Buckets of a table by default; tables that are joined need the same number, or one that divides it.
BUCKETS = 32


def store_by_key(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int = BUCKETS, path: str | None = None
) -> DataFrame:
    """Store the frame as a table with one file per bucket of the keys, rows in the order of the keys.

    The rows are dealt by the keys once, on writing. An existing table is replaced.
    """
    columns = [df[k] for k in keys]
    writer = df.repartition(buckets, *columns).write.mode("overwrite").format("parquet")
    writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    (writer if path is None else writer.option("path", path)).saveAsTable(name)
    return read_by_key(df.sparkSession, name)


def read_by_key(spark: SparkSession, name: str) -> DataFrame:
    """A table stored by ``store_by_key``."""
    return spark.table(name)


def forget(spark: SparkSession, name: str) -> None:
    """Drop the table from the catalog, with its files unless they lie at a path of their own."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")

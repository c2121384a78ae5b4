"""Writers: keyed upsert, partition replacement, append, tables and views.

Raw tables are parquet partitioned by season and round, so a load rewrites only the rounds
it brings. Dynamic partition overwrite stages new files and swaps them in at commit; a
repeated load gives the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from paddock.operators.topk import deduplicate
from paddock.schemas import KEYS
from paddock.session import scratch_path

PARTITIONS = ("season", "round_number")
LOADED_AT = "loaded_at"
_PLACE = "_place"


def merge_upsert(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    order_by: Sequence | None = None,
) -> DataFrame:
    """Rows of ``current`` after inserting or updating ``incoming`` by key.

    On a known key the ``update_cols`` (default: all non-key columns of ``incoming``) take
    the new value, also when it is NULL; other columns keep the old one. Both frames are
    expected to hold a key once (``upsert`` sees to it); with ``order_by`` only the first
    incoming row per key counts.
    """
    new = incoming if order_by is None else deduplicate(incoming, keys, order_by)
    updated = set(new.columns if update_cols is None else update_cols)
    renamed = new.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in new.columns if c not in keys], F.lit(True).alias("_in_new")
    )
    old = current.withColumn("_in_old", F.lit(True))
    both = old.join(renamed, list(keys), "full")
    arrived, known = F.col("_in_new").isNotNull(), F.col("_in_old").isNotNull()

    def merged(name: str):
        if name in keys or name not in new.columns:
            return F.col(name)
        takes_new = arrived if name in updated else arrived & ~known
        return F.when(takes_new, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)

    return both.select(*[merged(c) for c in current.columns])


def replace_partition(df: DataFrame, path: str, partitions: Sequence[str] = PARTITIONS) -> None:
    """Replace exactly the partitions that occur in ``df``; an empty frame changes nothing.

    The rebalance hint lets Spark merge small outputs and split a partition that holds a
    large part of the rows into several files.
    """
    (
        df.hint("rebalance", *partitions)
        .write.partitionBy(*partitions)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def _read(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return like.limit(0)


def refuse_null_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key column is NULL anywhere; such a row could never be found again."""
    counts = df.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys]).first()
    missing = {k: counts[k] for k in keys if counts[k]}
    if missing:
        raise ValueError(f"rows without a key are not loaded: NULLs by column {missing}")


def _staged(rows: DataFrame, label: str) -> DataFrame:
    """The rows written once, with their place in the load."""
    return materialize_table(rows.withColumn(_PLACE, F.monotonically_increasing_id()), label=label)


def upsert(
    incoming: DataFrame,
    path: str,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    order_by: Sequence | None = None,
    partitions: Sequence[str] = PARTITIONS,
) -> None:
    """Upsert into a partitioned parquet table and stamp written rows with the load time.

    A key that occurs more than once in a load is stored once: the first row by ``order_by``
    counts, by default the last row of the load. NULL keys are refused before anything is
    written. The incoming rows are staged once; then only partitions that occur in them are
    read (a semi join on the partition columns, which Spark prunes at run time) and
    rewritten. ``partitions`` must be part of the key.
    """
    staged = _staged(incoming.withColumn(LOADED_AT, F.current_timestamp()), "staged")
    refuse_null_keys(staged, keys)
    new = deduplicate(staged, keys, [F.desc(_PLACE)] if order_by is None else order_by).drop(_PLACE)
    stored = _read(incoming.sparkSession, path, new)
    affected = stored.join(staged.select(*partitions).distinct(), list(partitions), "left_semi")
    columns = None if update_cols is None else [*update_cols, LOADED_AT]
    replace_partition(merge_upsert(affected.select(*new.columns), new, keys, columns), path, partitions)


# Fixed value: on a repeated load of results the driver's full name keeps its first value.
RESULT_UPDATES = [
    "team_name",
    "grid_position",
    "finish_position",
    "classified_position",
    "status",
    "points",
    "is_dnf",
]


def load_races(races: DataFrame, root: str) -> None:
    upsert(races, f"{root}/races", KEYS["races"], partitions=["season"])


def load_results(results: DataFrame, root: str) -> None:
    upsert(results, f"{root}/results", KEYS["results"], RESULT_UPDATES)


def load_laps(laps: DataFrame, root: str) -> None:
    replace_partition(laps.withColumn(LOADED_AT, F.current_timestamp()), f"{root}/lap_times")


def append_copy(df: DataFrame, path: str, keys: Sequence[str] | None = None) -> None:
    """Append the rows without their load time.

    A second run appends them again; give ``keys`` to add only rows whose key is new. Of rows
    with equal keys in one load the last one is added; NULL keys are refused then.
    """
    rows = df.drop(LOADED_AT)
    if keys is not None:
        staged = _staged(rows, "copy")
        refuse_null_keys(staged, keys)
        stored = _read(df.sparkSession, path, rows).select(*keys)
        rows = deduplicate(staged, keys, [F.desc(_PLACE)]).drop(_PLACE).join(stored, list(keys), "left_anti")
    rows.write.mode("append").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = 1000, **options: str) -> None:
    """Append the rows to a warehouse table over JDBC, in batches from every task.

    Credentials and driver class are passed as options.
    """
    writer = df.drop(LOADED_AT).write.format("jdbc").mode("append").option("batchsize", str(batch_rows))
    writer.option("url", url).option("dbtable", table).options(**options).save()


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialize_table(df: DataFrame, path: str | None = None, label: str = "table") -> DataFrame:
    """Write the frame and read it back: shared parents are computed once and scanned by column."""
    spark = df.sparkSession
    target = scratch_path(spark, label) if path is None else path
    df.write.mode("overwrite").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def versions(spark: SparkSession, path: str, name: str = "version") -> list[int]:
    """Versions of a table kept as folders ``version=n``, those written in full; only the folder names are listed."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = path_of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = store.globStatus(path_of(f"{path}/{name}=*/_SUCCESS"))
    folders = [status.getPath().getParent().getName() for status in found or []]
    return sorted(int(folder.removeprefix(f"{name}=")) for folder in folders)


def read_version(spark: SparkSession, path: str) -> DataFrame | None:
    """Newest version of a table, None if there is none."""
    stored = versions(spark, path)
    return spark.read.parquet(f"{path}/version={stored[-1]}") if stored else None

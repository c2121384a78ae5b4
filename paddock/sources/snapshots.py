"""Stored snapshots that read and write only what changed.

Keys are dealt into buckets. A manifest per version says, for each bucket, in which version its
open rows were written and what digest the incoming rows had. A run compares digests first: a
bucket whose incoming rows are as before is neither read nor written, and a run without
changes leaves the snapshot as it is. Closed rows of a version and open rows of its buckets are
written before the manifest, which is the commit: what a run that did not finish has written
is not read and is replaced by the next one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paddock.operators.scd import VALID_TO, first_snapshot, snapshot_merge
from paddock.session import remove
from paddock.sources.sinks import materialize_table, refuse_null_keys, versions

#: Buckets of a new snapshot; one that is stored keeps its number.
BUCKETS = 64
_BUCKET = "_bucket"
_MANIFEST = "bucket int, buckets int, written int, rows bigint, digest struct<a: bigint, b: bigint, c: bigint>"


def _manifest(spark: SparkSession, path: str, number: int) -> dict[int, dict]:
    """Line of each bucket of a version; there are as many lines as buckets."""
    lines = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest/version={number}").collect()
    return {line["bucket"]: line.asDict(recursive=True) for line in lines}


def _open(spark: SparkSession, path: str, lines: dict[int, dict]) -> DataFrame:
    """Open rows of these buckets; files of other buckets are not touched."""
    like = spark.read.parquet(f"{path}/closed").drop("version")
    folders = [f"{path}/open/version={line['written']}/{_BUCKET}={b}" for b, line in lines.items() if line["rows"]]
    return spark.read.schema(like.schema).parquet(*folders) if folders else like.limit(0)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of the snapshot, None before the first run."""
    known = versions(spark, f"{path}/manifest")
    if not known:
        return None
    closed = spark.read.parquet(f"{path}/closed").where(F.col("version") <= known[-1]).drop("version")
    return _open(spark, path, _manifest(spark, path, known[-1])).unionByName(closed)


def _require_keys(incoming: DataFrame, keys: Sequence[str]) -> None:
    """Refuse NULL and repeated keys: the one would be closed and opened in every run, the other opened twice."""
    refuse_null_keys(incoming, keys)
    if not incoming.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise ValueError(f"a snapshot needs one row for each {list(keys)}")


def _digests(incoming: DataFrame, columns: Sequence[str], deletes: bool) -> dict[int, dict]:
    """Per bucket: digest of the columns that are compared, as an exclusive or and sums of row hashes, and the count."""
    # a hash leaves out NULLs; whether a value is NULL is hashed beside it
    told = F.lit(f"{list(columns)} {deletes}")
    row = F.xxhash64(told, *[c for name in columns for c in (F.col(name), F.col(name).isNull())])
    sums = F.sum(row.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftright(row, 32))
    names = ("a", "b", "c")
    digest = F.struct(*[c.alias(n) for c, n in zip((F.bit_xor(row), *sums), names)])
    lines = incoming.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("arrived"), digest.alias("digest")).collect()
    return {line[_BUCKET]: {"arrived": line["arrived"], "digest": line["digest"].asDict()} for line in lines}


def write_snapshot(
    incoming: DataFrame,
    path: str,
    keys: Sequence[str],
    check_cols: Sequence[str],
    at: Column | None = None,
    invalidate_hard_deletes: bool = True,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Compare ``incoming`` with the open rows, store what changed as the next version and give the whole snapshot.

    Columns that are not compared keep the value they had when a row was opened.
    """
    spark = incoming.sparkSession
    known = versions(spark, f"{path}/manifest")
    before = _manifest(spark, path, known[-1]) if known else {}
    count = next(iter(before.values()))["buckets"] if before else buckets
    bucket = F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")
    incoming = materialize_table(incoming.withColumn(_BUCKET, bucket), label="incoming")
    _require_keys(incoming, keys)
    digests = _digests(incoming, [*keys, *check_cols], invalidate_hard_deletes)
    now = F.current_timestamp() if at is None else at
    number = known[-1] + 1 if known else 1
    if not known:
        merged = first_snapshot(incoming.drop(_BUCKET), keys, now)
        changed = set(digests)
    else:
        gone = {b for b, line in before.items() if b not in digests and line["digest"] is not None}
        changed = {b for b, found in digests.items() if before.get(b, {}).get("digest") != found["digest"]} | gone
        if not changed:
            return read_snapshot(spark, path)
        rows = _open(spark, path, {b: line for b, line in before.items() if b in changed})
        arrived = incoming.where(F.col(_BUCKET).isin(sorted(changed))).drop(_BUCKET)
        merged = snapshot_merge(rows, arrived, keys, check_cols, now, invalidate_hard_deletes)
    stamped = materialize_table(merged.withColumn(_BUCKET, bucket), label="snapshot")
    is_open = F.col(VALID_TO).isNull()
    materialize_table(stamped.where(~is_open).drop(_BUCKET), f"{path}/closed/version={number}")
    stamped.where(is_open).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{path}/open/version={number}")
    written = {r[_BUCKET]: r["n"] for r in stamped.where(is_open).groupBy(_BUCKET).agg(F.count("*").alias("n")).collect()}
    lines = [
        (b, count, number, written.get(b, 0), digests.get(b, {}).get("digest"))
        if b in changed
        else tuple(before[b][c] for c in ("bucket", "buckets", "written", "rows", "digest"))
        for b in sorted(changed | set(before))
    ]
    materialize_table(spark.createDataFrame(lines, _MANIFEST).coalesce(1), f"{path}/manifest/version={number}")
    _forget(spark, path, known)
    return read_snapshot(spark, path)


def _forget(spark: SparkSession, path: str, known: list[int]) -> None:
    """Remove open rows that the last two versions before this one no longer share; readers of the last may have begun."""
    if len(known) < 2:
        return
    older, last = (_manifest(spark, path, n) for n in known[-2:])
    for bucket, line in older.items():
        if line["rows"] and last[bucket]["written"] != line["written"]:
            remove(spark, f"{path}/open/version={line['written']}/{_BUCKET}={bucket}")
    remove(spark, f"{path}/manifest/version={known[-2]}")

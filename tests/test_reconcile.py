"""Digest comparison against row comparison, and orphans of frequent keys."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from paddock.operators import checks, joins, reconcile, sets


def tables(frame, changes, seed=1):
    rng = random.Random(seed)
    schema = "k int, name string, v double"
    data = [
        (None if i % 97 == 0 else rng.randrange(500), rng.choice(["a", "b", None, ""]), rng.choice([0.0, -0.0, None, 1.5, float("nan")]))
        for i in range(3000)
    ]
    other = data[:]
    rng.shuffle(other)
    for i in range(changes):
        other[rng.randrange(len(other))] = (rng.randrange(500), f"new{i}", 2.0)
    return frame(data, schema).repartition(3), frame(other, schema).repartition(5)


@pytest.mark.parametrize("keep_duplicates", [False, True])
@pytest.mark.parametrize("changes", [0, 1, 40])
@pytest.mark.parametrize("parts", [1, 16])
def test_same_rows_as_a_full_comparison(frame, changes, parts, keep_duplicates):
    left, right = tables(frame, changes)
    got = reconcile.both_differences(left, right, "k", keep_duplicates, parts)
    assert list(map(repr, rows(got))) == list(map(repr, rows(sets.both_differences(left, right, keep_duplicates))))
    assert (got.isEmpty()) == (changes == 0)


def test_only_differing_ranges_are_read(spark, frame, tmp_path):
    left = spark.range(0, 40_000, 1, 8).selectExpr("CAST(id AS INT) AS k", "CAST(id % 7 AS STRING) AS v")
    right = left.withColumn("v", F.when(F.col("k").isin(5, 20_000), F.lit("x")).otherwise(F.col("v")))
    ranges = reconcile.differing_ranges(left, right, "k", 32)
    assert len(ranges) == 2 and sum(r.high - (r.low or 0) for r in ranges) < 40_000 / 8
    got = reconcile.both_differences(left, right, "k", parts=32)
    assert got.count() == 4
    path = str(tmp_path / "t")
    left.sortWithinPartitions("k").write.parquet(path)
    plan = reconcile.both_differences(spark.read.parquet(path), right, "k", parts=32)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(k," in plan  # the bounds reach the scan


def test_equal_tables_shuffle_digests_only(frame):
    left, right = tables(frame, 0)
    assert reconcile.differing_ranges(left, right, "k", 16) == []
    plan = reconcile.both_differences(left, right, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation <empty>" in plan or "Limit 0" in plan


def test_nulls_do_not_hide_differences(frame):
    left = frame([(1, None, "a"), (2, "b", None)], "k int, x string, y string")
    right = frame([(1, "a", None), (2, None, "b")], "k int, x string, y string")
    assert len(reconcile.differing_ranges(left, right, "k", 1)) == 1
    assert reconcile.both_differences(left, right, "k").count() == 4


def test_types_and_missing_keys(frame):
    left = frame([(1, 5), (None, 7)], "k int, v int")
    assert reconcile.differing_ranges(left, frame([(None, 7), (1, 5)], "k bigint, v bigint"), "k") == []
    other = frame([(1, 5), (None, 8)], "k int, v int")
    assert reconcile.differing_ranges(left, other, "k") == [reconcile.Range(without_key=True)]
    assert rows(reconcile.difference(left, other, "k")) == [(None, 7)]
    empty = left.limit(0)
    assert reconcile.both_differences(empty, empty, "k").isEmpty()
    assert reconcile.both_differences(empty, left, "k").count() == 2 == reconcile.both_differences(left, empty, "k").count()
    assert rows(checks.equality(left, other, range_key="k")) == rows(checks.equality(left, other))


@pytest.mark.parametrize("parts", [2, 8, 100])
def test_orphans(frame, parts):
    """A lost and a found key hold a third of the rows each."""
    rng = random.Random(4)
    keys = ["lost"] * 400 + ["found"] * 400 + [None] * 20 + [f"k{rng.randrange(60)}" for _ in range(380)]
    child = frame([(k, i % 2, i) for i, k in enumerate(keys)], "k string, p int, id int").repartition(6)
    parent = frame([(f"k{i}", p) for i in range(0, 60, 3) for p in (0, 1)] + [("found", 0), ("found", 1), (None, 0)], "k string, p int")
    got = joins.orphans(child, parent, ["k", "p"], parts)
    assert got.columns == child.columns
    assert rows(got) == rows(child.join(parent, ["k", "p"], "left_anti").select(*child.columns))
    # no key of the rows that are shuffled has more than a part's share of all rows
    _, _, rest = joins._by_frequency(child, parent, ["k", "p"], parts)
    largest = rest.groupBy("_key").count().agg(F.max("count")).first()[0] or 0
    assert largest <= 1200 / parts
    frequent = [s for s in got._jdf.queryExecution().executedPlan().toString().split("\n") if "BroadcastHashJoin" in s]
    assert frequent


def test_orphans_of_empty_tables(frame):
    child = frame([("a", 1), (None, 2)], "k string, v int")
    none = child.limit(0)
    assert rows(joins.orphans(child, none, ["k"])) == rows(child)
    assert joins.orphans(none, child, ["k"]).isEmpty()
    assert rows(joins.orphans(child, child, ["k"])) == [(None, 2)]

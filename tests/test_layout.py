"""Tables stored by key, and distinct counts from stored sketches."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from paddock.operators import checks, sketches
from paddock.sources import layout
from paddock.sources.sinks import materialize_table


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


@pytest.fixture
def stored(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = spark.range(3000).selectExpr("CAST(id % 2 AS INT) AS season", "id % 700 AS driver", "id AS a")
    right = spark.range(2000).selectExpr("CAST(id % 2 AS INT) AS season", "id % 900 AS driver", "id AS b")
    keys = ["season", "driver"]
    yield left, right, *(layout.store_by_key(df, name, keys, 8) for df, name in ((left, "stored_a"), (right, "stored_b")))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in ("stored_a", "stored_b"):
        layout.forget(spark, name)


def test_joins_and_checks_on_the_key_do_not_shuffle(stored):
    left, right, a, b = stored
    keys = ["season", "driver"]
    joined = a.join(b, keys)
    assert exchanges(joined) == 0 and exchanges(left.join(right, keys)) > 0
    assert rows(joined) == rows(left.join(right, keys))
    assert exchanges(a.join(b, keys, "left_anti")) == 0
    repeated = checks.unique_combination_of_columns(a, keys)
    assert exchanges(repeated) == 0
    assert rows(repeated) == rows(checks.unique_combination_of_columns(left, keys))
    assert rows(a) == rows(left) and a.columns == left.columns


def test_stored_again(spark, stored):
    left, _, a, _ = stored
    again = layout.store_by_key(left.where("season = 1"), "stored_a", ["driver"], 4)
    assert again.count() == 1500 and exchanges(again.groupBy("driver").count()) == 0
    assert layout.read_by_key(spark, "stored_a").count() == 1500


def test_an_empty_table_by_key(spark):
    df = layout.store_by_key(spark.range(0).withColumn("k", F.col("id")), "stored_none", ["k"], 4)
    assert df.count() == 0 and exchanges(df.groupBy("k").count()) == 0
    layout.forget(spark, "stored_none")


@pytest.mark.parametrize("distinct", [50, 3000, 60_000])
def test_error_of_merged_sketches(spark, distinct, tmp_path):
    """Sketches of rounds that share most values, against the exact count over all rounds."""
    df = spark.range(distinct * 4).selectExpr("id % 4 AS season", "id % 12 AS round", f"concat('D', id % {distinct}) AS driver")
    per_round = materialize_table(sketches.sketch_by(df, ["season", "round"], "driver"), str(tmp_path / "s"))
    exact = {(r.season, r.round): r.n for r in df.groupBy("season", "round").agg(F.count_distinct("driver").alias("n")).collect()}
    assert {(r.season, r.round): r.exact for r in per_round.collect()} == exact
    bound = 4 * sketches.standard_error()
    for keys in ([], ["season"]):
        got = sketches.merged(per_round, keys).select(*keys, sketches.estimate().alias("n")).collect()
        want = df.groupBy(*keys).agg(F.count_distinct("driver").alias("n")).collect()
        by_key = {tuple(r)[:-1]: r.n for r in want}
        for r in got:
            n = by_key[tuple(r)[:-1]]
            assert abs(r.n - n) <= bound * n + 0.5
    assert "sketch" not in df.columns


def test_sketches_of_nulls_and_other_types(spark, frame):
    df = frame([("a", None, None), ("a", None, 1.5), ("b", 1, 2.5), ("b", 1, 2.5)], "k string, i int, v double")
    one = sketches.sketch_by(df, ["k"], "i").select("k", "exact", sketches.estimate().alias("n"))
    assert rows(one) == [("a", 0, 0), ("b", 1, 1)]
    assert rows(sketches.sketch_by(df, ["k"], "v").select("k", "exact")) == [("a", 1), ("b", 1)]
    assert sketches.merged(sketches.sketch_by(df.limit(0), ["k"], "i"), ["k"]).count() == 0

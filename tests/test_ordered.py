"""Chunked computations give the rows of one window per group, with the same bits however groups are cut."""

import random

import pytest
from helpers import rows
from pyspark.sql import Window as W, functions as F

from paddock.operators import ordered

KEYS = ["k"]
ORDER = ["t", "id"]
PARTS = (1, 2, 16, 64)


@pytest.fixture(scope="module")
def skewed(spark, frame):
    """A third of the rows in one group, a NULL group, ties in ``t`` and NULL values; partitions are not merged."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(7)
    keys = ["hot"] * 200 + [None] * 60 + [f"k{rng.randrange(40)}" for _ in range(340)]
    data = [
        (k, None if i % 37 == 0 else rng.randrange(50) - 9, i, None if i % 11 == 0 else rng.random() * 30, f"n{rng.randrange(99)}")
        for i, k in enumerate(keys)
    ]
    yield frame(data, "k string, t int, id int, v double, s string").repartition(5).cache()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def exact(df):
    """Rows with all bits of doubles."""
    return sorted((tuple(v.hex() if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def at_all_cuts(function, *args, **kwargs):
    """Rows that are the same in however many chunks."""
    got = [exact(function(*args, parts=parts, **kwargs)) for parts in PARTS]
    assert all(g == got[0] for g in got)
    return function(*args, **kwargs)


def sorts(order):
    return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order]


@pytest.mark.parametrize("order", [["t", "id"], ["-t", "-id"], ["s", "id"], ["-s", "-id"], ["-t", "id"]])
def test_groups_are_cut_in_order(skewed, order):
    base, chunk_order, group = ordered._chunked(skewed, KEYS, order, 32)
    chunk = F.col(f"{ordered.KEY}._chunk")
    assert base.where("k = 'hot'").select(chunk).distinct().count() >= 16
    assert ordered._chunked(skewed, KEYS, order, 1)[0].select(chunk).distinct().count() == 1
    # in the order of the rows no chunk comes back
    n = F.row_number().over(W.partitionBy("k").orderBy(*sorts(order)))
    c = F.dense_rank().over(W.partitionBy("k").orderBy(chunk_order))
    placed = base.withColumns({"n": n, "c": c})
    back = placed.withColumn("before", F.lag("c").over(W.partitionBy("k").orderBy("n"))).where("before > c")
    assert back.isEmpty()


@pytest.mark.parametrize(
    "value",
    [
        "1704067200 + id * 3153",  # a year of epoch seconds
        "concat('order-', lpad(CAST(id AS STRING), 12, '0'))",
        "id % 2",  # two values; the second column cuts them
    ],
)
def test_one_group_is_cut_evenly(spark, value):
    """Values that lie close together give as many chunks as any others, and the same bits as one chunk."""
    df = spark.range(10_000).selectExpr("1 AS k", f"{value} AS t", "id", "id * 0.1D AS v")
    base, _, _ = ordered._chunked(df, ["k"], ORDER, None)
    sizes = [r["count"] for r in base.groupBy(ordered.KEY).count().collect()]
    assert len(sizes) >= 16 and max(sizes) < 10_000 / 8
    cut, whole = (ordered.running(df, ["k"], ORDER, {"s": F.col("v")}, parts=n) for n in (None, 1))
    assert exact(cut) == exact(whole)


@pytest.mark.parametrize("past_only", [False, True])
@pytest.mark.parametrize("keys", [KEYS, []])
def test_running(skewed, keys, past_only):
    sums = {"total": F.col("v"), "n": F.lit(1)}
    got = at_all_cuts(ordered.running, skewed, keys, ORDER, sums, past_only=past_only)
    frame = W.partitionBy(*keys).orderBy(*sorts(ORDER)).rowsBetween(W.unboundedPreceding, -1 if past_only else 0)
    assert rows(got) == rows(skewed.withColumns({n: F.sum(c).over(frame) for n, c in sums.items()}))


@pytest.mark.parametrize("order", [["t", "id"], ["-t", "-id"], ["-s", "id"], ["v", "id"], ["-v", "id"]])
def test_numbered(skewed, order):
    want = F.row_number().over(W.partitionBy("k").orderBy(*sorts(order))).cast("long")
    assert rows(at_all_cuts(ordered.numbered, skewed, KEYS, order, "nth")) == rows(skewed.withColumn("nth", want))


def test_order_types(spark):
    df = spark.range(300).selectExpr(
        "id % 2 AS k", "id", "id % 3 = 0 AS flag", "date_add(DATE '2020-01-01', CAST(id * 7919 % 900 AS INT)) AS d",
        "timestamp_seconds(1.6e9 + id * 7919 % 9000000) AS ts", "CAST(id * 7919 % 1000 - 500 AS DECIMAL(9, 2)) AS n",
        "CASE WHEN id % 50 = 0 THEN double('NaN') WHEN id % 51 = 0 THEN double('-Infinity') ELSE 1e12 / (id - 150.5) END AS x",
    )
    for first in ("flag", "d", "ts", "n", "x", "-d", "-ts", "-x", "-flag"):
        order = [first, "-x", "id"] if "flag" in first else [first, "id"]
        want = F.row_number().over(W.partitionBy("k").orderBy(*sorts(order))).cast("long")
        assert rows(ordered.numbered(df, ["k"], order).select("id", "row_number")) == rows(df.select("id", want))


@pytest.mark.parametrize("offset", [1, -1])
@pytest.mark.parametrize("keys", [KEYS, []])
def test_shifted(skewed, keys, offset):
    values = {"other": F.col("v"), "other_t": F.col("t")}
    got = at_all_cuts(ordered.shifted, skewed, keys, ORDER, values, offset=offset)
    frame = W.partitionBy(*keys).orderBy(*sorts(ORDER))
    assert rows(got) == rows(skewed.withColumns({n: F.lag(c, offset).over(frame) for n, c in values.items()}))


def test_shifted_rejects_other_offsets(skewed):
    with pytest.raises(ValueError):
        ordered.shifted(skewed, KEYS, ORDER, {"x": F.col("v")}, offset=2)


@pytest.mark.parametrize("preceding", [1, 6])
def test_rolling(skewed, preceding):
    aggregates = {"mean": F.avg("v"), "spread": F.stddev("v"), "n": F.count("v")}
    frame = W.partitionBy("k").orderBy(*sorts(ORDER)).rowsBetween(-preceding, -1)
    want = exact(skewed.withColumns({n: c.over(frame) for n, c in aggregates.items()}))
    for block in (7, 25, 100_000):
        assert exact(ordered.rolling(skewed, KEYS, ORDER, preceding, aggregates, block)) == want


@pytest.mark.parametrize("by", ["t", "v"])
@pytest.mark.parametrize("descending", [True, False])
def test_ranked(skewed, descending, by):
    direction = F.desc(by) if descending else F.asc(by)
    want = rows(skewed.withColumn("place", F.rank().over(W.partitionBy("k").orderBy(direction)).cast("long")))
    assert rows(at_all_cuts(ordered.ranked, skewed, KEYS, by, "place", descending)) == want


@pytest.mark.parametrize("value", ["v", "t"])
def test_medians(skewed, value):
    want = rows(skewed.groupBy("k").agg(F.median(value).alias("mid")))
    for error in (1e-4, 0.01, 0.2):
        assert rows(ordered.exact_median(skewed, KEYS, value, "mid", error)) == want
    every = rows(skewed.withColumn("mid", F.median(value).over(W.partitionBy("k"))))
    assert rows(ordered.with_median(skewed, KEYS, value, "mid")) == every


def test_median_of_nulls_and_ends(frame):
    inf, nan = float("inf"), float("nan")
    data = [("a", None), ("b", 1.0), ("b", 4.0), ("c", 2.0), ("c", inf), ("c", nan), ("d", -inf), ("d", 1.0), ("d", 1.0)]
    df = frame(data, "k string, v double")
    assert rows(ordered.exact_median(df, KEYS, "v", "mid")) == [("a", None), ("b", 2.5), ("c", inf), ("d", 1.0)]


def test_median_of_a_large_group_shuffles_little(spark):
    """Values far from the middle are only counted."""
    df = spark.range(0, 300_001, 1, 8).selectExpr("1 AS k", "CAST(id * 7919 % 300001 AS DOUBLE) AS v")
    assert rows(ordered.exact_median(df, ["k"], "v", "mid")) == [(1, 150_000.0)]
    accuracy = F.percentile_approx("v", F.lit([0.4997, 0.5003]), 10_000)
    low, high = df.agg(accuracy).first()[0]
    assert high - low < 0.002 * 300_001


def test_nothing_goes_to_one_task_and_nothing_runs_early(spark, skewed):
    plan = ordered.shifted(skewed, [], ["t"], {"x": F.col("t")})._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    ordered.with_median(ordered.running(skewed, KEYS, ORDER, {"s": F.col("v")}), KEYS, "v", "mid")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_sums_that_do_not_fit_raise(frame):
    df = frame([("a", 1, 1e30)], "k string, t int, v double")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        ordered.running(df, KEYS, ["t"], {"s": F.col("v")}).collect()

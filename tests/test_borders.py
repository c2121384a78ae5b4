"""Borders from the data: parts of about equal size for any spread of values."""

import pytest
from pyspark.sql import functions as F

from paddock.operators.borders import borders, with_part

VALUES = {
    "a year of epoch seconds": "1704067200 + id * 3153",
    "epoch milliseconds": "1704067200000 + id * 3153000",
    "texts with one beginning": "concat('order-2024-', lpad(CAST(id AS STRING), 9, '0'))",
    "two kinds of texts": "concat(if(id % 2 = 0, 'a long beginning ', 'another long one '), lpad(CAST(id AS STRING), 9, '0'))",
    "squares": "id * id",
    "doubles": "exp(id / 100.0)",
    "dates": "date_add(DATE '2020-01-01', CAST(id / 4 AS INT))",
    "times": "timestamp_seconds(1.7e9 + id * 60)",
    "decimals": "CAST(id / 7 AS DECIMAL(12, 4))",
}


@pytest.mark.parametrize("kind", VALUES)
@pytest.mark.parametrize("parts", [1, 50])
def test_parts_are_even_and_in_order(spark, kind, parts):
    df = spark.range(10_000).selectExpr("id", f"{VALUES[kind]} AS v").repartition(3)
    placed = with_part(df, "v", borders(df, "v", parts), parts, "part", "edge")
    found = placed.groupBy("part").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    found = found.orderBy("part").collect()
    assert len(found) == parts and max(r.n for r in found) <= 2 * 10_000 / parts + 1
    assert all(a.high < b.low for a, b in zip(found, found[1:]))
    # a border is the first value of its part
    assert {r.v for r in placed.where("edge").select("v").collect()} == {r.low for r in found[1:]}


def test_nulls_ties_and_empty(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id % 3 > 0 THEN id % 2 END AS v", "id")
    placed = with_part(df, "v", borders(df, "v", 8, ["id"]), 8, "part")
    assert placed.where("v IS NULL AND part IS NOT NULL").isEmpty()
    assert placed.select("v", "part").where("v IS NOT NULL").distinct().count() == 2
    none = df.where("v > 5")
    assert with_part(none, "v", borders(none, "v", 8), 8, "part").count() == 0
    assert borders(none, "v", 8).collect()[0].borders == []


def test_one_scan_of_the_column_and_nothing_runs_early(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id AS v", "id AS other").write.parquet(path)
    df = spark.read.parquet(path)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    placed = with_part(df, "v", borders(df, "v", 32), 32, "part")
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    assert plan.count("FileScan") == 2  # the rows, and the one column

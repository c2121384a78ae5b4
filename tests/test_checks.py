"""Checks on golden rows that pass, and on rows that fail."""

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from paddock.operators import checks, suite


def passes(df):
    return df.isEmpty()


def test_accepted_range(frame):
    df = frame([(-1.0,), (11.0,), (None,)], "id double")
    assert passes(checks.accepted_range(df, "id", -1, 11))
    assert passes(checks.accepted_range(df, "id", -2, 11.1, inclusive=False))
    assert rows(checks.accepted_range(df, "id", -1, 11, inclusive=False)) == [(-1.0,), (11.0,)]
    assert rows(checks.accepted_range(df, "id", low=0)) == [(-1.0,)]
    assert passes(checks.accepted_range(df.where("id <> -1"), "id", low=0))
    assert passes(checks.accepted_range(df, "id"))


def test_at_least_one(frame):
    df = frame([("a", 1), ("b", None), ("b", None)], "g string, v int")
    assert passes(checks.at_least_one(df, "v"))
    assert rows(checks.at_least_one(df, "v", ["g"])) == [("b", 0)]
    assert not passes(checks.at_least_one(df.where("g = 'b'"), "v"))


def test_cardinality_equality(frame):
    a = frame([(1,), (2,), (3,)], "same_name int")
    b = frame([(1, 2), (2, 3), (3, 1)], "same_name int, different_name int")
    assert passes(checks.cardinality_equality(a, "same_name", b, "same_name"))
    assert passes(checks.cardinality_equality(a, "same_name", b, "different_name"))
    more = a.unionAll(frame([(1,)], "same_name int"))
    assert rows(checks.cardinality_equality(more, "same_name", b, "same_name")) == [(1, 1), (1, 2)]


def test_equal_rowcount(frame):
    df = frame([(1,), (1,), (2,)], "field int")
    metric = lambda *a, **k: suite.evaluate(checks.equal_rowcount, *a, fail_calc="sum(coalesce(diff_count, 0))", **k)
    assert rows(metric(df, df)) == [(0, "pass")]
    assert rows(metric(df, df, ["field"])) == [(0, "pass")]
    other = frame([(1,), (3,)], "field int")
    assert rows(metric(df, other, ["field"])) == [(1, "error")]
    assert rows(metric(df, other, ["field"], count_missing=True)) == [(3, "error")]
    assert rows(metric(df, other)) == [(1, "error")]


def test_fewer_rows_than(frame):
    one = frame([(1, 1), (1, 2), (1, 3)], "col_a int, field int")
    two = frame([(1, 1), (1, 2), (1, 3), (1, 4)], "col_a int, field int")
    metric = lambda *a: suite.evaluate(checks.fewer_rows_than, *a, fail_calc="sum(coalesce(row_count_delta, 0))")
    assert rows(metric(one, two)) == [(0, "pass")]
    assert rows(metric(one, two, ["col_a"])) == [(0, "pass")]
    assert rows(metric(one, one)) == [(1, "error")]
    assert rows(metric(two, one)) == [(1, "error")]
    assert rows(metric(two.unionAll(two), one)) == [(5, "error")]


def test_equality(frame):
    a = frame([(1, "x"), (2, "y"), (2, "y")], "id int, name string")
    b = frame([(1, "x"), (2, "y"), (4, None)], "id int, name string")
    assert passes(checks.equality(a, a.distinct()))
    assert rows(checks.equality(a, b)) == [("b_minus_a", 4, None)]
    assert rows(checks.equality_metric(checks.equality(a, b))) == [(2,)]
    assert rows(checks.equality_metric(checks.equality(a, a))) == [(0,)]
    assert passes(checks.equality(a, b.where("id < 3"), ["id"]))
    assert rows(checks.equality(a, a.distinct(), keep_duplicates=True)) == [("a_minus_b", 2, "y")]


def test_expression_is_true(frame):
    df = frame([(0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 1.0)], "col_a double, col_b double")
    assert passes(checks.expression_is_true(df, "col_a + col_b = 1"))
    assert passes(checks.expression_is_true(df, "+ col_b = 1", column="col_a"))
    assert passes(checks.expression_is_true(df.where("col_b = 0.5"), F.col("col_a") == 0.5))
    assert rows(checks.expression_is_true(df, "= 0.5", column="col_a")) == [(0.0, 1.0), (1.0, 0.0)]


def day(text):
    return None if text is None else dt.date.fromisoformat(text)


def test_mutually_exclusive_ranges(frame):
    check = checks.mutually_exclusive_ranges
    joined = frame([(0, 1), (1, 2), (2, 4)], "lower_bound int, upper_bound int")
    assert passes(check(joined, "lower_bound", "upper_bound", gaps="not_allowed"))
    assert check(joined, "lower_bound", "upper_bound", gaps="required").count() == 2
    subscriptions = [
        (1, "2019-01-01", "2019-02-01"),
        (1, "2019-03-03", "2019-04-01"),
        (2, "2019-05-06", "2019-07-02"),
        (2, "2019-07-03", None),
    ]
    df = frame([(i, day(a), day(b)) for i, a, b in subscriptions], "id int, valid_from date, valid_to date")
    upper = F.coalesce("valid_to", F.lit("2099-01-01").cast("date"))
    for gaps in ("allowed", "required"):
        assert passes(check(df, "valid_from", upper, "id", gaps=gaps))
    assert check(df, "valid_from", upper, "id", gaps="not_allowed").count() == 2
    assert check(df, "valid_from", "valid_to", "id").count() == 1
    with pytest.raises(ValueError):
        check(df, "valid_from", "valid_to", gaps="some")


def test_zero_length_ranges(frame):
    data = [
        (3, "2020-05-06", "2020-05-07"),
        (3, "2020-05-08", "2020-05-10"),
        (3, "2020-05-08", "2020-05-08"),
        (3, "2020-05-12", "2020-05-15"),
        (4, "2020-06-06", "2020-06-07"),
        (4, "2020-06-08", "2020-06-08"),
        (4, "2020-06-09", "2020-06-10"),
    ]
    df = frame([(i, day(a), day(b)) for i, a, b in data], "id int, f date, t date")
    assert passes(checks.mutually_exclusive_ranges(df, "f", "t", "id", zero_length_range_allowed=True))
    assert checks.mutually_exclusive_ranges(df, "f", "t", "id").count() == 2


def test_values(frame):
    df = frame([(1, "Barcelona"), (2, "London"), (3, "Paris"), (4, "New York")], "id int, city string")
    assert passes(checks.not_accepted_values(df, "city", ["Madrid", "Berlin"]))
    assert rows(checks.not_accepted_values(df, "city", ["Paris"])) == [("Paris",)]
    assert rows(checks.accepted_values(df, "city", ["Barcelona", "London", "Paris"])) == [("New York", 1)]


def test_not_constant(frame):
    df = frame([(1, 1), (1, 1), (1, 2)], "col_a int, field int")
    assert passes(checks.not_constant(df, "field"))
    assert passes(checks.not_constant(df, "field", ["col_a"]))
    assert rows(checks.not_constant(df, "col_a")) == [(1,)]
    assert passes(checks.not_constant(frame([(None,)], "v int"), "v"))


def test_not_empty_string(frame):
    df = frame([("text",), ("text",), ("text   ",), ("   ",), ("",), (None,)], "s string")
    assert rows(checks.not_empty_string(df, "s")) == [("",), ("",)]
    assert checks.not_empty_string(df, "s", trim_whitespace=False).count() == 1


def test_not_null_proportion(frame):
    fives = [1, None, None, 4, 5, 6, None, None, None, 10]
    nines = [1, 2, 3, 4, 5, 6, 7, 8, None, 10]
    df = frame(list(zip(fives, nines)), "point_5 int, point_9 int")
    assert passes(checks.not_null_proportion(df, "point_5", 0.5, 0.5))
    assert passes(checks.not_null_proportion(df, "point_5", 0, group_by=["point_9"]))
    assert passes(checks.not_null_proportion(df, "point_9", 0.9))
    assert rows(checks.not_null_proportion(df, "point_5", 0.6)) == [(0.5,)]


def test_recency(spark, frame):
    recent = spark.range(1).select(F.expr("current_timestamp() - INTERVAL 23 HOURS").alias("created_at"), F.lit(1).alias("c"))
    assert passes(checks.recency(recent, "created_at", "day", 1))
    assert passes(checks.recency(recent, "created_at", "day", 1, group_by=["c"]))
    yesterday = spark.range(1).select(F.expr("date_trunc('day', current_timestamp() - INTERVAL 1 DAY)").alias("created_at"))
    late = yesterday.withColumn("created_at", F.col("created_at") - F.expr("INTERVAL 1 SECOND"))
    assert passes(checks.recency(yesterday, "created_at", "day", 1, ignore_time=True))
    assert checks.recency(late, "created_at", "day", 1).count() == 1


def test_relationships_where(frame):
    child, parent = frame([(1,), (2,), (4,), (None,)], "id int"), frame([(1,), (2,), (3,)], "id int")
    assert passes(checks.relationships_where(child, "id", parent, "id", "id <> 4"))
    assert rows(checks.relationships_where(child, "id", parent, "id")) == [(4,)]
    assert rows(checks.relationships_where(child, "id", parent, "id", to_condition="id > 1")) == [(1,), (4,)]


def test_sequential_values(frame):
    df = frame([(1, 2), (1, 4), (1, 6), (2, 8), (2, 10)], "col_a int, even int")
    assert passes(checks.sequential_values(df, "even", 2))
    assert passes(checks.sequential_values(df, "even", 2, group_by=["col_a"]))
    assert rows(checks.sequential_values(df.where("even <> 6"), "even", 2)) == [(8, 4)]
    hours = frame([(dt.datetime(2021, 1, 1, h),) for h in range(5)], "at timestamp_ntz")
    assert passes(checks.sequential_values(hours, "at", 1, datepart="hour"))
    assert checks.sequential_values(hours, "at", 2, datepart="hour").count() == 4


def test_uniqueness(frame):
    df = frame([(1, "a"), (1, "b"), (2, "a"), (None, "a"), (None, "a")], "m int, p string")
    assert rows(checks.unique_combination_of_columns(df, ["m", "p"])) == [(None, "a", 2)]
    assert rows(checks.unique(df, "m")) == [(1, 2)]
    assert checks.not_null(df, "m").count() == 2


def test_assert_equal(frame):
    df = frame([(1, 1), (1, 2), (None, 3)], "a int, b int")
    assert rows(checks.assert_equal(df, "a", "b")) == [(1, 2)]


def test_race_checks(frame):
    schema = "season int, round_number int, driver_abbr string, finish_position double"
    results = frame(
        [(1, 1, "A", 1.0), (1, 1, "B", 1.0), (1, 2, "A", 31.0), (1, 2, "B", None), (2, 1, "A", 1.0), (2, 1, "B", 2.0)],
        schema,
    )
    got = rows(checks.valid_finish_positions(results), "season", "round_number", "driver_abbr")
    assert got == [(1, 1, "A"), (1, 1, "B"), (1, 2, "A")]
    laps = frame([(1, 1, "A"), (2, 2, "A"), (2, 1, "C")], "season int, round_number int, driver_abbr string")
    assert rows(checks.no_orphan_laps(laps, results)) == [(2, 1, "C"), (2, 2, "A")]


def test_run_suite(frame):
    df = frame([(1, "a", 5.0), (1, "b", None), (1, "a", 50.0)], "k int, c string, v double")
    report = suite.run_suite(
        df,
        [
            suite.row_count_between(1, 5),
            suite.row_count_between(4, None),
            suite.column_exists("K"),
            suite.column_exists("x"),
            suite.columns_match_set(["C", "v", "k"]),
            suite.values_not_null("v"),
            suite.values_between("v", 1, 30),
            suite.values_between("x", 1, 30),
            suite.compound_unique("k", "c"),
        ],
    )
    got = {(r["check"], r["column"], r["observed"]): (r["success"], r["unexpected_count"]) for r in report.collect()}
    assert got == {
        ("row_count_between", "", 3): (False, 1),
        ("column_exists", "K", 3): (True, 0),
        ("column_exists", "x", 3): (False, 1),
        ("columns_match_set", "C,v,k", 3): (True, 0),
        ("not_null", "v", 3): (False, 1),
        ("between", "v", 3): (False, 1),
        ("between", "x", 3): (False, 1),
        ("compound_unique", "k,c", 3): (False, 2),
    }
    assert sum(r["check"] == "row_count_between" and r["success"] for r in report.collect()) == 1
    with pytest.raises(suite.SuiteFailed) as failure:
        suite.enforce(report)
    assert len(failure.value.failed) == 6
    suite.enforce(report.where("success"))


def test_run_suite_on_empty_table(frame):
    report = suite.run_suite(frame([], "a int"), [suite.values_not_null("a"), suite.compound_unique("a")])
    assert [r["success"] for r in report.collect()] == [True, True]


def test_evaluate_thresholds(frame):
    df = frame([(1,), (2,), (3,)], "v int")
    verdict = lambda **k: suite.evaluate(checks.accepted_range, df, "v", high=1, **k).first()["verdict"]
    assert verdict() == "error"
    assert verdict(error_if="> 5") == "warn"
    assert verdict(error_if="> 5", warn_if="> 2") == "pass"
    assert verdict(where="v < 2") == "pass"
    assert verdict(where="v < 2", error_if="< 1", warn_if="< 0") == "error"


def test_suite_counted_while_the_table_is_written(spark, frame, tmp_path):
    df = frame([(1, "a", 5.0), (2, None, 50.0), (2, None, None)], "id int, name string, v double").repartition(3)
    expectations = [
        suite.row_count_between(1, 2), suite.values_not_null("name"), suite.values_between("v", 0, 10),
        suite.compound_unique("id", "name"), suite.column_exists("none"), suite.values_not_null("none"),
    ]
    watched, report = suite.suite_while_written(df, expectations)
    watched.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert rows(report(stored)) == rows(suite.run_suite(df, expectations))
    plan = suite.run_suite(stored, expectations[:3], {"rows": 3})._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan


def test_suite_of_an_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "id int")
    watched, report = suite.suite_while_written(df, [suite.values_not_null("id"), suite.row_count_between(1, None)])
    watched.write.parquet(str(tmp_path / "t"))
    assert [r.success for r in report(df).collect()] == [True, False]

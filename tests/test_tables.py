"""Golden rows of the table operators."""

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from paddock.operators import aggregates, generators, joins, projection, sets, topk


@pytest.fixture(scope="module")
def letters(frame):
    return frame([("a", "b", "c"), ("d", "e", "f"), ("g", "h", "i")], "field_1 string, field_2 string, field_3 string")


def test_star(letters):
    assert letters.select(*projection.star(letters, ["FIELD_3"])).columns == ["field_1", "field_2"]
    named = letters.select(*projection.star(letters, prefix="prefix_", suffix="_suffix"))
    assert named.columns == [f"prefix_field_{i}_suffix" for i in (1, 2, 3)]
    assert projection.star(letters, ["field_1", "Field_2", "field_3"]) == []


def test_star_of_alias(letters):
    joined = letters.alias("x").join(letters.alias("y"), F.col("x.field_1") == F.col("y.field_1"))
    assert joined.select(*projection.star(letters, ["field_1"], alias="y")).columns == ["field_2", "field_3"]


def test_star_aggregate(frame):
    df = frame([("a", "b", 1), ("a", "b", 2), ("c", "d", 3), ("c", "e", 4)], "g1 string, g2 string, v int")
    got = df.groupBy(*projection.star(df, ["v"])).agg(F.sum("v"))
    assert rows(got) == [("a", "b", 3), ("c", "d", 3), ("c", "e", 4)]


def test_drop_columns(letters):
    kept = projection.drop_columns(letters, ["FIELD_1"])
    assert rows(kept.agg(*[F.max(c) for c in kept.columns])) == [("h", "i")]


def test_slugify(frame):
    assert projection.slugify("!Hell0 world-hi") == "hell0_world_hi"
    assert projection.slugify("0Hell0 world-hi") == "_0hell0_world_hi"
    assert projection.slugify_columns(frame([(1, 2)], "`A b` int, `2c` int")).columns == ["a_b", "_2c"]


def test_nullcheck(frame):
    df = frame([("a", "", 1), ("", "b", 2), ("", "", 3)], "field_1 string, field_2 string, field_3 int")
    assert rows(projection.nullcheck(df)) == [("a", None, 1), (None, "b", 2), (None, None, 3)]
    assert rows(projection.nullcheck(df, ["field_2"])) == [("", "b", 2), ("", None, 3), ("a", None, 1)]


def test_in_list_ignores_null(frame):
    df = frame([("x",), ("y",), (None,)], "c string")
    assert rows(projection.in_list(df, "c", ["x"])) == [("x",)]
    assert rows(projection.in_list(df, "c", ["x"], negate=True)) == [("y",)]


@pytest.fixture(scope="module")
def colors(frame):
    return frame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")


def test_pivot(colors):
    assert rows(aggregates.pivot(colors, ["size"], "color", ["red", "blue"])) == [("M", 1, 0), ("S", 1, 1)]
    quoted = aggregates.pivot(colors, ["size"], "color", ["red", "blue", "blue's"], quote_names=False)
    assert quoted.columns == ["size", "red", "blue", "blues"]
    assert rows(quoted) == [("M", 1, 0, 0), ("S", 1, 1, 1)]


def test_pivot_options(colors):
    df = colors.unionAll(colors)
    distinct = aggregates.pivot(df, ["size"], "color", ["red"], distinct=True)
    assert rows(distinct) == [("M", 1), ("S", 1)]
    like = aggregates.pivot(df, ["size"], "color", ["BLUE%"], compare="ilike", prefix="n_", quote_names=False)
    assert like.columns == ["size", "n_blue"] and rows(like) == [("M", 0), ("S", 4)]
    with pytest.raises(ValueError):
        aggregates.pivot(df, ["size"], "color", ["red"], agg=F.max, distinct=True)


def test_pivot_values(colors):
    assert topk.pivot_values(colors, "color") == ["red", "blue", "blue's"]
    with pytest.raises(ValueError):
        topk.pivot_values(colors, "color", at_most=2)


def test_group_by_first(frame):
    assert rows(aggregates.group_by_first(frame([("a", "b", 1)], "x string, y string, z int"), 2).agg(F.count("z"))) == [
        ("a", "b", 1)
    ]


def test_not_null_share(frame):
    df = frame([(1,), (None,), (None,), (4,)], "v int")
    assert rows(df.agg(aggregates.not_null_share("v"))) == [(0.5,)]


@pytest.fixture(scope="module")
def plays(frame):
    return frame([(1, "play", 1), (1, "play", 2), (2, "pause", 1)], "user_id int, event string, version int")


def test_deduplicate(plays):
    got = topk.deduplicate(plays.where("user_id = 1"), ["user_id"], [F.desc("version")])
    assert rows(got) == [(1, "play", 2)]


def test_deduplicate_keeps_rows_with_nulls(frame):
    df = frame([(1, None, 1), (1, "x", 2), (None, None, 1)], "k int, v string, o int")
    assert rows(topk.deduplicate(df, ["k"], ["o"])) == [(1, None, 1), (None, None, 1)]


def test_latest_per_key(plays):
    assert rows(topk.latest_per_key(plays, ["user_id"], ["version"], ["event", "version"])) == [
        (1, "play", 2),
        (2, "pause", 1),
    ]


def test_column_values(frame):
    df = frame([(c,) for c in "abcdefggggg"], "field string")
    got = [tuple(r) for r in topk.column_values(df, "field").collect()]
    assert got == [("g", 5)] + [(c, 1) for c in "abcdef"]
    assert topk.column_value_list(df, "field", 2) == ["g", "a"]
    sided = frame([(c, "left" if i % 2 == 0 else "right") for i, c in enumerate("abcdefg")], "field string, side string")
    kept = topk.column_values(sided, "field", where="side = 'left'", order_by=[F.asc("value")])
    assert [r["value"] for r in kept.collect()] == ["a", "c", "e", "g"]
    assert topk.column_value_list(sided.where("false"), "field", 5, default=["z"]) == ["z"]


def test_single_value(frame):
    source = frame([(3.3, 1), (1.1, 2)], "v double, o int")
    df = frame([(1,), (2,)], "id int")
    assert rows(topk.single_value(source, ["o"])) == [(3.3,)]
    assert rows(topk.with_single_value(df, source, [F.desc("o")], "v")) == [(1, 1.1), (2, 1.1)]
    assert rows(topk.with_single_value(df, source.where("false"), ["o"], "v", 0.0)) == [(1, 0.0), (2, 0.0)]
    null_first = frame([(None, 1), (1.1, 2)], "v double, o int")
    assert rows(topk.single_value(null_first, ["o"], 9.0)) == [(None,)]


@pytest.fixture(scope="module")
def relations(frame):
    one = frame([(1, "dan", "pi"), (2, "bob", "e"), (3, "alice", "4")], "id int, name string, favorite_number string")
    two = frame([(1, "green", 7), (2, "pink", 13)], "id int, favorite_color string, favorite_number int")
    return {"t1": one, "t2": two}


UNION = [
    (1, "dan", "pi", None),
    (1, None, "7", "green"),
    (2, "bob", "e", None),
    (2, None, "13", "pink"),
    (3, "alice", "4", None),
]


def test_union_relations(relations):
    got = sets.union_relations(relations, source_column=None)
    assert got.columns == ["id", "name", "favorite_number", "favorite_color"]
    assert rows(got) == sorted(UNION, key=repr)
    assert rows(sets.union_relations(relations).groupBy(sets.SOURCE_COLUMN).count()) == [("t1", 3), ("t2", 2)]


def test_union_lists(relations):
    without = sets.union_relations(relations, exclude=["NAME"], source_column=None)
    assert rows(without) == sorted([(a, c, d) for a, _, c, d in UNION], key=repr)
    assert sets.union_relations(relations, include=["Name", "ID"], source_column=None).columns == ["id", "name"]
    assert len(rows(sets.union_relations(relations, where="id = 1"))) == 2
    override = sets.union_relations(relations, column_override={"id": "double"}, source_column="src")
    assert dict(override.dtypes)["id"] == "double"
    with pytest.raises(ValueError):
        sets.union_relations(relations, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        sets.union_relations(relations, include=["nothing"])


def test_union_by_pattern(spark, frame):
    spark.sql("CREATE DATABASE IF NOT EXISTS other_schema")
    events = {
        "default.data_events_20180101": [(1, "play"), (2, "pause")],
        "default.data_events_20180102": [(3, "play"), (4, "pause")],
        "other_schema.data_events_20180103": [(5, "play"), (6, "pause")],
        "default.data_events_old": [(7, "play")],
    }
    for name, data in events.items():
        frame(data, "user_id int, event string").write.mode("overwrite").saveAsTable(name)
    got = sets.union_by_pattern(spark, "%", "DATA_EVENTS_%", exclude="%_old", source_column=None)
    assert rows(got) == [(1, "play"), (2, "pause"), (3, "play"), (4, "pause"), (5, "play"), (6, "pause")]
    assert rows(sets.union_by_prefix(spark, "other_schema", "data_events_", source_column=None)) == [
        (5, "play"),
        (6, "pause"),
    ]


def test_differences(frame):
    a = frame([(1,), (1,), (2,), (None,)], "v int")
    b = frame([(1,), (3,), (None,)], "v int")
    assert rows(sets.difference(a, b)) == [(2,)]
    assert rows(sets.difference(a, b, keep_duplicates=True)) == [(1,), (2,)]
    assert rows(sets.both_differences(a, b)) == [("a_minus_b", 2), ("b_minus_a", 3)]


def customers(frame):
    day = dt.date
    return frame(
        [
            (123, day(2017, 1, 1), "active", "tier 1", "name 1", True),
            (234, day(2017, 2, 1), "active", "tier 3", "name 3", False),
            (567, day(2017, 3, 1), "churned", "tier 2", "name 2", None),
        ],
        "customer_id int, created_at date, status string, segment string, name string, is_updated boolean",
    )


def test_unpivot(frame):
    df = customers(frame).drop("is_updated")
    got = sets.unpivot(
        df, exclude=["CUSTOMER_ID", "created_at"], remove=["Name"], field_name="prop", value_name="val"
    )
    assert rows(got, "customer_id", "prop", "val") == [
        (123, "segment", "tier 1"),
        (123, "status", "active"),
        (234, "segment", "tier 3"),
        (234, "status", "active"),
        (567, "segment", "tier 2"),
        (567, "status", "churned"),
    ]
    assert sets.unpivot(df, exclude=["customer_id"]).columns == ["customer_id", "field_name", "value"]


def test_unpivot_boolean(frame):
    got = sets.unpivot(customers(frame), exclude=["customer_id", "created_at"], remove=["name"])
    assert got.count() == 9
    assert rows(got.where("field_name = 'is_updated'"), "value") == [("false",), ("true",), (None,)]


def test_generators(spark):
    assert sorted(r[0] for r in generators.generate_series(spark, 10).collect()) == list(range(1, 11))
    with pytest.raises(ValueError):
        generators.generate_series(spark, 0)
    spine = generators.date_spine(spark, "day", "2018-01-01", "2018-01-10")
    assert spine.columns == ["date_day"]
    assert sorted(r[0].date() for r in spine.collect()) == [dt.date(2018, 1, d) for d in range(1, 10)]
    months = generators.date_spine(spark, "month", "2018-01-31", "2018-05-31").collect()
    assert len(months) == 4
    with pytest.raises(ValueError):
        generators.date_spine(spark, "day", "2018-01-10", "2018-01-01")


def test_joins(frame):
    left = frame([(1,), (2,), (None,)], "k int")
    right = frame([(1, "a"), (1, "b"), (3, "c")], "k int, v string")
    assert rows(joins.semi_join(left, right, ["k"])) == [(1,)]
    assert rows(joins.anti_join(left, right, ["k"])) == [(2,), (None,)]
    counted = joins.aggregate_then_join(left, right, ["k"], [F.count("v").alias("n")])
    assert rows(counted) == [(1, 2), (2, None), (None, None)]
    assert rows(joins.compare_counts(left.where("k > 0"), right, ["k"])) == [(1, 1, 2), (2, 1, None), (3, None, 1)]


def test_pivot_without_alias(frame):
    df = frame([(1, "a"), (1, "b"), (1, "a")], "k int, c string")
    got = aggregates.pivot(df, ["k"], "c", ["a", "b"], alias=False)
    assert rows(got) == [(1, 2, 1)] and "a" not in got.columns

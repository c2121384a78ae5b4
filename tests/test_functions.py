"""Golden rows of the scalar functions."""

import pytest
from helpers import rows
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from paddock.functions import geo, scalars, web


def test_safe_add_and_subtract(frame):
    df = frame([(1, 2, 3), (1, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    assert [r[0] for r in df.select(scalars.safe_add(["a", "b", "c"])).collect()] == [6, 4, 2, 0]
    df = frame([(3, 2, 1), (4, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    assert [r[0] for r in df.select(scalars.safe_subtract(["a", "b", "c"])).collect()] == [0, 1, -2, 0]
    with pytest.raises(TypeError):
        scalars.safe_add("a")


def test_safe_divide(frame):
    # Operands and quotients.
    data = [(6, 0), (10, 5), (None, None), (None, 0), (17, None), (0, None), (None, 9), (0, 5)]
    got = frame(data, "n int, d int").select(scalars.safe_divide(F.col("n"), F.col("d")))
    assert [r[0] for r in got.collect()] == [None, 2, None, None, None, None, None, 0]
    products = [(0, 5, 9), (2, 3, 0), (0, 0, 0), (3, 4, None), (None, 6, 14), (2, 5, 2)]
    got = frame(products, "a int, b int, d int").select(scalars.safe_divide(F.col("a") * F.col("b"), F.col("d")))
    assert [r[0] for r in got.collect()] == [0, None, None, None, None, 5]


def test_surrogate_key(frame):
    df = frame([("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None)], "x string, y string, z string")
    # Keys that must come out for these rows.
    one = [r[0] for r in df.select(scalars.surrogate_key(["x"])).collect()]
    assert one == ["0cc175b9c0f1b6a831c399e269772661"] * 2 + ["f14cc5cdce0420f4a5a6b6d9d7b85f39"] * 2
    three = [r[0] for r in df.select(scalars.surrogate_key(["x", "y", "z"])).collect()]
    assert three == [
        "7b193b3d33184464106f41ddf733783b",
        "4f32a73dc87b7bbb7a654d8898d58c7e",
        "d9c538b129f1a3ad6ecfe55345c32a05",
        "2fa5491950d66d153d23cfbcfea4e164",
    ]
    empty = frame([("a", None)], "x string, y string").select(scalars.surrogate_key(["x", "y"], nulls_as_empty=True))
    want = frame([("a", "")], "x string, y string").select(scalars.surrogate_key(["x", "y"]))
    assert rows(empty) == rows(want)


def test_key_collisions(frame):
    df = frame([("a-b", "c"), ("a", "b-c"), ("x", "y"), ("x", "y")], "p string, q string")
    assert [r["combinations"] for r in scalars.key_collisions(df, ["p", "q"]).collect()] == [2]


def test_width_bucket(frame):
    values = [190000, 290000, 320000, 399999.99, 400000, 470000, 510000, 610000]
    df = frame([(float(v),) for v in values], "v double")
    got = [r[0] for r in df.select(scalars.width_bucket(F.col("v"), 200000, 600000, 4)).collect()]
    assert got == [0, 1, 2, 2, 3, 3, 4, 5]
    assert rows(scalars.histogram(df, "v", 200000, 600000, 4)) == [(0, 1), (1, 1), (2, 2), (3, 2), (4, 1), (5, 1)]


def test_haversine(frame):
    df = frame([(48.864716, 2.349014, 52.379189, 4.899431)], "a double, b double, c double, d double")
    for unit, want in (("km", 430), ("mi", 267)):
        assert round(geo.with_distance(df, "a", "b", "c", "d", unit).first()["distance"]) == want
    with pytest.raises(ValueError):
        geo.haversine_distance(F.col("a"), F.col("b"), F.col("c"), F.col("d"), "ft")


def test_pair_distances(frame):
    places = frame([("p", 48.864716, 2.349014), ("a", 52.379189, 4.899431)], "city string, lat double, lon double")
    pairs = frame([("p", "a"), ("a", "a")], "from_city string, to_city string")
    got = {(r.from_city, r.to_city): round(r.distance) for r in geo.pair_distances(pairs, places, "city", "km").collect()}
    assert got == {("p", "a"): 430, ("a", "a"): 0}


# Urls and the host and path that must come out for them.
LONG = "http://witanddelight.com/2018/01/tips-tricks-how-run-half-marathon-first-time/"

HOSTS = {
    "www.google.co.uk?utm_source=google&utm_medium=cpc&utm_campaign=spring-summer": "www.google.co.uk",
    LONG: "witanddelight.com",
    "https://www.nytimes.com/2018/01/01/blog": "www.nytimes.com",
    "android-app://m.facebook.com/": "m.facebook.com",
    "docs.nytimes.com/2021/01/01/index.js?utm_source=google": "docs.nytimes.com",
    "https://m.facebook.com/": "m.facebook.com",
}

PATHS = {
    "www.google.co.uk?utm_source=google&utm_medium=cpc&utm_campaign=spring-summer": "",
    LONG: "2018/01/tips-tricks-how-run-half-marathon-first-time/",
    "https://www.nytimes.com/2018/01/01/blog": "2018/01/01/blog",
    f"{LONG}?utm_source=google&utm_medium=cpc": "2018/01/tips-tricks-how-run-half-marathon-first-time/",
}


@pytest.mark.parametrize("function, golden", [(web.url_host, HOSTS), (web.url_path, PATHS)])
def test_url_parts(frame, function, golden):
    df = frame([(u,) for u in golden], "url string")
    assert {r.url: r.part for r in df.withColumn("part", function(F.col("url"))).collect()} == golden


def test_url_parameter(frame):
    df = frame(
        [("http://example.com/milky?utm_medium=organic",), ("http://example.com/milky?utm_medium=organic&utm_source=github",)],
        "url string",
    )
    got = web.with_url_parts(df, "url", ["utm_medium", "utm_source"])
    assert rows(got, "param_utm_medium", "param_utm_source") == [("organic", "github"), ("organic", None)]
    assert rows(web.url_breakdown(df, "url")) == [("example.com", 2, 1)]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.one_of(st.none(), st.integers(-1000, 1000)), min_size=3, max_size=3), min_size=1, max_size=20))
def test_safe_arithmetic_matches_python(spark, data):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, a int, b int, c int")
    got = df.select("i", scalars.safe_add(["a", "b", "c"]), scalars.safe_subtract(["a", "b", "c"])).collect()
    for i, total, rest in got:
        a, b, c = (v or 0 for v in data[i])
        assert (total, rest) == (a + b + c, a - b - c)


def test_width_bucket_by_multiples(frame):
    """Edges as dialects without the function count them: low 1, high 11, 5 buckets of width 2."""
    df = frame([(v,) for v in (0.5, 1.5, 2.0, 3.0, 4.0, 10.5, 11.5, 12.0)], "v double")
    buckets = df.select("v", scalars.width_bucket(F.col("v"), 1, 11, 5, count_multiples=True))
    assert rows(buckets) == sorted([(0.5, 0), (1.5, 1), (2.0, 2), (3.0, 1), (4.0, 3), (10.5, 5), (11.5, 6), (12.0, 7)], key=repr)

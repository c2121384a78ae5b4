"""Scalar functions as table jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from paddock.functions import geo, scalars, web
from paddock.plans.race_view import table
from paddock.plans.staging import grid_log
from paddock.registry import query, rounded


@query("fn1_trim", "SELECT p_partkey, trim('  ' || p_name || ' ') AS name FROM part")
def fn1(spark, sf):
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))
    return table(spark, sf, "part").select("p_partkey", F.trim(padded).alias("name"))


@query(
    "fn2_log",
    "SELECT l_orderkey, l_linenumber, round(CAST(ln(CAST(l_quantity AS DOUBLE) + 1) AS DECIMAL(28, 10)), 6)::DOUBLE AS quantity_log FROM lineitem",
)
def fn2(spark, sf):
    lines = table(spark, sf, "lineitem")
    return rounded(lines.select("l_orderkey", "l_linenumber", grid_log(F.col("l_quantity")).alias("quantity_log")))


@query("fn3_round", "SELECT l_orderkey, l_linenumber, round(l_extendedprice / 7, 2) AS seventh FROM lineitem")
def fn3(spark, sf):
    seventh = F.round(F.col("l_extendedprice") / 7, 2).alias("seventh")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", seventh)


@query("fn4_to_seconds", "SELECT event_id, round(CAST(value / 1000.0::DOUBLE AS DECIMAL(28, 10)), 3)::DOUBLE AS seconds FROM events")
def fn4(spark, sf):
    return table(spark, sf, "events").select("event_id", scalars.to_seconds(F.col("value"), 3).alias("seconds"))


_TERMS = "coalesce(nullif(l_quantity, 10), 0)", "coalesce(nullif(l_discount, 0), 0)", "coalesce(nullif(l_tax, 0), 0)"


@query(
    "fn5_safe_add_subtract",
    f"SELECT l_orderkey, l_linenumber, round(CAST({' + '.join(_TERMS)} AS DECIMAL(28, 10)), 6)::DOUBLE AS total, "
    f"round(CAST({' - '.join(_TERMS)} AS DECIMAL(28, 10)), 6)::DOUBLE AS remainder FROM lineitem",
)
def fn5(spark, sf):
    terms = [
        F.nullif("l_quantity", F.lit(10.0)),
        F.nullif("l_discount", F.lit(0.0)),
        F.nullif("l_tax", F.lit(0.0)),
    ]
    return rounded(
        table(spark, sf, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            scalars.safe_add(terms).alias("total"),
            scalars.safe_subtract(terms).alias("remainder"),
        )
    )


@query(
    "fn6_safe_divide",
    "SELECT l_orderkey, l_linenumber, round(CAST(l_quantity / nullif(l_discount * l_tax, 0) AS DECIMAL(28, 10)), 4)::DOUBLE AS ratio FROM lineitem",
)
def fn6(spark, sf):
    ratio = scalars.safe_divide(F.col("l_quantity"), F.col("l_discount") * F.col("l_tax"))
    return rounded(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", ratio.alias("ratio")), 4)


_TOKEN = scalars.NULL_KEY_TOKEN


@query(
    "fn7_surrogate_key",
    "SELECT o_orderkey, md5(coalesce(CAST(o_custkey AS VARCHAR), '{t}') || '-' || "
    "coalesce(nullif(o_orderstatus, 'O'), '{t}') || '-' || coalesce(o_orderpriority, '{t}')) AS surrogate_key, "
    "md5(coalesce(CAST(o_custkey AS VARCHAR), '') || '-' || coalesce(nullif(o_orderstatus, 'O'), '')) AS legacy_key "
    "FROM orders".format(t=_TOKEN),
)
def fn7(spark, sf):
    orders = table(spark, sf, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("O")))
    keyed = scalars.with_surrogate_key(orders, ["o_custkey", "o_orderstatus", "o_orderpriority"])
    legacy = scalars.with_surrogate_key(keyed, ["o_custkey", "o_orderstatus"], "legacy_key", nulls_as_empty=True)
    return legacy.select("o_orderkey", "surrogate_key", "legacy_key")


@query(
    "fn7_key_collisions",
    "SELECT surrogate_key, count(*) AS combinations FROM (SELECT md5(a || '-' || b) AS surrogate_key FROM "
    "(SELECT DISTINCT CASE WHEN o_orderkey % 2 = 0 THEN 'x-' || o_custkey ELSE 'x' END AS a, "
    "CASE WHEN o_orderkey % 2 = 0 THEN 'y' ELSE o_custkey || '-y' END AS b FROM orders)) GROUP BY 1 HAVING count(*) > 1",
)
def fn7_collisions(spark, sf):
    even = F.col("o_orderkey") % 2 == 0
    pairs = table(spark, sf, "orders").select(
        F.when(even, F.concat(F.lit("x-"), "o_custkey")).otherwise("x").alias("a"),
        F.when(even, "y").otherwise(F.concat("o_custkey", F.lit("-y"))).alias("b"),
    )
    return scalars.key_collisions(pairs, ["a", "b"])


@query(
    "fn8_width_bucket",
    "SELECT CASE WHEN l_extendedprice < 10000 THEN 0 WHEN l_extendedprice >= 90000 THEN 9 "
    "ELSE CAST(floor((l_extendedprice - 10000) / 10000) AS BIGINT) + 1 END AS bucket, count(*) AS rows "
    "FROM lineitem GROUP BY ALL",
)
def fn8(spark, sf):
    return scalars.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 10000, 90000, 8)


_LAT = "(CAST({k} AS DOUBLE) * 5 - 60)"
_LON = "(CAST({k} AS DOUBLE) * 13 - 150)"


def _haversine_sql(a: str, b: str, factor: str) -> str:
    lat1, lon1, lat2, lon2 = _LAT.format(k=a), _LON.format(k=a), _LAT.format(k=b), _LON.format(k=b)
    return (
        f"round(CAST(2 * 3961 * asin(sqrt(power(sin(radians(({lat2} - {lat1}) / 2)), 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * power(sin(radians(({lon2} - {lon1}) / 2)), 2))) * {factor} AS DECIMAL(28, 10)), 4)::DOUBLE"
    )


@query(
    "fn9_haversine_pairs",
    f"SELECT from_nation, to_nation, shipments, {_haversine_sql('from_nation', 'to_nation', '1.60934')} AS km, "
    f"{_haversine_sql('from_nation', 'to_nation', '1')} AS distance FROM "
    "(SELECT s_nationkey AS from_nation, c_nationkey AS to_nation, count(*) AS shipments FROM lineitem "
    "JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey "
    "JOIN customer ON o_custkey = c_custkey GROUP BY ALL)",
)
def fn9(spark, sf):
    per_order = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    pairs = (
        per_order.join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("s_nationkey").alias("from_nation"), F.col("c_nationkey").alias("to_nation"))
        .agg(F.sum("n").alias("shipments"))
    )
    key = F.col("n_nationkey").cast("double")
    places = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("nation"), (key * 5 - 60).alias("lat"), (key * 13 - 150).alias("lon")
    )
    miles = geo.pair_distances(pairs, places, "nation")
    return rounded(miles.withColumn("km", F.col("distance") * geo.KM_PER_MILE), 4)


_BARE_HOST = "replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', '')"
_HOST = f"split_part(split_part({_BARE_HOST}, '/', 1), '?', 1)"
_BARE = "replace(replace(url, 'http://', ''), 'https://', '')"
_SKIP = f"coalesce(nullif(strpos({_BARE}, '/'), 0), strpos({_BARE}, '?') - 1)"
_PATH = f"split_part(substr({_BARE}, {_SKIP} + 1), '?', 1)"


@query("fn10_url_host", f"SELECT page_id, {_HOST} AS host FROM pages")
def fn10(spark, sf):
    return table(spark, sf, "pages").select("page_id", web.url_host(F.col("url")).alias("host"))


@query("fn11_url_path", f"SELECT page_id, {_PATH} AS path FROM pages")
def fn11(spark, sf):
    return table(spark, sf, "pages").select("page_id", web.url_path(F.col("url")).alias("path"))


def _param(name: str) -> str:
    return f"nullif(split_part(split_part(url, '{name}=', 2), '&', 1), '')"


@query(
    "fn12_url_parameter",
    f"SELECT page_id, {_HOST} AS host, {_PATH} AS path, {_param('utm_source')} AS param_utm_source, "
    f"{_param('page')} AS param_page, {_param('ref')} AS param_ref FROM pages",
)
def fn12(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return web.with_url_parts(pages, "url", ["utm_source", "page", "ref"]).drop("url")


@query(
    "fn12_url_breakdown",
    f"SELECT {_HOST} AS host, count(*) AS hits, count(DISTINCT {_PATH}) AS paths FROM pages GROUP BY ALL",
)
def fn12_breakdown(spark, sf):
    return web.url_breakdown(table(spark, sf, "pages"), "url")


@query(
    "fn13_dates",
    "SELECT o_orderkey, o_orderdate + INTERVAL 1 MONTH AS due, "
    "date_diff('day', o_orderdate, TIMESTAMP '2001-12-31') AS age_days, "
    "CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month FROM orders",
)
def fn13(spark, sf):
    end = F.lit("2001-12-31").cast("timestamp_ntz")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        scalars.add_parts(F.col("o_orderdate"), "month", F.lit(1)).alias("due"),
        scalars.diff_parts("day", F.col("o_orderdate"), end).alias("age_days"),
        F.trunc("o_orderdate", "month").alias("order_month"),
    )


@query(
    "fn14_casts",
    "SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority, "
    "TRY_CAST(o_orderstatus AS INTEGER) AS status_number, CAST(o_totalprice > 100000 AS VARCHAR) AS is_large FROM orders",
)
def fn14(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority"),
        F.col("o_orderstatus").try_cast("int").alias("status_number"),
        scalars.bool_to_text(F.col("o_totalprice") > 100000).alias("is_large"),
    )


@query(
    "fn15_json",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, "
    "'{\"id\":' || event_id || ',\"type\":\"' || event_type || '\"}' AS message FROM events",
)
def fn15(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.from_json("props", "k int")["k"].alias("k"),
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("message"),
    )


@query(
    "fn16_event_ids",
    "SELECT event_type, count(*) AS events, count(*) AS ids, count(DISTINCT (event_id, ts)) AS hashed "
    "FROM events GROUP BY ALL",
)
def fn16(spark, sf):
    ids = table(spark, sf, "events").select(
        "event_type", F.expr("uuid()").alias("id"), scalars.surrogate_key(["event_id", "ts"]).alias("hash")
    )
    return ids.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("id").alias("ids"), F.count_distinct("hash").alias("hashed")
    )

"""Projections, filters, joins, aggregates, ordered rows and set operations over the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from paddock.functions.scalars import round_half_up
from paddock.operators import aggregates, checks, generators, joins, projection, sets, sketches, topk
from paddock.operators.ordered import exact_median, numbered, ranked, rolling, running, shifted
from paddock.plans.race_view import table
from paddock.registry import query, rounded
from paddock.session import scratch_path
from paddock.sources import layout
from paddock.sources.sinks import materialize_table

# --- projections ------------------------------------------------------------------------


@query(
    "prj1_select_rename",
    "SELECT c_custkey AS customer, c_name AS name, c_mktsegment AS segment FROM customer",
)
def prj1(spark, sf):
    return projection.select_renamed(
        table(spark, sf, "customer"), customer="c_custkey", name="c_name", segment="c_mktsegment"
    )


@query(
    "prj2_star",
    "SELECT o_orderkey AS src_o_orderkey_v1, o_custkey AS src_o_custkey_v1, o_totalprice AS src_o_totalprice_v1, "
    "o_orderdate AS src_o_orderdate_v1 FROM orders",
)
def prj2(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select(*projection.star(orders, ["O_ORDERSTATUS", "o_orderpriority"], prefix="src_", suffix="_v1"))


@query(
    "prj2_star_aggregate",
    "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL",
)
def prj2_aggregate(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return lines.groupBy(*projection.star(lines, ["l_quantity"])).agg(F.sum("l_quantity").alias("quantity"))


@query("prj3_drop_columns", "SELECT p_partkey, p_brand, p_size FROM part")
def prj3(spark, sf):
    return projection.drop_columns(table(spark, sf, "part"), ["P_NAME", "p_type", "P_RetailPrice"])


@query(
    "prj4_slugify_columns",
    "SELECT s_suppkey AS supplier_key, s_name AS the_name_, s_nationkey AS _2nd_nation, s_acctbal AS balance_usd "
    "FROM supplier",
)
def prj4(spark, sf):
    messy = table(spark, sf, "supplier").toDF("Supplier Key", "The - Name!_", "2nd-Nation", "Balance (USD)")
    return projection.slugify_columns(messy)


@query(
    "prj5_nullcheck_table",
    "SELECT o_orderkey, nullif(replace(o_orderstatus, 'O', ''), '') AS status, o_totalprice, "
    "nullif(replace(o_orderpriority, '5-LOW', ''), '') AS priority FROM orders",
)
def prj5(spark, sf):
    blanked = table(spark, sf, "orders").select(
        "o_orderkey",
        F.replace("o_orderstatus", F.lit("O"), F.lit("")).alias("status"),
        "o_totalprice",
        F.replace("o_orderpriority", F.lit("5-LOW"), F.lit("")).alias("priority"),
    )
    return projection.nullcheck(blanked)


# --- filters ----------------------------------------------------------------------------


@query(
    "flt1_filter",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem "
    "WHERE l_shipdate IS NOT NULL AND l_quantity > 30 AND l_discount BETWEEN 0.05 AND 0.07",
)
def flt1(spark, sf):
    lines = table(spark, sf, "lineitem")
    chosen = lines.where(
        F.col("l_shipdate").isNotNull() & (F.col("l_quantity") > 30) & F.col("l_discount").between(0.05, 0.07)
    )
    return chosen.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "flt2_case",
    "SELECT CASE WHEN l_quantity <= 5 THEN 'few' WHEN l_quantity <= 20 THEN 'some' WHEN l_quantity <= 40 THEN 'many' "
    "ELSE 'bulk' END AS category, count(*) AS lines FROM lineitem GROUP BY ALL",
)
def flt2(spark, sf):
    quantity = F.col("l_quantity")
    category = (
        F.when(quantity <= 5, "few").when(quantity <= 20, "some").when(quantity <= 40, "many").otherwise("bulk")
    )
    return table(spark, sf, "lineitem").groupBy(category.alias("category")).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "flt3_coalesce_nullif",
    "SELECT l_orderkey, l_linenumber, round(CAST(l_extendedprice / nullif(l_discount, 0) AS DECIMAL(28, 10)), 4)::DOUBLE AS per_discount, "
    "coalesce(nullif(l_returnflag, 'N'), 'none') AS flag FROM lineitem",
)
def flt3(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        round_half_up(F.col("l_extendedprice") / F.nullif("l_discount", F.lit(0.0)), 4).alias("per_discount"),
        F.coalesce(F.nullif("l_returnflag", F.lit("N")), F.lit("none")).alias("flag"),
    )


@query(
    "flt4_qualify",
    "SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier "
    "QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) = 1",
)
def flt4(spark, sf):
    richest = F.row_number().over(W.partitionBy("s_nationkey").orderBy(F.desc("s_acctbal"), "s_suppkey"))
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return projection.qualify(suppliers, F.col("rn") == 1, "rn", richest)


@query(
    "flt5_having",
    "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey HAVING count(*) >= 10",
)
def flt5(spark, sf):
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    return orders.where("orders >= 10")


@query("flt6_in_list", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view')")
def flt6(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    return projection.in_list(events, "event_type", ["click", "view"], negate=True)


@query("flt7_ilike", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RED%'")
def flt7(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_name").where(F.col("p_name").ilike("%RED%"))


# --- joins ------------------------------------------------------------------------------


_REVENUE = (
    "SELECT o_orderpriority, count(*) AS orders, CAST(sum(lines) AS BIGINT) AS lines, round(CAST(sum(revenue) AS DECIMAL(28, 10)), 2)::DOUBLE AS revenue "
    "FROM orders JOIN (SELECT l_orderkey, count(*) AS lines, sum(l_extendedprice * (1 - l_discount)) AS revenue "
    "FROM lineitem GROUP BY ALL) ON l_orderkey = o_orderkey GROUP BY ALL"
)


def _revenue(orders: DataFrame, lines: DataFrame) -> DataFrame:
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")
    lines = lines.withColumnRenamed("l_orderkey", "o_orderkey")
    joined = joins.aggregate_then_join(
        orders, lines, ["o_orderkey"], [F.count(F.lit(1)).alias("lines"), revenue], how="inner"
    )
    return joined.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("lines").alias("lines"),
        round_half_up(F.sum("revenue"), 2).alias("revenue"),
    )


@query("jn1_inner", _REVENUE)
def jn1(spark, sf):
    return _revenue(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), table(spark, sf, "lineitem"))


def _stored_by_key(spark: SparkSession, df: DataFrame, label: str, keys: list[str]) -> DataFrame:
    path = scratch_path(spark, label)
    return layout.store_by_key(df, path.rsplit("/", 1)[1].replace("-", "_"), keys, path=path)


@query("jn1_stored_by_key", _REVENUE)
def jn1_stored(spark, sf):
    """Both tables stored by the order: aggregate and join shuffle nothing."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    return _revenue(
        _stored_by_key(spark, orders, "orders", ["o_orderkey"]), _stored_by_key(spark, lines, "lines", ["l_orderkey"])
    )


@query(
    "dq18_unique_stored_by_key",
    "SELECT o_custkey, count(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1",
)
def dq18_stored(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return checks.unique(_stored_by_key(spark, orders, "orders", ["o_custkey"]), "o_custkey")


@query(
    "ag3_distinct_from_sketches",
    "SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers, true AS within_error FROM orders GROUP BY ALL",
)
def ag3_sketches(spark, sf):
    """Customers of each priority from sketches per priority and month, held against the exact number."""
    orders = table(spark, sf, "orders").withColumn("month", F.date_trunc("month", "o_orderdate"))
    stored = materialize_table(sketches.sketch_by(orders, ["o_orderpriority", "month"], "o_custkey"), label="sketches")
    exact = orders.groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("customers"))
    both = sketches.merged(stored, ["o_orderpriority"]).join(exact, "o_orderpriority")
    allowed = 4 * sketches.standard_error() * F.col("customers") + 0.5
    close = F.abs(sketches.estimate() - F.col("customers")) <= allowed
    return both.select("o_orderpriority", "customers", close.alias("within_error"))


@query(
    "jn2_left_multiway",
    "SELECT c_custkey, n_name, r_name, orders FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey "
    "LEFT JOIN region ON n_regionkey = r_regionkey "
    "LEFT JOIN (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY ALL) ON o_custkey = c_custkey",
)
def jn2(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    named = customers.join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    ).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    counted = joins.aggregate_then_join(named, orders, ["c_custkey"], [F.count(F.lit(1)).alias("orders")])
    return counted.select("c_custkey", "n_name", "r_name", "orders")


@query(
    "jn3_left_anti",
    "SELECT p_partkey, p_brand FROM part WHERE NOT EXISTS "
    "(SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity = 50)",
)
def jn3(spark, sf):
    bulk = table(spark, sf, "lineitem").where("l_quantity = 50").select(F.col("l_partkey").alias("p_partkey"))
    return joins.anti_join(table(spark, sf, "part").select("p_partkey", "p_brand"), bulk, ["p_partkey"])


@query(
    "jn4_left_semi",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE EXISTS "
    "(SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_discount >= 0.1)",
)
def jn4(spark, sf):
    cheap = table(spark, sf, "lineitem").where("l_discount >= 0.1").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.semi_join(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), cheap, ["o_orderkey"])


@query(
    "jn5_full_outer",
    "SELECT number, rows_a, rows_b FROM (SELECT o_custkey AS number, count(*) AS rows_a FROM orders GROUP BY ALL) "
    "FULL JOIN (SELECT l_suppkey AS number, count(*) AS rows_b FROM lineitem GROUP BY ALL) USING (number)",
)
def jn5(spark, sf):
    """Numbers that only one of the two tables has are on one side."""
    customers = table(spark, sf, "orders").select(F.col("o_custkey").alias("number"))
    suppliers = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("number"))
    return joins.compare_counts(customers, suppliers, ["number"])


# --- aggregates -------------------------------------------------------------------------


@query("ag1_count", "SELECT event_type, count(*) AS events FROM events GROUP BY ALL")
def ag1(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@query(
    "ag2_conditional_count",
    "SELECT l_shipdate, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS returned, "
    "count(CASE WHEN l_quantity > 25 THEN 1 END) AS large FROM lineitem GROUP BY ALL",
)
def ag2(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_shipdate")
        .agg(
            F.count_if(F.col("l_returnflag") == "R").alias("returned"),
            F.count_if(F.col("l_quantity") > 25).alias("large"),
        )
    )


@query(
    "ag3_count_distinct",
    "SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY ALL",
)
def ag3(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy("l_returnflag")
    return lines.agg(F.count_distinct("l_suppkey").alias("suppliers"))


@query(
    "ag4_sum_avg_min_max",
    "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(CAST(sum(l_extendedprice) AS DECIMAL(28, 10)), 2)::DOUBLE AS sum_price, "
    "round(CAST(avg(l_discount) AS DECIMAL(28, 10)), 6)::DOUBLE AS avg_disc, min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price "
    "FROM lineitem GROUP BY ALL",
)
def ag4(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("sum_qty"),
            round_half_up(F.sum("l_extendedprice"), 2).alias("sum_price"),
            round_half_up(F.avg("l_discount"), 6).alias("avg_disc"),
            F.min("l_extendedprice").alias("min_price"),
            F.max("l_extendedprice").alias("max_price"),
        )
    )


@query(
    "ag5_conditional_avg",
    "SELECT l_suppkey, round(CAST(avg(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) AS DECIMAL(28, 10)), 6)::DOUBLE AS kept_avg, "
    "round(CAST(stddev_samp(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) AS DECIMAL(28, 10)), 6)::DOUBLE AS kept_std FROM lineitem GROUP BY ALL",
)
def ag5(spark, sf):
    kept = F.when(F.col("l_returnflag") != "R", F.col("l_quantity"))
    lines = table(spark, sf, "lineitem").groupBy("l_suppkey")
    return rounded(lines.agg(F.avg(kept).alias("kept_avg"), F.stddev(kept).alias("kept_std")))


@query(
    "ag6_stddev",
    "SELECT o_custkey, count(*) AS orders, round(CAST(stddev_samp(o_totalprice) AS DECIMAL(28, 10)), 4)::DOUBLE AS price_std FROM orders GROUP BY ALL",
)
def ag6(spark, sf):
    orders = table(spark, sf, "orders").groupBy("o_custkey")
    return orders.agg(F.count(F.lit(1)).alias("orders"), round_half_up(F.stddev("o_totalprice"), 4).alias("price_std"))


@query("ag7_median", "SELECT l_returnflag, round(CAST(median(l_extendedprice) AS DECIMAL(28, 10)), 4)::DOUBLE AS mid FROM lineitem GROUP BY ALL")
def ag7(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    return rounded(exact_median(lines, ["l_returnflag"], "l_extendedprice", "mid"), 4)


@query("ag8_bool_or", "SELECT user_id, bool_or(event_type = 'error') AS had_error FROM events GROUP BY ALL")
def ag8(spark, sf):
    events = table(spark, sf, "events").groupBy("user_id")
    return events.agg(F.bool_or(F.col("event_type") == "error").alias("had_error"))


@query(
    "ag9_proportion",
    "SELECT l_suppkey, round(CAST(avg(CASE WHEN nullif(l_returnflag, 'N') IS NOT NULL THEN 1.0 ELSE 0.0 END) AS DECIMAL(28, 10)), 6)::DOUBLE AS share "
    "FROM lineitem GROUP BY ALL",
)
def ag9(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_suppkey", F.nullif("l_returnflag", F.lit("N")).alias("flag"))
    return rounded(lines.groupBy("l_suppkey").agg(aggregates.not_null_share("flag").alias("share")))


@query(
    "ag10_group_by_first",
    "SELECT l_returnflag, l_linestatus, count(*) AS total FROM lineitem GROUP BY 1, 2",
)
def ag10(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return aggregates.group_by_first(lines, 2).agg(F.count(F.lit(1)).alias("total"))


@query(
    "ag11_pivot",
    "SELECT user_id, "
    + ", ".join(
        f"CAST(sum(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS BIGINT) AS n_{t}"
        for t in ("click", "error", "purchase", "signup", "view")
    )
    + " FROM events GROUP BY ALL",
)
def ag11(spark, sf):
    events = table(spark, sf, "events")
    types = topk.pivot_values(events, "event_type")
    return aggregates.pivot(events, ["user_id"], "event_type", types, prefix="n_")


@query(
    "ag11_pivot_compare",
    "SELECT l_returnflag, max(CASE WHEN l_linestatus ILIKE 'o' THEN l_quantity ELSE 0 END) AS max_o, "
    "max(CASE WHEN l_linestatus ILIKE 'f' THEN l_quantity ELSE 0 END) AS max_f FROM lineitem GROUP BY ALL",
)
def ag11_compare(spark, sf):
    return aggregates.pivot(
        table(spark, sf, "lineitem"),
        ["l_returnflag"],
        "l_linestatus",
        ["o", "f"],
        agg=F.max,
        compare="ilike",
        prefix="Max ",
        then_value=F.col("l_quantity"),
        else_value=0.0,
        quote_names=False,
    )


@query("ag12_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def ag12(spark, sf):
    return table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()


# --- ordered rows -----------------------------------------------------------------------

def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")


def _by_date():
    return ["o_orderdate", "o_orderkey"]


@query(
    "wn13_row_number",
    "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nth "
    "FROM orders",
)
def wn13(spark, sf):
    return numbered(_orders(spark, sf), ["o_custkey"], _by_date(), "nth").select("o_custkey", "o_orderkey", "nth")


@query(
    "wn14_lead",
    "SELECT o_custkey, o_orderkey, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) "
    "AS next_date FROM orders",
)
def wn14(spark, sf):
    ahead = shifted(_orders(spark, sf), ["o_custkey"], _by_date(), {"next_date": F.col("o_orderdate")}, offset=-1)
    return ahead.select("o_custkey", "o_orderkey", "next_date")


@query(
    "wn15_lag",
    "SELECT o_custkey, o_orderkey, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) "
    "AS previous_price FROM orders",
)
def wn15(spark, sf):
    behind = shifted(_orders(spark, sf), ["o_custkey"], _by_date(), {"previous_price": F.col("o_totalprice")})
    return behind.select("o_custkey", "o_orderkey", "previous_price")


@query(
    "wn3_prior_sum_orders",
    "SELECT o_custkey, o_orderkey, round(CAST(coalesce(sum(o_totalprice) OVER (PARTITION BY o_custkey "
    "ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DECIMAL(28, 10)), 2)::DOUBLE AS spent_before "
    "FROM orders",
)
def wn3_orders(spark, sf):
    before = running(
        _orders(spark, sf), ["o_custkey"], _by_date(), {"spent": F.col("o_totalprice")}, past_only=True
    )
    return before.select("o_custkey", "o_orderkey", round_half_up(F.coalesce("spent", F.lit(0.0)), 2).alias("spent_before"))


@query(
    "wn5_rolling_avg_orders",
    "SELECT o_custkey, o_orderkey, round(CAST(avg(o_totalprice) OVER (PARTITION BY o_custkey "
    "ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS DECIMAL(28, 10)), 4)::DOUBLE AS recent_avg FROM orders",
)
def wn5_orders(spark, sf):
    recent = rolling(_orders(spark, sf), ["o_custkey"], _by_date(), 5, {"recent_avg": F.avg("o_totalprice")})
    return recent.select("o_custkey", "o_orderkey", round_half_up(F.col("recent_avg"), 4).alias("recent_avg"))


@query(
    "wn12_rank_orders",
    "SELECT o_orderkey, o_orderpriority, rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS place "
    "FROM orders",
)
def wn12_orders(spark, sf):
    placed = ranked(_orders(spark, sf), ["o_orderpriority"], "o_totalprice", "place")
    return placed.select("o_orderkey", "o_orderpriority", "place")


@query(
    "top1_deduplicate",
    "SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderpriority FROM orders "
    "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
)
def top1(spark, sf):
    return topk.deduplicate(_orders(spark, sf), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])


@query(
    "top2_latest_per_key",
    "SELECT user_id, event_type, value FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def top2(spark, sf):
    return topk.latest_per_key(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], ["event_type", "value"])


@query(
    "top4_order_limit",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem "
    "ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 500",
)
def top4(spark, sf):
    lines = table(spark, sf, "lineitem").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey")
    return lines.select("l_orderkey", "l_linenumber", "l_extendedprice").limit(500)


@query(
    "top5_column_values",
    "SELECT source AS value, count(*) AS n FROM documents WHERE lang = 'en' GROUP BY source "
    "ORDER BY n DESC, value LIMIT 10",
)
def top5(spark, sf):
    return topk.column_values(table(spark, sf, "documents"), "source", max_records=10, where="lang = 'en'")


@query(
    "top6_single_value",
    "SELECT c_custkey, (SELECT o_orderpriority FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1) AS top_priority, "
    "coalesce((SELECT o_orderstatus FROM orders WHERE o_totalprice < 0 LIMIT 1), 'none') AS refund FROM customer",
)
def top6(spark, sf):
    orders = table(spark, sf, "orders")
    priority = orders.select("o_orderpriority", "o_totalprice", "o_orderkey")
    refunds = orders.where("o_totalprice < 0").select("o_orderstatus", "o_orderkey")
    customers = table(spark, sf, "customer").select("c_custkey")
    first = topk.with_single_value(customers, priority, [F.desc("o_totalprice"), "o_orderkey"], "top_priority")
    return topk.with_single_value(first, refunds, ["o_orderkey"], "refund", default="none")


# --- sets -------------------------------------------------------------------------------


@query(
    "set1_union_relations",
    "SELECT 'customer' AS source_relation, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation, "
    "c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer UNION ALL "
    "SELECT 'supplier', s_name, CAST(s_nationkey AS VARCHAR), NULL, s_acctbal FROM supplier",
)
def set1(spark, sf):
    customers = projection.select_renamed(
        table(spark, sf, "customer"), key="c_custkey", name="c_name", nation="c_nationkey", segment="c_mktsegment"
    )
    suppliers = projection.select_renamed(
        table(spark, sf, "supplier"), key="s_suppkey", name="s_name", nation="s_nationkey", balance="s_acctbal"
    )
    return sets.union_relations(
        {"customer": customers, "supplier": suppliers}, column_override={"nation": "string"}, exclude=["KEY"]
    )


@query(
    "set1_union_where",
    "SELECT n_name AS name, n_regionkey AS region FROM nation WHERE n_regionkey = 1 UNION ALL "
    "SELECT r_name, r_regionkey FROM region WHERE r_regionkey = 1",
)
def set1_where(spark, sf):
    nations = projection.select_renamed(table(spark, sf, "nation"), name="n_name", region="n_regionkey", key="n_nationkey")
    regions = projection.select_renamed(table(spark, sf, "region"), name="r_name", region="r_regionkey")
    return sets.union_relations(
        {"nation": nations, "region": regions}, include=["Name", "REGION"], source_column=None, where="region = 1"
    )


@query(
    "set2_union_by_pattern",
    "SELECT 'set2_orders_' || year(o_orderdate) AS source, o_orderkey, o_totalprice FROM orders",
)
def set2(spark, sf):
    orders = table(spark, sf, "orders")
    first, last = orders.agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    for year in range(first, last + 1):
        part = orders.where(F.year("o_orderdate") == year).select("o_orderkey", "o_totalprice")
        part.createOrReplaceTempView(f"set2_orders_{year}")
    return sets.union_by_pattern(spark, "%", "SET2_orders_%", exclude="%_old", temporary=True, source_column="source")


@query(
    "set2_union_files",
    "SELECT 'status_' || o_orderstatus AS part, o_orderkey, o_totalprice, "
    "CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority FROM orders",
)
def set2_files(spark, sf):
    base = scratch_path(spark, "files")
    # one write for all: a folder per status
    status = F.concat(F.lit("status_"), F.col("o_orderstatus")).alias("file")
    priority = F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("o_orderpriority")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", priority, status)
    orders.write.partitionBy("file").parquet(base)
    union = sets.union_files(spark, f"{base}/file=status_*", source_column="file")
    return union.withColumn("part", F.regexp_extract("file", "status_[A-Z]", 0)).drop("file")


@query(
    "set3_except",
    "SELECT DISTINCT l_partkey AS part, l_suppkey AS supplier FROM lineitem WHERE l_returnflag = 'R' EXCEPT "
    "SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'",
)
def set3(spark, sf):
    pairs = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), "l_returnflag"
    )
    side = lambda flag: pairs.where(F.col("l_returnflag") == flag).drop("l_returnflag")
    return sets.difference(side("R"), side("A"))


@query(
    "set4_union_all",
    "SELECT which_diff, nation FROM (SELECT 'a_minus_b' AS which_diff, * FROM (SELECT c_nationkey AS nation FROM customer "
    "WHERE c_acctbal < 0 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal < 0) UNION ALL "
    "SELECT 'b_minus_a', * FROM (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0 EXCEPT "
    "SELECT c_nationkey FROM customer WHERE c_acctbal < 0))",
)
def set4(spark, sf):
    customers = table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_nationkey").alias("nation"))
    suppliers = table(spark, sf, "supplier").where("s_acctbal < 0").select(F.col("s_nationkey").alias("nation"))
    return sets.both_differences(customers, suppliers)


@query(
    "set5_unpivot",
    "SELECT o_orderkey, o_orderdate, 'o_orderstatus' AS prop, o_orderstatus AS val FROM orders UNION ALL "
    "SELECT o_orderkey, o_orderdate, 'o_orderpriority', o_orderpriority FROM orders UNION ALL "
    "SELECT o_orderkey, o_orderdate, 'large', CAST(o_totalprice > 250000 AS VARCHAR) FROM orders UNION ALL "
    "SELECT o_orderkey, o_orderdate, 'o_custkey', CAST(nullif(o_custkey % 10, 0) AS VARCHAR) FROM orders",
)
def set5(spark, sf):
    orders = table(spark, sf, "orders").withColumns(
        {"large": F.col("o_totalprice") > 250000, "o_custkey": F.nullif(F.col("o_custkey") % 10, F.lit(0))}
    )
    return sets.unpivot(
        orders,
        exclude=["O_ORDERKEY", "o_orderdate"],
        remove=["O_TotalPrice"],
        field_name="prop",
        value_name="val",
    )


# --- generators -------------------------------------------------------------------------


@query(
    "gen1_series_gaps",
    "SELECT g AS generated_number FROM (SELECT unnest(generate_series(1, (SELECT max(o_orderkey) FROM orders))) AS g) "
    "WHERE g NOT IN (SELECT l_orderkey FROM lineitem)",
)
def gen1(spark, sf):
    top = table(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0]
    used = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("generated_number"))
    return joins.anti_join(generators.generate_series(spark, top), used, ["generated_number"])


@query(
    "gen2_date_spine",
    "SELECT d AS date_day, coalesce(orders, 0) AS orders FROM (SELECT unnest(generate_series("
    "(SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d) "
    "LEFT JOIN (SELECT o_orderdate, count(*) AS orders FROM orders GROUP BY ALL) ON o_orderdate = d",
)
def gen2(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderdate", "date_day")
    first, last = orders.agg(F.min("date_day"), F.max("date_day")).first()
    spine = generators.date_spine(spark, "day", first, last)
    counted = joins.aggregate_then_join(spine, orders, ["date_day"], [F.count(F.lit(1)).alias("orders")])
    return counted.withColumn("orders", F.coalesce("orders", F.lit(0)))


@query(
    "gen2_month_spine",
    "SELECT unnest(generate_series(date_trunc('month', (SELECT min(o_orderdate) FROM orders)), "
    "date_trunc('month', (SELECT max(o_orderdate) FROM orders)), INTERVAL 1 MONTH)) AS date_month",
)
def gen2_month(spark, sf):
    return generators.spine_over(table(spark, sf, "orders"), "o_orderdate", "month")

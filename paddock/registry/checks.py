"""Data checks over the tables; most bindings are chosen so that some rows fail."""

from __future__ import annotations

from pyspark.sql import functions as F

from paddock.operators import checks, suite
from paddock.plans import declared_checks, models, race_view
from paddock.plans.race_view import table
from paddock.registry import query, rounded
from paddock.registry.race_sql import race_sql
from paddock.session import scratch_path
from paddock.sources.sinks import materialize_table


@query(
    "dq1_accepted_range",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT l_quantity > 2 OR NOT l_quantity < 49",
)
def dq1(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return checks.accepted_range(lines, "l_quantity", 2, 49, inclusive=False)


@query(
    "dq2_at_least_one",
    "SELECT user_id, day, count(v) AS non_null FROM (SELECT user_id, CAST(ts AS DATE) AS day, "
    "CASE WHEN event_type = 'purchase' THEN value END AS v FROM events) GROUP BY ALL HAVING count(v) = 0",
)
def dq2(spark, sf):
    bought = F.when(F.col("event_type") == "purchase", F.col("value")).alias("v")
    events = table(spark, sf, "events").select("user_id", F.col("ts").cast("date").alias("day"), bought)
    return checks.at_least_one(events, "v", ["user_id", "day"])


_CARD_A = "SELECT c_nationkey % 5 AS value, count(*) AS num_rows FROM customer GROUP BY ALL"
_CARD_B = "SELECT s_nationkey % 5 AS value, count(*) AS num_rows FROM supplier GROUP BY ALL"


@query(
    "dq3_cardinality_equality",
    f"(({_CARD_A}) EXCEPT ({_CARD_B})) UNION ALL (({_CARD_B}) EXCEPT ({_CARD_A}))",
)
def dq3(spark, sf):
    customers = table(spark, sf, "customer").select((F.col("c_nationkey") % 5).alias("nation"))
    suppliers = table(spark, sf, "supplier").select((F.col("s_nationkey") % 5).alias("home"))
    return checks.cardinality_equality(customers, "nation", suppliers, "home")


# customers without orders are on one side only
_GROUPS = (
    "(SELECT c_custkey AS customer_a, count(*) AS count_a FROM customer GROUP BY ALL) "
    "FULL JOIN (SELECT o_custkey AS customer_b, count(*) AS count_b FROM orders GROUP BY ALL) ON customer_a = customer_b"
)


def _customers(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("customer"))
    return customers, table(spark, sf, "orders").select(F.col("o_custkey").alias("customer"))


@query(
    "dq4_equal_rowcount",
    f"SELECT customer_a, customer_b, count_a, count_b, abs(count_a - count_b) AS diff_count FROM {_GROUPS}",
)
def dq4(spark, sf):
    return checks.equal_rowcount(*_customers(spark, sf), group_by=["customer"])


@query(
    "dq4_equal_rowcount_strict",
    "SELECT count_a, count_b, abs(count_a - count_b) AS diff_count FROM "
    "(SELECT count(*) AS count_a FROM orders), (SELECT count(*) AS count_b FROM lineitem)",
)
def dq4_strict(spark, sf):
    return checks.equal_rowcount(table(spark, sf, "orders"), table(spark, sf, "lineitem"), count_missing=True)


_FIRST = "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem WHERE l_linenumber = 1"
_SECOND = "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem WHERE l_linenumber = 2"


@query(
    "dq5_equality",
    f"SELECT 'a_minus_b' AS which_diff, * FROM (({_FIRST}) EXCEPT ({_SECOND})) UNION ALL "
    f"SELECT 'b_minus_a', * FROM (({_SECOND}) EXCEPT ({_FIRST}))",
)
def dq5(spark, sf):
    lines = table(spark, sf, "lineitem")
    first, second = lines.where("l_linenumber = 1"), lines.where("l_linenumber = 2")
    return checks.equality(first, second, ["l_partkey", "l_returnflag"])


@query(
    "dq5_equality_by_digests",
    f"SELECT 'a_minus_b' AS which_diff, * FROM (({_FIRST}) EXCEPT ({_SECOND})) UNION ALL "
    f"SELECT 'b_minus_a', * FROM (({_SECOND}) EXCEPT ({_FIRST}))",
)
def dq5_digests(spark, sf):
    lines = table(spark, sf, "lineitem")
    first, second = lines.where("l_linenumber = 1"), lines.where("l_linenumber = 2")
    return checks.equality(first, second, ["l_partkey", "l_returnflag"], range_key="l_partkey")


_CORRECTED = (
    "SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate < DATE '1995-06-01' AND o_orderstatus = 'F' THEN "
    "o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate FROM orders"
)
_STORED = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders"


@query(
    "dq5_reconciled_orders",
    f"SELECT 'a_minus_b' AS which_diff, * FROM (({_STORED}) EXCEPT ALL ({_CORRECTED})) UNION ALL "
    f"SELECT 'b_minus_a', * FROM (({_CORRECTED}) EXCEPT ALL ({_STORED}))",
)
def dq5_reconciled(spark, sf):
    """Orders against a copy in which old prices were corrected; other ranges of dates are not compared by rows."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    old = (F.col("o_orderdate") < "1995-06-01") & (F.col("o_orderstatus") == "F")
    price = F.when(old, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    stored, corrected = orders.drop("o_orderstatus"), orders.withColumn("o_totalprice", price).drop("o_orderstatus")
    return checks.equality(stored, corrected, keep_duplicates=True, range_key="o_orderdate")


@query(
    "dq5_equality_with_duplicates",
    "SELECT 'a_minus_b' AS which_diff, * FROM (SELECT l_suppkey, l_quantity FROM lineitem WHERE l_returnflag = 'R' "
    "EXCEPT ALL SELECT l_suppkey, l_quantity FROM lineitem WHERE l_returnflag = 'A') UNION ALL "
    "SELECT 'b_minus_a', * FROM (SELECT l_suppkey, l_quantity FROM lineitem WHERE l_returnflag = 'A' "
    "EXCEPT ALL SELECT l_suppkey, l_quantity FROM lineitem WHERE l_returnflag = 'R')",
)
def dq5_duplicates(spark, sf):
    lines = table(spark, sf, "lineitem")
    returned, accepted = lines.where("l_returnflag = 'R'"), lines.where("l_returnflag = 'A'")
    return checks.equality(returned, accepted, ["l_suppkey", "l_quantity"], keep_duplicates=True)


@query(
    "dq6_expression_is_true",
    "SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE NOT (l_discount + l_tax <= 0.15)",
)
def dq6(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return checks.expression_is_true(lines, "+ l_tax <= 0.15D", column="l_discount")


@query(
    "dq7_fewer_rows_than",
    "SELECT customer_a, customer_b, count_a, count_b, CAST(CASE WHEN count_a > count_b THEN count_a - count_b "
    f"WHEN count_a = count_b THEN 1 ELSE 0 END AS BIGINT) AS row_count_delta FROM {_GROUPS}",
)
def dq7(spark, sf):
    return checks.fewer_rows_than(*_customers(spark, sf), group_by=["customer"])


def _ranges_sql(compare: str, source: str, partition: str, key: str = "") -> str:
    return (
        f"SELECT {key}lower_bound, upper_bound, next_lower_bound, is_last_record, "
        "lower_bound < upper_bound AS bounds_ordered, "
        f"coalesce(upper_bound {compare} next_lower_bound, is_last_record) AS next_follows FROM (SELECT *, "
        f"lead(lower_bound) OVER ({partition} ORDER BY lower_bound, upper_bound) AS next_lower_bound, "
        f"lead(1) OVER ({partition} ORDER BY lower_bound, upper_bound) IS NULL AS is_last_record FROM ({source})) "
        f"WHERE NOT (coalesce(lower_bound < upper_bound, false) "
        f"AND coalesce(upper_bound {compare} next_lower_bound, is_last_record))"
    )


@query(
    "dq8_mutually_exclusive_ranges",
    _ranges_sql(
        "<=",
        "SELECT o_custkey AS partition_by_col, o_orderdate AS lower_bound, o_orderdate + INTERVAL 60 DAY AS upper_bound "
        "FROM orders",
        "PARTITION BY partition_by_col",
        "partition_by_col, ",
    ),
)
def dq8(spark, sf):
    until = F.col("o_orderdate") + F.expr("INTERVAL 60 DAY")
    return checks.mutually_exclusive_ranges(table(spark, sf, "orders"), "o_orderdate", until, "o_custkey")


@query(
    "dq8_ranges_without_gaps",
    _ranges_sql(
        "=",
        "SELECT o_orderkey AS lower_bound, o_orderkey + 1 + CAST(o_orderkey % 97 = 0 AS BIGINT) AS upper_bound FROM orders",
        "",
    ),
)
def dq8_global(spark, sf):
    upper = F.col("o_orderkey") + 1 + (F.col("o_orderkey") % 97 == 0).cast("long")
    return checks.mutually_exclusive_ranges(table(spark, sf, "orders"), "o_orderkey", upper, gaps="not_allowed")


@query(
    "dq9_not_accepted_values",
    "SELECT DISTINCT event_type AS value_field FROM events WHERE event_type IN ('error', 'refund')",
)
def dq9(spark, sf):
    return checks.not_accepted_values(table(spark, sf, "events"), "event_type", ["error", "refund"])


@query(
    "dq10_not_constant",
    "SELECT user_id, day, count(DISTINCT event_type) AS distinct_values FROM "
    "(SELECT *, CAST(ts AS DATE) AS day FROM events) GROUP BY ALL HAVING count(DISTINCT event_type) = 1",
)
def dq10(spark, sf):
    events = table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    return checks.not_constant(events, "event_type", ["user_id", "day"])


@query(
    "dq11_not_empty_string",
    "SELECT trim(replace(o_orderstatus, 'P', '  ')) AS status FROM orders WHERE trim(replace(o_orderstatus, 'P', '  ')) = ''",
)
def dq11(spark, sf):
    status = F.replace("o_orderstatus", F.lit("P"), F.lit("  ")).alias("status")
    return checks.not_empty_string(table(spark, sf, "orders").select(status), "status")


@query(
    "dq12_not_null_proportion",
    "SELECT user_id, round(CAST(avg(CASE WHEN event_type <> 'error' THEN 1.0 ELSE 0.0 END) AS DECIMAL(28, 10)), 6)::DOUBLE AS not_null_proportion "
    "FROM events GROUP BY ALL HAVING avg(CASE WHEN event_type <> 'error' THEN 1.0 ELSE 0.0 END) < 0.75 "
    "OR avg(CASE WHEN event_type <> 'error' THEN 1.0 ELSE 0.0 END) > 0.85",
)
def dq12(spark, sf):
    events = table(spark, sf, "events").withColumn("good", F.nullif("event_type", F.lit("error")))
    return rounded(checks.not_null_proportion(events, "good", 0.75, 0.85, ["user_id"]))


@query(
    "dq13_recency",
    "SELECT o_custkey, max(o_orderdate) AS most_recent, TIMESTAMP '2001-08-01' - INTERVAL 6 MONTH AS threshold "
    "FROM orders GROUP BY ALL HAVING max(o_orderdate) < TIMESTAMP '2001-08-01' - INTERVAL 6 MONTH",
)
def dq13(spark, sf):
    as_of = F.lit("2001-08-01").cast("timestamp_ntz")
    return checks.recency(table(spark, sf, "orders"), "o_orderdate", "month", 6, group_by=["o_custkey"], as_of=as_of)


@query(
    "dq13_recency_without_time",
    "SELECT user_id, CAST(max(ts) AS DATE) AS most_recent, DATE '2024-01-30' AS threshold FROM events GROUP BY ALL "
    "HAVING CAST(max(ts) AS DATE) < DATE '2024-01-30'",
)
def dq13_date(spark, sf):
    as_of = F.lit("2024-01-31 10:00:00").cast("timestamp_ntz")
    events = table(spark, sf, "events")
    return checks.recency(events, "ts", "day", 1, ignore_time=True, group_by=["user_id"], as_of=as_of)


@query(
    "dq14_relationships_where",
    "SELECT l_suppkey AS id FROM lineitem WHERE l_quantity > 45 AND l_suppkey NOT IN "
    "(SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)",
)
def dq14(spark, sf):
    lines, suppliers = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    return checks.relationships_where(lines, "l_suppkey", suppliers, "s_suppkey", "l_quantity > 45", "s_acctbal > 0")


@query(
    "dq15_sequential_values",
    "SELECT event_type, event_id, previous_event_id FROM (SELECT event_type, event_id, lag(event_id) OVER "
    "(PARTITION BY event_type ORDER BY event_id) AS previous_event_id FROM events) WHERE event_id <> previous_event_id + 1",
)
def dq15(spark, sf):
    return checks.sequential_values(table(spark, sf, "events"), "event_id", group_by=["event_type"])


@query(
    "dq15_sequential_days",
    "SELECT * FROM (SELECT o_custkey, o_orderdate, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) "
    "AS previous_o_orderdate FROM orders) WHERE o_orderdate <> previous_o_orderdate + INTERVAL 1 DAY",
)
def dq15_days(spark, sf):
    orders = table(spark, sf, "orders")
    return checks.sequential_values(orders, "o_orderdate", 1, datepart="day", group_by=["o_custkey"])


@query(
    "dq16_unique_combination",
    "SELECT l_partkey, l_suppkey, count(*) AS n_records FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def dq16(spark, sf):
    return checks.unique_combination_of_columns(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


@query(
    "dq17_not_null",
    "SELECT o_orderkey, nullif(o_orderpriority, '1-URGENT') AS priority FROM orders WHERE o_orderpriority = '1-URGENT'",
)
def dq17(spark, sf):
    priority = F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority")
    return checks.not_null(table(spark, sf, "orders").select("o_orderkey", priority), "priority")


@query(
    "dq18_unique",
    "SELECT text, count(*) AS n_records FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1",
)
def dq18(spark, sf):
    return checks.unique(table(spark, sf, "documents").select("text"), "text")


@query(
    "dq19_accepted_values",
    "SELECT lang AS value_field, count(*) AS n_records FROM documents WHERE lang NOT IN ('en', 'de') GROUP BY ALL",
)
def dq19(spark, sf):
    return checks.accepted_values(table(spark, sf, "documents"), "lang", ["en", "de"])


@query(
    "dq20_assert_equal",
    "SELECT doc_id, n_chars, length(text) AS found FROM documents WHERE n_chars <> length(text) + (doc_id % 3) // 2",
)
def dq20(spark, sf):
    rows = table(spark, sf, "documents").select(
        "doc_id",
        "n_chars",
        F.length("text").cast("long").alias("found"),
        (F.length("text") + F.floor(F.col("doc_id") % 3 / 2)).alias("expected"),
    )
    return checks.assert_equal(rows, "n_chars", "expected").drop("expected")


_ENTRY = "season, round_number, driver_abbr"


@query(
    "dq22_no_orphan_laps",
    race_sql(f"SELECT {_ENTRY} FROM raw_laps ANTI JOIN (SELECT {_ENTRY} FROM raw_results "
             "WHERE NOT coalesce(is_dnf, false)) USING (season, round_number, driver_abbr)"),
)
def dq22(spark, sf):
    """Laps of drivers who have no result as finishers."""
    results = race_view.results(spark, sf).where(~F.coalesce("is_dnf", F.lit(False)))
    return checks.no_orphan_laps(race_view.laps(spark, sf), results)


@query(
    "dq23_valid_finish_positions",
    race_sql(
        "SELECT season, round_number, finish_position, driver_abbr FROM (SELECT season, round_number, driver_abbr, "
        "CASE WHEN finish_position % 7 = 0 THEN 7 ELSE finish_position END::DOUBLE AS finish_position FROM raw_results) "
        "QUALIFY finish_position < 1 OR finish_position > 30 "
        "OR count(*) OVER (PARTITION BY season, round_number, finish_position) > 1"
    ),
)
def dq23(spark, sf):
    position = F.col("finish_position")
    results = race_view.results(spark, sf).withColumn(
        "finish_position", F.when(position % 7 == 0, 7.0).otherwise(position)
    )
    return checks.valid_finish_positions(results)


_ORDER_SUITE = [
    suite.row_count_between(1, 1_000_000),
    suite.row_count_between(None, 10),
    suite.column_exists("O_OrderKey"),
    suite.column_exists("o_comment"),
    suite.columns_match_set(["o_orderkey", "o_custkey"]),
    suite.values_not_null("o_custkey"),
    suite.values_not_null("o_comment"),
    suite.values_between("o_totalprice", 1000, 400000),
    suite.compound_unique("o_custkey", "o_orderdate"),
]


def _suite_row(check: str, column: str, failing: str, observed: str) -> str:
    return (
        f"SELECT '{check}' AS check, '{column}' AS column, ({failing}) = 0 AS success, CAST(({observed}) AS BIGINT) "
        f"AS observed, CAST(({failing}) AS BIGINT) AS unexpected_count"
    )


_COUNT = "SELECT count(*) FROM orders"


def _single(name: str, expectation: suite.Expectation, sql: str) -> None:
    query(name, sql)(lambda spark, sf: suite.run_suite(table(spark, sf, "lineitem"), [expectation]))


_LINES = "SELECT count(*) FROM lineitem"
_COLUMNS = "(SELECT column_name AS name FROM (DESCRIBE lineitem))"

_single(
    "dq21_columns_match_set",
    suite.columns_match_set(["L_ORDERKEY", "l_partkey", "l_comment"]),
    _suite_row(
        "columns_match_set",
        "L_ORDERKEY,l_partkey,l_comment",
        f"""SELECT (SELECT count(*) FROM {_COLUMNS} WHERE lower(name) NOT IN ('l_orderkey', 'l_partkey', 'l_comment'))
            + (SELECT count(*) FROM (VALUES ('l_orderkey'), ('l_partkey'), ('l_comment')) AS wanted (wish)
               WHERE wish NOT IN (SELECT lower(name) FROM {_COLUMNS}))""",
        f"SELECT count(*) FROM {_COLUMNS}",
    ),
)
_single(
    "dq24_row_count_between",
    suite.row_count_between(1, 1000),
    _suite_row("row_count_between", "", f"SELECT CASE WHEN ({_LINES}) BETWEEN 1 AND 1000 THEN 0 ELSE 1 END", _LINES),
)
_single(
    "dq25_column_exists",
    suite.column_exists("l_shipdate"),
    _suite_row(
        "column_exists",
        "l_shipdate",
        f"SELECT CASE WHEN count(*) = 1 THEN 0 ELSE 1 END FROM {_COLUMNS} WHERE lower(name) = 'l_shipdate'",
        f"SELECT count(*) FROM {_COLUMNS}",
    ),
)
_single(
    "dq26_values_not_null",
    suite.values_not_null("l_shipdate"),
    _suite_row("not_null", "l_shipdate", "SELECT count(*) FROM lineitem WHERE l_shipdate IS NULL", _LINES),
)
_single(
    "dq27_values_between",
    suite.values_between("l_quantity", 1, 45),
    _suite_row("between", "l_quantity", "SELECT count(*) FROM lineitem WHERE l_quantity NOT BETWEEN 1 AND 45", _LINES),
)
_single(
    "dq28_compound_unique",
    suite.compound_unique("l_orderkey", "l_linenumber"),
    _suite_row(
        "compound_unique",
        "l_orderkey,l_linenumber",
        "SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber "
        "HAVING count(*) > 1)",
        _LINES,
    ),
)


_ORDER_SUITE_SQL = (
    " UNION ALL ".join(
        [
            _suite_row("row_count_between", "", "SELECT 0", _COUNT),
            _suite_row("row_count_between", "", "SELECT CASE WHEN count(*) > 10 THEN 1 ELSE 0 END FROM orders", _COUNT),
            _suite_row("column_exists", "O_OrderKey", "SELECT 0", "SELECT 6"),
            _suite_row("column_exists", "o_comment", "SELECT 1", "SELECT 6"),
            _suite_row("columns_match_set", "o_orderkey,o_custkey", "SELECT 4", "SELECT 6"),
            _suite_row("not_null", "o_custkey", "SELECT count(*) FROM orders WHERE o_custkey IS NULL", _COUNT),
            _suite_row("not_null", "o_comment", "SELECT 1", "SELECT 6"),
            _suite_row(
                "between",
                "o_totalprice",
                "SELECT count(*) FROM orders WHERE o_totalprice NOT BETWEEN 1000 AND 400000",
                _COUNT,
            ),
            _suite_row(
                "compound_unique",
                "o_custkey,o_orderdate",
                "SELECT sum(n) FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)",
                _COUNT,
            ),
        ]
    )
)


@query("dq29_run_suite", _ORDER_SUITE_SQL)
def dq29_orders(spark, sf):
    return suite.run_suite(table(spark, sf, "orders"), _ORDER_SUITE)


@query("dq29_suite_while_written", _ORDER_SUITE_SQL)
def dq29_while_written(spark, sf):
    """The suite of the orders, counted by the write of a copy."""
    orders, report = suite.suite_while_written(table(spark, sf, "orders"), _ORDER_SUITE)
    return report(materialize_table(orders, label="orders"))


_RAW = {
    "n": "SELECT count(*) FROM raw_results",
    "pos": "SELECT count(*) FROM raw_results WHERE finish_position NOT BETWEEN 1 AND 30",
    "round": "SELECT count(*) FROM raw_results WHERE round_number NOT BETWEEN 1 AND 24",
    "points": "SELECT count(*) FROM raw_results WHERE points NOT BETWEEN 0 AND 25",
    "dup": "SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM raw_results "
    "GROUP BY round_number, driver_abbr HAVING count(*) > 1)",
}


@query(
    "dq29_raw_results_suite",
    race_sql(
        " UNION ALL ".join(
            [
                _suite_row(
                    "row_count_between",
                    "",
                    "SELECT CASE WHEN count(*) BETWEEN 400 AND 600 THEN 0 ELSE 1 END FROM raw_results",
                    _RAW["n"],
                ),
                *[
                    _suite_row("column_exists", c, "SELECT 0", "SELECT 12")
                    for c in ("driver_abbr", "round_number", "finish_position", "grid_position", "points", "is_dnf")
                ],
                *[
                    _suite_row("not_null", c, f"SELECT count(*) FROM raw_results WHERE {c} IS NULL", _RAW["n"])
                    for c in ("driver_abbr", "round_number", "finish_position")
                ],
                _suite_row("between", "finish_position", _RAW["pos"], _RAW["n"]),
                _suite_row("between", "round_number", _RAW["round"], _RAW["n"]),
                _suite_row("between", "points", _RAW["points"], _RAW["n"]),
                _suite_row("compound_unique", "round_number,driver_abbr", _RAW["dup"], _RAW["n"]),
            ]
        )
    ),
)
def dq29(spark, sf):
    raw = materialize_table(race_view.results(spark, sf), label="results")
    return suite.run_suite(raw, declared_checks.RAW_RESULTS_SUITE)


@query(
    "dq30_check_options",
    "SELECT count(*) AS metric, CASE WHEN count(*) > 1000000000000 THEN 'error' WHEN count(*) > 10 THEN 'warn' "
    "ELSE 'pass' END AS verdict FROM lineitem WHERE l_returnflag = 'R' AND NOT l_quantity <= 40",
)
def dq30(spark, sf):
    return suite.evaluate(
        checks.accepted_range,
        table(spark, sf, "lineitem"),
        "l_quantity",
        high=40,
        where="l_returnflag = 'R'",
        warn_if="> 10",
        error_if="> 1000000000000",
    )


@query(
    "dq30_check_metric",
    "SELECT CAST(sum(coalesce(abs(count_a - count_b), 0)) AS BIGINT) AS metric, "
    f"CASE WHEN sum(coalesce(abs(count_a - count_b), 0)) <> 0 THEN 'error' ELSE 'pass' END AS verdict FROM {_GROUPS}",
)
def dq30_metric(spark, sf):
    customers, orders = _customers(spark, sf)
    return suite.evaluate(
        checks.equal_rowcount, customers, orders, ["customer"], fail_calc="sum(coalesce(diff_count, 0))"
    )


_ORACLE_NAME = {
    "races": "raw_races",
    "results": "raw_results",
    "lap_times": "raw_laps",
    "int_driver_cumulative_stats": "history",
    "int_driver_race_features": "features",
}


# Fixed values of the oracle, one line per relation: columns without NULL | ranges, ends included | unique key.
_DECLARED = """
races: season round_number | | season,round_number
results: driver_abbr round_number | |
lap_times: driver_abbr lap_number | |
stg_races: round_number | | season,round_number
stg_results: driver_abbr round_number grid_position | |
stg_lap_times: driver_abbr lap_time_seconds | |
int_driver_cumulative_stats: driver_abbr round_number prev_cumulative_points dnf_rate | dnf_rate 0 1 |
int_lap_analysis: driver_abbr round_number mean_lap_time | |
int_driver_race_features: driver_abbr round_number grid_log top3_rate dnf_rate team_reliability | top3_rate 0 1, dnf_rate 0 1, team_reliability 0 1 |
dim_drivers: driver_abbr driver_name current_team | | driver_abbr
dim_teams: team_name reliability_rate | reliability_rate 0 1 | team_name
dim_circuits: circuit_name country | circuit_dnf_rate 0 1 |
fct_race_results: driver_abbr round_number season finish_position points | finish_position 1 30, points 0 25 |
fct_championship_standings: driver_abbr round_number championship_position total_points | championship_position 1 30, total_points 0 1000 |
fct_driver_performance: driver_abbr wins podiums avg_finish | wins 0 24, podiums 0 72, avg_finish 1 30 |
fct_race_summary: round_number winner total_starters total_dnfs | total_starters 1 30, total_dnfs 0 30 | season,round_number
"""


def _declared_sql() -> str:
    parts = []

    def add(relation: str, check: str, column: str, failing: str) -> None:
        parts.append(
            f"SELECT '{relation}' AS relation, '{check}' AS check, '{column}' AS column, "
            f"CAST(({failing}) AS BIGINT) AS failures"
        )

    name = lambda relation: _ORACLE_NAME.get(relation, relation)
    for line in _DECLARED.strip().splitlines():
        relation, rest = line.split(":")
        columns, ranges, key = (part.strip() for part in rest.split("|"))
        for c in columns.split():
            add(relation, "not_null", c, f"SELECT count(*) FROM {name(relation)} WHERE {c} IS NULL")
        for c, low, high in (r.split() for r in ranges.split(",") if r):
            add(relation, "accepted_range", c, f"SELECT count(*) FROM {name(relation)} WHERE {c} < {low} OR {c} > {high}")
        if key:
            groups = f"SELECT 1 FROM {name(relation)} GROUP BY {key} HAVING count(*) > 1"
            add(relation, "unique", key, f"SELECT count(*) FROM ({groups})")
    orphans = f"FROM stg_lap_times ANTI JOIN stg_results USING ({_ENTRY})"
    add("stg_lap_times", "no_orphan_laps", "", f"SELECT count(*) {orphans}")
    positions = "FROM stg_results WHERE finish_position < 1 OR finish_position > 30"
    add("stg_results", "valid_finish_positions", "", f"SELECT count(*) {positions}")
    checked = " UNION ALL ".join(parts)
    return race_sql(f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'error' END AS verdict FROM ({checked})")


@query("dq31_run_checks", _declared_sql())
def dq31(spark, sf):
    results = materialize_table(race_view.results(spark, sf), label="results")
    laps = materialize_table(race_view.laps(spark, sf, with_numbers=True), label="laps")
    races = materialize_table(race_view.races(spark, sf), label="races")
    return declared_checks.run_checks(models.build(races, results, laps))


@query("dq31_counted_while_written", _declared_sql())
def dq31_counted(spark, sf):
    """The same report where row checks are counted by the writes of the relations."""
    raw = [
        materialize_table(frame, label="raw")
        for frame in (
            race_view.races(spark, sf), race_view.results(spark, sf), race_view.laps(spark, sf, with_numbers=True)
        )
    ]
    row_checks = declared_checks.RowChecks()
    relations = models.write_marts(models.build(*raw, row_checks), scratch_path(spark, "marts"), row_checks)
    return declared_checks.run_checks(relations, row_checks.found())

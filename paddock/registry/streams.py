"""Lap events sent as JSON and taken in again by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paddock.plans import race_view
from paddock.registry import query
from paddock.registry.race_sql import race_sql
from paddock.session import scratch_path
from paddock.streaming import lap_events



def _seconds(column: str) -> str:
    """Milliseconds as seconds, rounded half up on the decimal value as Spark does."""
    return f"CAST(round(CAST({column} / 1000.0::DOUBLE AS DECIMAL(18, 8)), 3) AS DOUBLE)"


_EVENTS = f"""
    SELECT season, round_number AS race_id, trim(race_name) AS race_name, driver_abbr, lap_number,
           {_seconds('lap_time_ms')} AS lap_time_sec, {_seconds('sector1_ms')} AS sector1_sec,
           {_seconds('sector2_ms')} AS sector2_sec, {_seconds('sector3_ms')} AS sector3_sec, is_personal_best
    FROM raw_laps JOIN raw_races USING (season, round_number)"""


def _events(spark: SparkSession, sf: str, cap: int | None) -> DataFrame:
    races = race_view.races(spark, sf).withColumn("race_name", F.trim("race_name"))
    return lap_events.lap_event_projection(race_view.laps(spark, sf, with_numbers=True), races, cap)


@query("st1_lap_event_projection", race_sql(_EVENTS))
def st1(spark, sf):
    return _events(spark, sf, cap=None)


@query(
    "st1_first_events",
    race_sql(f"SELECT * FROM ({_EVENTS}) ORDER BY season, race_id, lap_number, driver_abbr LIMIT 500"),
)
def st1_first(spark, sf):
    """The limit is the feature: the first events of the whole table."""
    return _events(spark, sf, cap=500)


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    """Every lap as one message whose id is the event's id, so the same lap always has the same id.

    Every seventh has no time.
    """
    at = F.when(F.col("event_id") % 7 != 0, F.col("ts").cast("timestamp"))
    laps = race_view.race_events(spark, sf).select(
        "season",
        F.col("round_number").alias("race_id"),
        F.concat(F.lit("U"), F.col("user_id")).alias("driver_abbr"),
        (F.col("event_id") % 60).alias("lap_number"),
        F.round("value", 3).alias("lap_time_sec"),
        F.when(F.col("event_id") % 5 != 0, F.round("value", 2)).alias("sector1_sec"),
        (F.col("event_type") == "purchase").alias("is_personal_best"),
        F.col("event_id").alias("number"),
        "event_id",
        "ts",
    )
    number = F.get_json_object("value", "$.number").cast("double")
    return lap_events.to_event(laps, id_fields=["number"], at=at).withColumn("number", number)


@query(
    "st2_to_event",
    """SELECT md5(CAST(CAST(event_id AS DOUBLE) AS VARCHAR)) <> '' AS has_id, CAST(event_id AS DOUBLE) AS number,
       'U' || user_id AS driver_abbr, CAST(event_id % 60 AS DOUBLE) AS lap_number,
       round(value, 3) AS lap_time_sec, CASE WHEN event_id % 5 <> 0 THEN round(value, 2) END AS sector1_sec,
       event_id % 5 = 0 AS null_is_sent, CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END::DOUBLE
       AS is_personal_best, CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS event_timestamp,
       1::BIGINT AS ids FROM events""",
)
def st2(spark, sf):
    """Every field of every message, and how many messages share its id."""
    messages = _messages(spark, sf)
    field = lambda name: F.get_json_object("value", f"$.{name}")
    fields = messages.select(
        (field("event_id") != "").alias("has_id"),
        "number",
        field("driver_abbr").alias("driver_abbr"),
        F.when(field("lap_number").contains("."), field("lap_number").cast("double")).alias("lap_number"),
        field("lap_time_sec").cast("double").alias("lap_time_sec"),
        field("sector1_sec").cast("double").alias("sector1_sec"),
        F.col("value").contains('"sector1_sec":null').alias("null_is_sent"),
        field("is_personal_best").cast("double").alias("is_personal_best"),
        field("event_timestamp").alias("event_timestamp"),
        field("event_id").alias("id"),
    )
    shared = fields.groupBy("id").agg(F.count(F.lit(1)).alias("ids"))
    return fields.join(shared, "id").drop("id")


_DELAY = "30 days"


def _sent(spark: SparkSession, sf: str, base: str) -> tuple[DataFrame, DataFrame]:
    """Write all messages, some twice, some broken; what is sent later: the same again, and late unique events."""
    messages = _messages(spark, sf)
    broken = messages.where(F.col("number") % 100 == 0).select(F.expr("substring(value, 1, 20)").alias("value"))
    again = messages.where(F.col("number") % 10 == 0).select("value")
    messages.select("value").unionAll(again).unionAll(broken).write.mode("append").text(f"{base}/in")
    old = race_view.race_events(spark, sf).where("event_id % 50 = 0").select(
        F.concat(F.lit("late"), F.col("user_id")).alias("driver_abbr"), (F.col("event_id") + 10**9).alias("number"), "ts"
    )
    at = F.col("ts").cast("timestamp") - F.expr("INTERVAL 400 DAYS")
    late = lap_events.to_event(old, id_fields=["number"], at=at).select("value")
    return again, late


def _received(spark: SparkSession, sf: str) -> DataFrame:
    """Stream every message in, with those sent twice."""
    base = scratch_path(spark, "stream")
    again, _ = _sent(spark, sf, base)
    events = lap_events.read_files(spark, f"{base}/in")
    lap_events.event_sink(events, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    again.write.mode("append").text(f"{base}/in")
    lap_events.event_sink(events, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out")


def _taken_in(spark: SparkSession, sf: str) -> str:
    """Folder of the tables of an intake in two runs; the second brings repeated and late events."""
    base = scratch_path(spark, "intake")
    again, late = _sent(spark, sf, base)
    messages = lap_events.read_messages(spark, f"{base}/in")
    lap_events.intake(messages, f"{base}/out", f"{base}/checkpoint", _DELAY).awaitTermination()
    again.unionAll(late).write.mode("append").text(f"{base}/in")
    lap_events.intake(messages, f"{base}/out", f"{base}/checkpoint", _DELAY).awaitTermination()
    return f"{base}/out"


_RECEIVED = """
    SELECT 'U' || user_id AS driver_code, CAST(event_id % 60 AS INTEGER) AS lap_number, round(value, 3) AS lap_time_sec,
           CASE WHEN event_id % 5 <> 0 THEN round(value, 2) END AS sector1_sec,
           event_type = 'purchase' AS is_personal_best, {n} AS copies
    FROM events"""


def _copies(received: DataFrame) -> DataFrame:
    columns = ["driver_code", "lap_number", "lap_time_sec", "sector1_sec", "is_personal_best"]
    return received.groupBy("event_id", *columns).agg(F.count(F.lit(1)).alias("copies")).select(*columns, "copies")


@query(
    "st3_read_events",
    _RECEIVED.format(n="CASE WHEN event_id % 10 = 0 THEN 3 ELSE 1 END::BIGINT")
    + " UNION ALL SELECT 'broken', NULL, NULL, NULL, NULL, count(*) FROM events WHERE event_id % 100 = 0",
)
def st3(spark, sf):
    """Every event as often as it was sent, and the number of broken messages."""
    base = scratch_path(spark, "broken")
    _sent(spark, sf, base)
    broken = lap_events.broken_messages(spark.read.text(f"{base}/in")).agg(F.count(F.lit(1)).alias("copies"))
    events = _copies(_received(spark, sf))
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema.fields[1:-1]]
    return events.unionAll(broken.select(F.lit("broken").alias("driver_code"), *empty, "copies"))


@query(
    "st4_event_sink",
    "SELECT 'U' || user_id AS driver_code, CAST(sum(CASE WHEN event_id % 10 = 0 THEN 3 ELSE 1 END) AS BIGINT) AS events "
    "FROM events GROUP BY ALL",
)
def st4(spark, sf):
    return _received(spark, sf).groupBy("driver_code").agg(F.count(F.lit(1)).alias("events"))


@query(
    "st5_dedup_by_event_id",
    """SELECT 'kept' AS output, 'U' || user_id AS driver_code, count(*) AS events,
           min(CASE WHEN event_id % 7 <> 0 THEN ts END) AS oldest FROM events GROUP BY ALL
    UNION ALL
    SELECT 'late', 'late' || user_id, count(*), min(ts) - INTERVAL 400 DAYS FROM events WHERE event_id % 50 = 0 GROUP BY ALL
    UNION ALL
    SELECT 'broken', NULL, count(*), NULL FROM events WHERE event_id % 100 = 0""",
)
def st5(spark, sf):
    """Events kept once, late ones (all unique) and broken messages, per driver."""
    path = _taken_in(spark, sf)
    counts = [F.count(F.lit(1)).alias("events"), F.min("event_timestamp").cast("timestamp_ntz").alias("oldest")]
    found = [
        lap_events.read_intake(spark, path, output).groupBy("driver_code").agg(*counts)
        .select(F.lit(label).alias("output"), "driver_code", "events", "oldest")
        for output, label in (("events", "kept"), ("late", "late"))
    ]
    broken = lap_events.read_intake(spark, path, "broken").agg(F.count(F.lit(1)).alias("events")).select(
        F.lit("broken").alias("output"), F.lit(None).cast("string").alias("driver_code"), "events",
        F.lit(None).cast("timestamp_ntz").alias("oldest"),
    )
    return found[0].unionAll(found[1]).unionAll(broken)


@query(
    "snk7_stream_append",
    "SELECT 'U' || user_id AS driver_code, count(*) AS events, max(CASE WHEN event_id % 7 <> 0 THEN ts END) AS newest "
    "FROM events GROUP BY ALL",
)
def snk7(spark, sf):
    received = lap_events.read_intake(spark, _taken_in(spark, sf), "events")
    newest = F.max("event_timestamp").cast("timestamp_ntz")
    return received.groupBy("driver_code").agg(F.count(F.lit(1)).alias("events"), newest.alias("newest"))

"""Lap events: from the raw tables to JSON messages, and from a stream back to a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from paddock.functions.scalars import surrogate_key, to_seconds
from paddock.schemas import LAP_EVENT
from paddock.session import scratch_scope
from paddock.sources.sinks import materialize_table, versions

WRITE_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timeZone": "UTC", "ignoreNullFields": "false"}
# A sender may leave out the fraction when it is zero.
READ_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]", "timeZone": "UTC"}


def lap_event_projection(laps: DataFrame, races: DataFrame, cap: int | None = None) -> DataFrame:
    """Laps with their race, in seconds; a round number counts within its season.

    With a ``cap`` only the first laps by season, race, lap and driver are given: Spark keeps
    the first rows per task and merges them, without a full sort. Without one, rows are not
    ordered.
    """
    named = races.select("season", "round_number", "race_name")
    seconds = {"lap_time_sec": "lap_time_ms", **{f"sector{i}_sec": f"sector{i}_ms" for i in (1, 2, 3)}}
    events = laps.join(named, ["season", "round_number"]).select(
        "season",
        F.col("round_number").alias("race_id"),
        "race_name",
        "driver_abbr",
        "lap_number",
        *[to_seconds(F.col(ms), 3).alias(name) for name, ms in seconds.items()],
        "is_personal_best",
    )
    return events if cap is None else events.orderBy("season", "race_id", "lap_number", "driver_abbr").limit(cap)


def _numbers_as_double(df: DataFrame) -> list[Column]:
    as_double = lambda f: isinstance(f.dataType, (T.NumericType, T.BooleanType))
    return [F.col(f.name).cast("double").alias(f.name) if as_double(f) else F.col(f.name) for f in df.schema.fields]


def to_event(rows: DataFrame, id_fields: list[str] | None = None, at: Column | None = None) -> DataFrame:
    """Messages ``value``: the row as JSON with an event id and a UTC time, numbers as floats.

    The id is random; with ``id_fields`` it is a hash of these fields, so a repeated run
    sends the same ids.
    """
    event_id = F.expr("uuid()") if id_fields is None else surrogate_key(id_fields)
    stamped = rows.withColumns({"event_id": event_id, "event_timestamp": F.current_timestamp() if at is None else at})
    body = F.struct(*_numbers_as_double(stamped))
    return stamped.select(F.to_json(body, WRITE_OPTIONS).alias("value"))


def send_to_kafka(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Write messages to a topic; needs the Kafka connector on the class path."""
    sink = messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    sink.options(**options).save()


def _parsed(messages: DataFrame) -> DataFrame:
    """``value`` and the event in it, NULL where there is none."""
    event = F.from_json(F.col("value").cast("string"), LAP_EVENT, READ_OPTIONS)
    return messages.select("value", event.alias("e")).select(
        "value", F.when(F.col("e.event_id").isNotNull(), F.col("e")).alias("e")
    )


def _typed(events: DataFrame) -> DataFrame:
    return events.withColumns(
        {
            "season": F.col("season").cast("int"),
            "race_id": F.col("race_id").cast("int"),
            "lap_number": F.col("lap_number").cast("int"),
            "is_personal_best": F.col("is_personal_best").cast("boolean"),
        }
    )


def parse_events(messages: DataFrame) -> DataFrame:
    """Typed events from ``value``; what is no event is given by ``broken_messages``."""
    return _typed(_parsed(messages).where("e IS NOT NULL").select("e.*"))


def broken_messages(messages: DataFrame) -> DataFrame:
    """The ``value`` of messages that hold no event: no JSON, or no event id."""
    return _parsed(messages).where("e IS NULL").select("value")


def read_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages of a topic from the earliest offset; needs the Kafka connector on the class path.

    They are given unread, so what is no event is not lost: ``intake`` keeps it, and
    ``parse_events`` and ``broken_messages`` tell the two apart.
    """
    source = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return source.option("startingOffsets", "earliest").options(**options).load().select("value")


def read_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Messages from a folder of text files with one JSON message per line."""
    source = spark.readStream.format("text")
    if max_files is not None:
        source = source.option("maxFilesPerTrigger", str(max_files))
    return source.load(path)


def read_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Events from a folder of text files with one JSON message per line."""
    return parse_events(read_messages(spark, path, max_files))


def deduplicated(events: DataFrame, delay: str | None) -> DataFrame:
    """Events with a new id.

    With a ``delay`` ids are kept for that much event time, so the state stays bounded, and
    events that arrive later than that behind the newest one are dropped; ``intake`` keeps
    them. None keeps every id and every event; the state then grows with the stream.
    """
    if delay is None:
        return events.dropDuplicates(["event_id"])
    return events.withWatermark("event_timestamp", delay).dropDuplicatesWithinWatermark(["event_id"])


def sink_columns(events: DataFrame) -> DataFrame:
    """Columns of the event table."""
    return events.select(
        "event_id",
        "season",
        "race_id",
        "race_name",
        F.col("driver_abbr").alias("driver_code"),
        "lap_number",
        "lap_time_sec",
        "sector1_sec",
        "sector2_sec",
        "sector3_sec",
        "is_personal_best",
        "event_timestamp",
    )


def event_sink(events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append events to a parquet table; offsets and written files are kept in ``checkpoint``.

    The default trigger takes everything available and stops.
    """
    writer = sink_columns(events).writeStream.format("parquet").outputMode("append").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


OUTPUTS = ("events", "late", "broken")
_EVENT = (
    "event_id string, season int, race_id int, race_name string, driver_code string, lap_number int, "
    "lap_time_sec double, sector1_sec double, sector2_sec double, sector3_sec double, "
    "is_personal_best boolean, event_timestamp timestamp"
)
_SCHEMAS = {"events": _EVENT, "late": _EVENT, "broken": "value string"}


def intake(messages: DataFrame, path: str, checkpoint: str, delay: str, trigger: dict | None = None) -> StreamingQuery:
    """Take in messages without losing any: new events, late ones and broken ones, a table each below ``path``.

    An event is stored once by its id. An event more than ``delay`` behind the newest one
    of earlier batches goes to ``late``, repeated or not, since ids are compared with stored
    events of the last ``delay`` only (days of events are folders, so no more is read).
    Events without a time are in time; their ids are also compared with all stored events
    without one.

    A batch writes folders of its own number and, when all are written, its line in the batch
    log: readers see the batches of the log. A batch that is run again compares with the
    batches before it, as it did the first time, and replaces what it wrote; one that is in
    the log already is left as it is.
    """
    spark = messages.sparkSession
    if _committed(spark, path) is not None and not _exists(spark, checkpoint):
        raise ValueError(f"the tables below {path} belong to another checkpoint; batch numbers would repeat")

    def store(batch: DataFrame, number: int) -> None:
        with scratch_scope(batch.sparkSession):
            store_batch(batch, number, path, delay)

    writer = messages.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def store_batch(batch: DataFrame, number: int, path: str, delay: str) -> None:
    """Store one batch of messages; what it gives depends on the batches before it only."""
    spark = batch.sparkSession
    done = _committed(spark, path)
    if done is not None and number <= done:
        return
    parsed = materialize_table(_parsed(batch), label="batch")
    newest = None if number == 0 else _log(spark, path, number - 1)["newest"]
    events = sink_columns(_typed(parsed.where("e IS NOT NULL").select("e.*")))
    stored = _stored(spark, path, "events").where(F.col("batch") < number)
    in_time = F.lit(True)
    if newest is not None:
        bound = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        in_time = F.coalesce(F.col("event_timestamp") >= bound, F.lit(True))
        stored = stored.where(F.col("day").isNull() | (F.col("day") >= F.to_date(bound)))
    fresh = events.where(in_time).dropDuplicates(["event_id"]).join(stored.select("event_id"), "event_id", "left_anti")
    folder = f"batch={number}"
    _write(fresh.withColumn("day", F.to_date("event_timestamp")), f"{path}/events/{folder}", "day")
    _write(events.where(~in_time), f"{path}/late/{folder}")
    _write(parsed.where("e IS NULL").select("value"), f"{path}/broken/{folder}")
    top = events.agg(F.greatest(F.max("event_timestamp"), F.lit(newest).cast("timestamp")).cast("string").alias("newest"))
    _write(top, f"{path}/log/{folder}")


def _write(rows: DataFrame, folder: str, *partitions: str) -> None:
    rows.write.mode("overwrite").partitionBy(*partitions).parquet(folder)


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def _committed(spark: SparkSession, path: str) -> int | None:
    """Number of the last batch of the log; batches end one after the other, so all before it are there."""
    found = versions(spark, f"{path}/log", "batch")
    return found[-1] if found else None


def _log(spark: SparkSession, path: str, number: int) -> Row:
    """Line of one batch: the newest event time up to it."""
    return spark.read.schema("newest string").parquet(f"{path}/log/batch={number}").first()


def _stored(spark: SparkSession, path: str, output: str) -> DataFrame:
    """Everything batches wrote, finished or not, with ``batch`` (and ``day``)."""
    kind = f"{_SCHEMAS[output]}, batch int" + (", day date" if output == "events" else "")
    if not _exists(spark, f"{path}/{output}"):
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).option("basePath", f"{path}/{output}").parquet(f"{path}/{output}")


def read_intake(spark: SparkSession, path: str, output: str) -> DataFrame:
    """One of the tables ``intake`` writes, ``events``, ``late`` or ``broken``: the rows of finished batches."""
    if output not in OUTPUTS:
        raise ValueError(f"output must be one of {OUTPUTS}")
    last = _committed(spark, path)
    finished = F.lit(False) if last is None else F.col("batch") <= last
    return _stored(spark, path, output).where(finished).drop("batch", "day")

"""Lap events through JSON files and back."""

import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from paddock import schemas
from paddock.streaming import lap_events


@pytest.fixture(scope="module")
def projection(frame):
    laps = frame(
        [
            (2025, r, d, n, 91234.56, 30100.0, None, 30900.4, "SOFT", 1, n == 1, None)
            for r in (1, 2)
            for d in ("VER", "HAM")
            for n in (1, 2, 3)
        ],
        schemas.LAP_TIMES,
    )
    races = frame([(2025, 1, "One", "", "", None, None), (2025, 2, "Two", "", "", None, None)], schemas.RACES)
    return lambda cap: lap_events.lap_event_projection(laps, races, cap)


def test_projection(projection):
    first = [tuple(r) for r in projection(3).collect()]
    assert first == [
        (2025, 1, "One", "HAM", 1, 91.235, 30.1, None, 30.9, True),
        (2025, 1, "One", "VER", 1, 91.235, 30.1, None, 30.9, True),
        (2025, 1, "One", "HAM", 2, 91.235, 30.1, None, 30.9, False),
    ]
    assert projection(None).count() == 12


def test_no_event_is_left_out_by_default(frame):
    laps = frame([(s, 1, 'A', n, 9e4, None, None, None, 'S', 1, False, None) for s in (2024, 2025) for n in range(400)], schemas.LAP_TIMES)
    races = frame([(s, 1, 'One', '', '', None, None) for s in (2024, 2025)], schemas.RACES)
    assert lap_events.lap_event_projection(laps, races).count() == 800
    cut = lap_events.lap_event_projection(laps, races, 3).collect()
    assert [(r.season, r.lap_number) for r in cut] == [(2024, 0), (2024, 1), (2024, 2)]


def test_message_types(projection):
    message = json.loads(lap_events.to_event(projection(1)).first()["value"])
    assert message["lap_number"] == 1.0 and isinstance(message["lap_number"], float)
    assert message["is_personal_best"] == 1.0 and message["sector2_sec"] is None
    assert len(message["event_id"]) == 36 and len(message["event_timestamp"]) == 26
    assert set(message) == {c.split()[0] for c in schemas.LAP_EVENT.split(", ")}


def test_fixed_ids(projection):
    key = ["race_id", "driver_abbr", "lap_number"]
    ids = [rows(lap_events.to_event(projection(None), key).select(F.get_json_object("value", "$.event_id"))) for _ in "ab"]
    assert ids[0] == ids[1] and len(set(ids[0])) == 12


@pytest.mark.parametrize("delay", [None, "1 hour"])
def test_stream_equals_batch_after_dedup(spark, projection, tmp_path, delay):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    key = ["race_id", "driver_abbr", "lap_number"]
    messages = lap_events.to_event(projection(None), key, at=F.lit("2025-01-01 10:00:00").cast("timestamp"))
    noise = spark.createDataFrame([("not json",), ("{}",), ("[1]",)], "value string")
    messages.unionAll(messages.limit(4)).unionAll(noise).write.text(source)

    def run():
        events = lap_events.deduplicated(lap_events.read_files(spark, source, max_files=1), delay)
        lap_events.event_sink(events, out, checkpoint).awaitTermination()
        return spark.read.parquet(out)

    batch = lap_events.sink_columns(lap_events.parse_events(messages))
    assert rows(run()) == rows(batch)
    assert dict(batch.dtypes)["lap_number"] == "int" and dict(batch.dtypes)["is_personal_best"] == "boolean"
    assert "driver_code" in batch.columns and "driver_abbr" not in batch.columns
    messages.limit(5).write.mode("append").text(source)
    assert rows(run()) == rows(batch)


def test_parse_foreign_messages(spark):
    message = {
        "race_id": 1.0, "race_name": "One", "driver_abbr": "VER", "lap_number": 3.0, "lap_time_sec": 91.234,
        "sector1_sec": None, "sector2_sec": 30.2, "sector3_sec": 30.9, "is_personal_best": 1.0, "event_id": "e1",
    }
    times = ["2025-01-01T00:00:00.123456", "2025-01-01T00:00:01"]
    lines = [(json.dumps({**message, "event_timestamp": t}),) for t in times] + [("{broken",)]
    got = lap_events.parse_events(spark.createDataFrame(lines, "value string"))
    assert got.count() == 2
    row = got.orderBy("event_timestamp").first()
    assert (row.race_id, row.lap_number, row.is_personal_best, row.sector1_sec) == (1, 3, True, None)
    stamps = rows(got.select(F.date_format("event_timestamp", "HH:mm:ss.SSSSSS")))
    assert stamps == [("00:00:00.123456",), ("00:00:01.000000",)]


def test_intake_loses_nothing(spark, projection, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    key = ["race_id", "driver_abbr", "lap_number"]
    at = lambda text: F.lit(text).cast("timestamp")
    every = projection(None)
    messages = lap_events.to_event(every, key, at=at("2025-01-10 10:00:00"))
    near = lap_events.to_event(every.withColumn("lap_number", F.col("lap_number") + 50), key, at=at("2025-01-09 23:00:00"))
    old = lap_events.to_event(every.withColumn("lap_number", F.col("lap_number") + 90), key, at=at("2025-01-01 10:00:00"))
    noise = spark.createDataFrame([("not json",), ("{}",), (None,)], "value string")
    count = lambda name: lap_events.read_intake(spark, out, name).count()

    def run(frame):
        frame.write.mode("append").text(source)
        lap_events.intake(lap_events.read_messages(spark, source), out, checkpoint, "1 day").awaitTermination()
        return [count(name) for name in lap_events.OUTPUTS]

    assert run(messages.unionAll(messages.limit(4)).unionAll(noise)) == [12, 0, 3]
    assert run(messages.limit(5).unionAll(near).unionAll(old)) == [24, 12, 3]
    assert run(near.unionAll(old.limit(1)).unionAll(noise.limit(1))) == [24, 13, 4]
    ids = lap_events.read_intake(spark, out, "events").select("event_id")
    assert ids.distinct().count() == 24
    with pytest.raises(ValueError):
        lap_events.read_intake(spark, out, "other")


def _batches(spark):
    """Message batches: no time at first, repeated ids, late events, events without a time, broken lines."""
    at = "2025-01-%02dT10:00:00.000000"

    def message(name, day=None):
        return json.dumps({"event_id": name, "race_id": 1.0, "event_timestamp": None if day is None else at % day})

    lines = [
        [message("u1"), message("u2"), message("u1"), "broken"],
        [message("u1"), message("a", 10), message("u3"), message("a", 10)],
        [message("a", 10), message("b", 9), message("old", 2), message("u2"), message("u4"), "{}"],
        [message("b", 9), message("u4"), message("old", 2), message("c", 12), message("u5")],
    ]
    return [spark.createDataFrame([(line,) for line in batch], "value string") for batch in lines]


_WANTED = {
    "events": ["a", "b", "c", "u1", "u2", "u3", "u4", "u5"],
    "late": ["old", "old"],
    "broken": ["broken", "{}"],
}


def _tables(spark, out):
    return {name: sorted(r[0] for r in lap_events.read_intake(spark, out, name).collect()) for name in lap_events.OUTPUTS}


def test_batches_run_twice(spark, tmp_path):
    out = str(tmp_path / "out")
    for number, batch in enumerate(_batches(spark)):
        lap_events.store_batch(batch, number, out, "3 days")
        before = _tables(spark, out)
        lap_events.store_batch(batch, number, out, "3 days")
        assert _tables(spark, out) == before
    assert before == _WANTED


@pytest.mark.parametrize("killed_at", [1, 2, 3, 4])
def test_batches_killed_at_each_write(spark, tmp_path, monkeypatch, killed_at):
    """Every batch is ended before, or after, one of its writes and run again: same tables."""
    out, write = str(tmp_path / "out"), lap_events._write
    for number, batch in enumerate(_batches(spark)):
        for when in ("before", "after") if killed_at in (1, 4) else ("before",):
            left = [killed_at]

            def dying(rows_, folder, *partitions):
                left[0] -= 1
                if left[0] == 0 and when == "before":
                    raise InterruptedError
                write(rows_, folder, *partitions)
                if left[0] == 0:
                    raise InterruptedError

            seen = _tables(spark, out)
            monkeypatch.setattr(lap_events, "_write", dying)
            with pytest.raises(InterruptedError):
                lap_events.store_batch(batch, number, out, "3 days")
            monkeypatch.setattr(lap_events, "_write", write)
            if (killed_at, when) != (4, "after"):  # readers see nothing of a batch that is not in the log
                assert _tables(spark, out) == seen
        lap_events.store_batch(batch, number, out, "3 days")
    assert _tables(spark, out) == _WANTED


def test_stream_killed_and_run_again(spark, tmp_path, monkeypatch):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    write = lap_events._write
    for batch in _batches(spark):
        batch.write.mode("append").text(source)

        def dying(rows_, folder, *partitions):
            write(rows_, folder, *partitions)
            if "/events/" in folder:
                raise InterruptedError

        run = lambda: lap_events.intake(lap_events.read_messages(spark, source), out, checkpoint, "3 days").awaitTermination()
        monkeypatch.setattr(lap_events, "_write", dying)
        with pytest.raises(Exception, match="InterruptedError"):
            run()
        monkeypatch.setattr(lap_events, "_write", write)
        run()
    assert _tables(spark, out) == _WANTED
    with pytest.raises(ValueError, match="another checkpoint"):
        lap_events.intake(lap_events.read_messages(spark, source), out, str(tmp_path / "new"), "3 days")


def test_a_batch_leaves_no_scratch_data(spark, projection, tmp_path):
    from pathlib import Path

    from paddock.session import shared_dir

    source = str(tmp_path / "in")
    lap_events.to_event(projection(None)).write.text(source)
    scratch = Path(shared_dir(spark).removeprefix("file:"))
    before = set(scratch.glob("batch-*"))
    messages = lap_events.read_messages(spark, source)
    lap_events.intake(messages, str(tmp_path / "out"), str(tmp_path / "c"), "1 day").awaitTermination()
    assert set(scratch.glob("batch-*")) == before


def test_broken_messages(spark):
    lines = spark.createDataFrame([("{broken",), ("{}",), (None,), ('{"event_id": "a"}',)], "value string")
    assert rows(lap_events.broken_messages(lines)) == sorted([("{broken",), ("{}",), (None,)], key=repr)
    assert lap_events.parse_events(lines).count() == 1


def test_kafka_options(monkeypatch):
    """The connector is not here; what is asked of it is checked instead."""
    asked = {}

    class Source:
        def format(self, name):
            asked["format"] = name
            return self

        def option(self, key, value):
            asked[key] = value
            return self

        def options(self, **more):
            asked.update(more)
            return self

        def save(self):
            asked["saved"] = True

    class Frame:
        write = Source()

    lap_events.send_to_kafka(Frame(), "host:9092", "laps", acks="all")
    assert asked == {"format": "kafka", "kafka.bootstrap.servers": "host:9092", "topic": "laps", "acks": "all", "saved": True}


def test_kafka_messages_are_given_unread(spark):
    """The reader asks for the earliest offset and gives every message, also what is no event."""
    asked = {}
    lines = spark.createDataFrame([(b"k", b'{"event_id": "a"}'), (b"k", b"broken")], "key binary, value binary")

    class Source:
        def format(self, name):
            asked["format"] = name
            return self

        def option(self, key, value):
            asked[key] = value
            return self

        def options(self, **more):
            asked.update(more)
            return self

        def load(self):
            return lines

    class Session:
        readStream = Source()

    got = lap_events.read_kafka(Session(), "host:9092", "laps", failOnDataLoss="true")
    assert asked == {
        "format": "kafka", "kafka.bootstrap.servers": "host:9092", "subscribe": "laps", "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    assert got.columns == ["value"] and got.count() == 2
    assert lap_events.parse_events(got).count() == 1 and lap_events.broken_messages(got).count() == 1

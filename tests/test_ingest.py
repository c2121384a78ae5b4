"""Extraction, keyed loads and snapshots."""

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from paddock import schemas
from paddock.operators import scd
from paddock.sources import catalog, extract, sinks, snapshots

RESULTS_FRAME = (
    "season int, round_number int, result_order int, Abbreviation string, FirstName string, LastName string, "
    "TeamName string, Status string, Points double"
)
LAPS_FRAME = (
    "season int, round_number int, Driver string, LapNumber double, Position double, LapTime interval day to second, "
    "Sector1Time interval day to second, Sector2Time interval day to second, Sector3Time interval day to second, "
    "Compound string, TyreLife double, IsPersonalBest boolean"
)


def lap(driver, number, position=None, seconds=90.5, rnd=1):
    time = None if seconds is None else dt.timedelta(seconds=seconds)
    return (2025, rnd, driver, float(number), position, time, time, None, time, "SOFT", None, None)


@pytest.fixture(scope="module")
def laps(frame):
    data = [lap("VER", n, 2.0 if n == 1 else 1.0) for n in range(1, 11)]
    data += [lap("HAM", n, 1.0 if n == 1 else 3.0) for n in range(1, 10)]
    data += [lap("ALO", n, None) for n in range(1, 9)]
    data += [lap("BOT", 1, 4.0, None), lap(None, 1, 9.0)]
    return frame(data, LAPS_FRAME)


@pytest.fixture(scope="module")
def session(frame):
    data = [
        (2025, 1, 10, "VER", "Max", "V", "RB", "Finished", 25.0),
        (2025, 1, 20, "HAM", "Lewis", None, None, None, None),
        (2025, 1, 30, "ALO", None, "Alonso", "AM", "+2 Laps", 15.0),
        (2025, 1, 40, "BOT", None, None, "S", "Finished", 0.0),
        (2025, 1, 50, "STR", "L", "S", "AM", "Engine failure", 0.0),
        (2025, 2, 10, "HAM", "Lewis", "H", "FE", "Finished", 25.0),
    ]
    return frame(data, RESULTS_FRAME).repartition(3)


def test_build_results(session, laps):
    got = extract.build_results(session, laps)
    assert got.columns == [c.split()[0] for c in schemas.RESULTS.split(", ")][:-1]
    assert rows(got.drop("season")) == sorted(
        [
            (1, "VER", "Max V", "RB", 2, 1.0, "1", "Finished", 25.0, False),
            (1, "HAM", "Lewis", "Unknown", 1, 2.0, "2", "Unknown", 0.0, False),
            (1, "ALO", "Alonso", "AM", 3, 3.0, "R", "+2 Laps", 15.0, True),
            (1, "BOT", "", "S", 4, 4.0, "R", "Finished", 0.0, True),
            (1, "STR", "L S", "AM", 5, 5.0, "R", "Engine failure", 0.0, True),
            (2, "HAM", "Lewis H", "FE", 1, 1.0, "1", "Finished", 25.0, False),
        ],
        key=repr,
    )


def test_dnf_words(frame):
    assert len(extract.DNF_WORDS) == 17
    df = frame([(f"x {w.upper()}ed",) for w in extract.DNF_WORDS] + [("Finished",), ("+1 Lap",), (None,)], "s string")
    got = [r[0] for r in df.select(extract.dnf_from_status(F.col("s"))).collect()]
    assert got == [True] * 17 + [False] * 3


def test_build_laps(laps, frame):
    got = extract.build_laps(laps)
    assert dict(got.dtypes)["lap_time_ms"] == "double"
    one = got.where("driver_abbr = 'VER' AND lap_number = 1").first()
    assert (one.lap_time_ms, one.sector2_ms, one.tyre_life, one.is_personal_best) == (90500.0, None, None, False)
    assert got.where("driver_abbr = 'UNK'").count() == 1
    assert got.where("driver_abbr = 'BOT'").first().lap_time_ms is None
    long = frame([lap("X", 1, seconds=90061.123456)], LAPS_FRAME)
    assert extract.build_laps(long).first().lap_time_ms == pytest.approx(90061123.456)


def test_schedule(frame, session, laps):
    schedule = frame(
        [(2025, 0, "testing"), (2025, 1, "conventional"), (2025, 2, None), (2025, 3, "sprint")],
        "season int, round_number int, EventFormat string",
    )
    assert rows(extract.non_test_rounds(schedule)) == [(2025, 3)]
    log = extract.load_log(schedule, extract.build_results(session, laps))
    assert rows(log) == [(2025, 1, 5, True), (2025, 2, 1, True), (2025, 3, 0, False)]
    assert rows(extract.load_summary(log)) == [(2025, 2, 1, 3)]


def test_build_races(frame):
    event = frame(
        [(2025, 1, "GP", None, "IT", dt.date(2025, 3, 1))],
        "season int, round_number int, EventName string, Location string, Country string, EventDate date",
    )
    assert rows(extract.build_races(event)) == [(2025, 1, "GP", "Unknown", "IT", dt.date(2025, 3, 1))]


def test_load_results_is_idempotent(spark, session, laps, tmp_path):
    root = str(tmp_path)
    built = extract.build_results(session, laps)
    sinks.load_results(built, root)
    first = rows(catalog.read_raw(spark, root, "results").drop("loaded_at"))
    sinks.load_results(built, root)
    assert rows(catalog.read_raw(spark, root, "results").drop("loaded_at")) == first
    assert catalog.read_raw(spark, root, "results").where("loaded_at IS NULL").isEmpty()


def test_upsert_keeps_name_and_takes_null(spark, session, laps, tmp_path):
    root = str(tmp_path)
    built = extract.build_results(session, laps)
    sinks.load_results(built, root)
    again = built.where("round_number = 1 AND driver_abbr IN ('VER')").withColumns(
        {"driver_full_name": F.lit("Other"), "team_name": F.lit(None).cast("string"), "points": F.lit(1.0)}
    )
    new = again.withColumns({"driver_abbr": F.lit("NEW")})
    sinks.load_results(again.unionAll(new), root)
    stored = catalog.read_raw(spark, root, "results")
    assert rows(stored.where("driver_abbr IN ('VER', 'NEW')"), "driver_abbr", "driver_full_name", "team_name", "points") == [
        ("NEW", "Other", None, 1.0),
        ("VER", "Max V", None, 1.0),
    ]
    assert stored.count() == 7


def test_merge_takes_first_of_repeated_keys(frame):
    current = frame([(1, "a")], "k int, v string")
    incoming = frame([(1, "b", 1), (1, "c", 2), (2, "d", 1)], "k int, v string, o int")
    got = sinks.merge_upsert(current, incoming, ["k"], order_by=[F.desc("o")])
    assert rows(got) == [(1, "c"), (2, "d")]


def test_replace_partition(spark, laps, tmp_path):
    root = str(tmp_path)
    built = extract.build_laps(laps)
    sinks.load_laps(built, root)
    sinks.load_laps(built.withColumn("round_number", F.lit(2)), root)
    sinks.load_laps(built.where("driver_abbr = 'VER'"), root)
    sinks.load_laps(built.where("false"), root)
    stored = catalog.read_raw(spark, root, "lap_times")
    assert rows(stored.groupBy("round_number").count()) == [(1, 10), (2, built.count())]


def test_append_copy(spark, frame, tmp_path):
    path = str(tmp_path / "copy")
    df = frame([(1, "a", None)], "k int, v string, loaded_at timestamp")
    sinks.append_copy(df, path)
    sinks.append_copy(df, path)
    sinks.append_copy(df.unionAll(df.withColumn("k", F.lit(2))), path, keys=["k"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (1, "a"), (2, "a")]


def test_materialize(spark, frame, tmp_path):
    df = frame([(1,)], "k int")
    assert rows(sinks.materialize_view(df, "one_row")) == [(1,)]
    assert rows(sinks.materialize_table(df, str(tmp_path / "t"))) == [(1,)]


def test_read_raw_and_csv(spark, tmp_path):
    with pytest.raises(ValueError):
        catalog.read_raw(spark, str(tmp_path), "other")
    (tmp_path / "seed.csv").write_text("id,name\n1,a\n2,\n")
    assert rows(catalog.read_csv(spark, str(tmp_path / "seed.csv"), "id int, name string")) == [(1, "a"), (2, None)]


TEAMS = "driver_abbr string, team_name string, season int, round_number int, driver_name string"


@pytest.fixture(scope="module")
def facts(frame):
    moves = {"A": "xxxyyx", "B": "zzzzzz", "C": "--ppqq", "D": "ww----"}
    data = [
        (driver, team, 2025, rnd, driver)
        for driver, teams in moves.items()
        for rnd, team in enumerate(teams, start=1)
        if team != "-"
    ]
    return frame(data, TEAMS)


def at(rnd):
    return F.lit(f"2025-01-{rnd:02d} 00:00:00").cast("timestamp")


def test_snapshot_replay_equals_history(facts, spark):
    history = None
    for rnd in range(1, 7):
        incoming = scd.current_driver_teams(facts.where(f"round_number <= {rnd}"))
        if history is None:
            history = scd.first_snapshot(incoming, ["driver_abbr"], at(rnd))
        else:
            history = scd.snapshot_merge(history, incoming, ["driver_abbr"], ["team_name"], at(rnd))
        history = sinks.materialize_table(history)
    start, end = F.dayofmonth(scd.VALID_FROM), F.dayofmonth(scd.VALID_TO)
    replay = rows(history.select("driver_abbr", "team_name", start, end))
    direct = scd.history_from_facts(facts, "driver_abbr", "team_name")
    assert replay == rows(direct.select("driver_abbr", "team_name", "from_round_number", "to_round_number"))
    assert history.select(scd.SCD_ID).distinct().count() == history.count()
    assert history.columns[-4:] == scd.SNAPSHOT_COLUMNS


def test_snapshot_hard_deletes_and_nulls(facts, frame):
    schema = "driver_abbr string, team_name string, driver_name string"
    history = scd.first_snapshot(frame([("A", "x", "a"), ("B", None, "b"), ("C", "p", "c")], schema), ["driver_abbr"], at(1))
    incoming = frame([("A", "x", "renamed"), ("B", "q", "b")], schema)
    kept = scd.snapshot_merge(history, incoming, ["driver_abbr"], ["team_name"], at(2), invalidate_hard_deletes=False)
    closed = F.col(scd.VALID_TO).isNotNull()
    assert rows(kept.select("driver_abbr", "team_name", "driver_name", closed)) == [
        ("A", "x", "a", False),
        ("B", "q", "b", False),
        ("B", None, "b", True),
        ("C", "p", "c", False),
    ]
    gone = scd.snapshot_merge(history, incoming, ["driver_abbr"], ["team_name"], at(2))
    assert rows(gone.where("driver_abbr = 'C'").select(closed)) == [(True,)]
    back = scd.snapshot_merge(gone, frame([("C", "p", "c")], schema), ["driver_abbr"], ["team_name"], at(3))
    assert rows(back.where("driver_abbr = 'C'").select(closed)) == [(False,), (True,)]


def test_stored_snapshot_equals_merge_and_ignores_unfinished_runs(facts, spark, tmp_path):
    path, history = str(tmp_path / "snap"), None
    for rnd in range(1, 7):
        incoming = scd.current_driver_teams(facts.where(f"round_number <= {rnd}")).where(f"driver_abbr <> 'D' OR {rnd} < 5")
        if history is None:
            history = scd.first_snapshot(incoming, ["driver_abbr"], at(rnd))
        else:
            history = scd.snapshot_merge(history, incoming, ["driver_abbr"], ["team_name"], at(rnd))
        history = sinks.materialize_table(history)
        if rnd == 4:
            unfinished = snapshots.read_snapshot(spark, path)
            sinks.materialize_table(unfinished, f"{path}/closed/version={rnd}")
            assert rows(snapshots.read_snapshot(spark, path)) == rows(unfinished)
        stored = snapshots.write_snapshot(incoming, path, ["driver_abbr"], ["team_name"], at(rnd))
        assert rows(stored.select(*history.columns)) == rows(history)
    assert snapshots.read_snapshot(spark, str(tmp_path / "none")) is None


def test_driver_teams(facts):
    assert ("A", "x", "A") in rows(scd.driver_teams(facts)) and ("A", "y", "A") in rows(scd.driver_teams(facts))
    assert rows(scd.current_driver_teams(facts), "driver_abbr", "team_name") == [
        ("A", "x"),
        ("B", "z"),
        ("C", "q"),
        ("D", "w"),
    ]


_RESULTS = "season int, round_number int, driver_abbr string, driver_full_name string, team_name string, points double"


def test_repeated_key_in_a_load_is_stored_once(spark, frame, tmp_path):
    path = str(tmp_path / "results")
    load = frame([(2025, 1, "A", "n", f"T{i}", float(i)) for i in range(40)], _RESULTS).coalesce(1)
    sinks.load_results(load.drop("driver_full_name").withColumn("driver_full_name", F.lit("n")), str(tmp_path))
    stored = spark.read.parquet(path)
    assert [(r.team_name, r.points) for r in stored.collect()] == [("T39", 39.0)]
    sinks.load_races(frame([(2025, 1, "a"), (2025, 1, "b")], "season int, round_number int, race_name string").coalesce(1), str(tmp_path))
    assert [r.race_name for r in spark.read.parquet(str(tmp_path / "races")).collect()] == ["b"]


@pytest.mark.parametrize("row", [(2025, None, "C"), (None, 1, "C"), (2025, 1, None)])
def test_null_keys_are_refused_before_a_write(spark, frame, tmp_path, row):
    schema = "season int, round_number int, driver_abbr string"
    path = str(tmp_path / "t")
    sinks.upsert(frame([(2025, 1, "A")], schema), path, ["season", "round_number", "driver_abbr"])
    with pytest.raises(ValueError, match="NULL"):
        sinks.upsert(frame([(2025, 1, "B"), row], schema), path, ["season", "round_number", "driver_abbr"])
    assert [r.driver_abbr for r in spark.read.parquet(path).collect()] == ["A"]
    with pytest.raises(ValueError, match="NULL"):
        sinks.append_copy(frame([row], schema), str(tmp_path / "copy"), keys=["season", "round_number", "driver_abbr"])
    with pytest.raises(ValueError, match="NULL"):
        snapshots.write_snapshot(frame([row], schema), str(tmp_path / "s"), ["season", "round_number", "driver_abbr"], [])


def test_snapshot_refuses_repeated_keys(frame, tmp_path):
    with pytest.raises(ValueError, match="one row"):
        snapshots.write_snapshot(frame([("A", "x"), ("A", "y")], "k string, v string"), str(tmp_path / "s"), ["k"], ["v"])


def test_versions_need_a_finished_write(spark, frame, tmp_path):
    for n in (2, 10):
        frame([(n,)], "n int").write.parquet(str(tmp_path / f"version={n}"))
    (tmp_path / "version=11").mkdir()
    assert sinks.versions(spark, str(tmp_path)) == [2, 10]
    assert sinks.versions(spark, str(tmp_path / "none")) == []


def _bytes(path):
    return {p.relative_to(path): p.read_bytes() for p in path.rglob("*.parquet")}


def test_a_snapshot_run_touches_changed_buckets_only(spark, frame, tmp_path):
    """One changed driver: the open rows of other buckets are not read (their files hold nothing readable)."""
    path = tmp_path / "s"
    rows_ = [(f"D{i}", f"T{i % 7}") for i in range(400)]
    schema = "driver_abbr string, team_name string"
    run = lambda data, day: snapshots.write_snapshot(
        frame(data, schema), str(path), ["driver_abbr"], ["team_name"], at(day), buckets=16
    )
    run(rows_, 1)
    kept = _bytes(path / "open")
    assert len({p.parts[-2] for p in kept}) == 16
    moved = [("D5", "elsewhere") if d == "D5" else (d, t) for d, t in rows_]
    bucket = spark.sql("SELECT pmod(xxhash64('D5'), 16)").first()[0]
    for p in (path / "open").rglob("*.parquet"):
        if p.parent.name != f"_bucket={bucket}":
            p.write_bytes(b"not to be read")
    run(moved, 2)
    for p, data in kept.items():
        (path / "open" / p).write_bytes(data)
    new = {p.parts[-2] for p in _bytes(path / "open/version=2")}
    assert new == {f"_bucket={bucket}"}
    got = snapshots.read_snapshot(spark, str(path))
    assert got.count() == 401 and rows(got.where("driver_abbr = 'D5'"), "team_name") == [("T5",), ("elsewhere",)]
    # nothing changed: nothing is written
    before = _bytes(path)
    run(moved, 3)
    assert _bytes(path) == before


def test_snapshot_versions_that_no_reader_needs_go(spark, frame, tmp_path):
    path, schema = tmp_path / "s", "k string, v int"
    for day in range(1, 7):
        snapshots.write_snapshot(frame([("a", day), ("b", 0)], schema), str(path), ["k"], ["v"], at(day), buckets=4)
    got = snapshots.read_snapshot(spark, str(path))
    assert got.count() == 7 and rows(got.where("valid_to IS NULL"), "k", "v") == [("a", 6), ("b", 0)]
    assert len(list((path / "manifest").glob("version=*"))) == 2
    assert len(list((path / "open").rglob("*.parquet"))) <= 5


def test_snapshot_of_nothing(spark, frame, tmp_path):
    schema, path = "k string, v int", str(tmp_path / "s")
    none = frame([], schema)
    assert snapshots.write_snapshot(none, path, ["k"], ["v"], at(1)).isEmpty()
    assert snapshots.write_snapshot(frame([("a", None)], schema), path, ["k"], ["v"], at(2)).count() == 1
    assert rows(snapshots.write_snapshot(none, path, ["k"], ["v"], at(3)), "k", "v") == [("a", None)]
    assert snapshots.read_snapshot(spark, path).where("valid_to IS NULL").isEmpty()


class _Asked:
    """Stands for a reader or writer of a source that is not run here: remembers what is asked of it."""

    def __init__(self, result=None):
        self.asked, self.result = {}, result

    def format(self, name):
        return self.option("format", name)

    def mode(self, name):
        return self.option("mode", name)

    def option(self, key, value):
        self.asked[key] = value
        return self

    def options(self, **more):
        self.asked.update(more)
        return self

    def load(self):
        return self.result

    def save(self):
        self.asked["saved"] = True


def test_jdbc_reader_options():
    """No database is started here; what is asked of Spark's source is checked instead."""

    class Session:
        read = _Asked("rows")

    assert catalog.read_jdbc(Session(), "jdbc:x:y", "raw.results", user="me", driver="d.D") == "rows"
    assert Session.read.asked == {"format": "jdbc", "url": "jdbc:x:y", "dbtable": "raw.results", "user": "me", "driver": "d.D"}
    Session.read.asked.clear()
    catalog.read_jdbc(Session(), "jdbc:x:y", "raw.laps", column="round_number", bounds=(1, 25), partitions=8)
    assert Session.read.asked == {
        "format": "jdbc", "url": "jdbc:x:y", "dbtable": "raw.laps", "partitionColumn": "round_number", "lowerBound": "1",
        "upperBound": "25", "numPartitions": "8",
    }


def test_jdbc_writer_options():
    class Frame:
        write = _Asked()

        def drop(self, name):
            assert name == sinks.LOADED_AT
            return self

    sinks.write_jdbc(Frame(), "jdbc:x:y", "raw.results", batch_rows=500, password="p")
    assert Frame.write.asked == {
        "format": "jdbc", "mode": "append", "batchsize": "500", "url": "jdbc:x:y", "dbtable": "raw.results", "password": "p",
        "saved": True,
    }

"""Models on a small season with the awkward cases, and their invariants."""

import math
import random
import statistics

import pytest
from helpers import rows
from pyspark.sql import functions as F

from paddock import schemas
from paddock.operators.scd import history_from_facts
from paddock.plans import declared_checks, features, marts, staging

DRIVERS = [f"D{i}" for i in range(8)]


def result(season, rnd, driver, place, grid=1, dnf=False, team=None, points=1.0, name=None):
    name = f" Driver {driver} " if name is None else name
    return (season, rnd, driver, name, team or f" T{int(driver[1:]) % 3} ", grid, place, str(place), "x", points, dnf, None)


@pytest.fixture(scope="module")
def raw_results(frame):
    rng = random.Random(3)
    data = []
    for season in (2024, 2025):
        for rnd in range(1, 8):
            order = DRIVERS[:]
            rng.shuffle(order)
            for place, driver in enumerate(order, start=1):
                grid = None if driver == "D5" else rng.randrange(1, 9)
                dnf = None if driver == "D6" else rng.random() < 0.25
                team = "T9" if driver == "D2" and (season, rnd) > (2024, 4) else None
                data.append(result(season, rnd, driver, float(place), grid, dnf, team))
    data.append((2025, 7, None, "ghost", "T0", 1, 9.0, "9", "x", 0.0, False, None))
    data.append(result(2025, 7, "D9", None, 3))
    return frame(data, schemas.RESULTS).cache()


@pytest.fixture(scope="module")
def raw_laps(frame):
    rng = random.Random(5)
    data = []
    for season in (2024, 2025):
        for rnd in range(1, 8):
            for driver in DRIVERS + ["D8"]:
                count = 3 if driver == "D7" or (season, rnd) == (2024, 3) and driver != "D0" else rng.randrange(6, 12)
                for lap in range(1, count + 1):
                    ms = 90000.0 + rng.randrange(5000)
                    if lap == 2:
                        ms *= 1.6
                    data.append((season, rnd, driver, lap, ms, ms / 4, None, ms / 2, "SOFT", lap, lap == 1, None))
    data.append((2024, 1, "D0", 99, None, None, None, None, "SOFT", 1, False, None))
    data.append((2024, 1, "D0", 98, -5.0, None, None, None, "SOFT", 1, False, None))
    data.append((2024, 1, None, 1, 90000.0, None, None, None, "SOFT", 1, False, None))
    return frame(data, schemas.LAP_TIMES).cache()


@pytest.fixture(scope="module")
def races(frame):
    data = [(s, r, f" Race {r} ", " Town ", " Land ", None, None) for s in (2024, 2025) for r in range(1, 9)]
    return frame(data + [(None, 1, "x", "x", "x", None, None)], schemas.RACES)


@pytest.fixture(scope="module")
def results(raw_results):
    return staging.stg_results(raw_results).cache()


@pytest.fixture(scope="module")
def laps(raw_laps):
    return staging.stg_lap_times(raw_laps).cache()


@pytest.fixture(scope="module")
def analysis(laps, results):
    return features.int_lap_analysis(laps, results).cache()


@pytest.fixture(scope="module")
def frame_(results, analysis):
    return features.feature_frame(results, analysis).cache()


def test_stg_races(races):
    staged = staging.stg_races(races)
    assert staged.count() == 16
    assert rows(staged.where("season = 2024 AND round_number = 1"), "race_name", "circuit_name", "country") == [
        ("Race 1", "Town", "Land")
    ]


def test_stg_results(frame):
    raw = frame(
        [
            result(1, 1, "D1", 1.0, None, None, points=0.0),
            result(1, 1, "D2", 4.0, 3, False, points=None),
            result(1, 1, "D3", 10.0, 3, True, points=2.0),
            result(1, 1, "D4", 11.0, 3, False),
            result(1, 1, "D5", None, 3, None),
        ],
        schemas.RESULTS,
    )
    got = staging.stg_results(raw)
    columns = ["driver_abbr", "grid_position", "points", "is_dnf", "scored_points", "finish_category"]
    assert rows(got, *columns) == [
        ("D1", 20, 25, False, False, "Podium"),
        ("D2", 3, 12, False, False, "Top 5"),
        ("D3", 3, 1, True, True, "DNF"),
        ("D4", 3, 0, False, True, "Midfield"),
        ("D5", 3, 0, False, True, "Backmarker"),
    ]
    first = got.where("driver_abbr = 'D1'").first()
    assert (first.driver_name, first.team_name) == ("Driver D1", "T1")
    assert first.grid_log == pytest.approx(math.log(21))


def test_stg_lap_times(raw_laps, laps):
    assert laps.where("lap_number >= 98").isEmpty()
    times = {}
    for r in laps.collect():
        times.setdefault((r.season, r.round_number, r.driver_abbr), []).append(r)
    for group in times.values():
        middle = statistics.median(r.lap_time_seconds for r in group)
        for r in group:
            assert r.median_lap_time == pytest.approx(middle)
            assert r.is_outlier == (r.lap_time_seconds > middle * 1.25)


def test_int_lap_analysis(laps, results, analysis):
    clean = {}
    for r in laps.where("NOT is_outlier").collect():
        clean.setdefault((r.season, r.round_number, r.driver_abbr), []).append(r.lap_time_seconds)
    kept = {k: v for k, v in clean.items() if len(v) >= 5}
    got = {(r.season, r.round_number, r.driver_abbr): r for r in analysis.collect()}
    assert set(got) == set(kept)
    winners = {(r.season, r.round_number): r.driver_abbr for r in results.where("finish_position = 1").collect()}
    missing = 0
    for (season, rnd, driver), r in got.items():
        times = kept[season, rnd, driver]
        assert r.mean_lap_time == pytest.approx(statistics.mean(times))
        assert r.lap_time_std == pytest.approx(statistics.stdev(times))
        leader = kept.get((season, rnd, winners[season, rnd]))
        if leader is None:
            missing += 1
            assert r.relative_pace is None
        else:
            assert r.relative_pace == pytest.approx(statistics.mean(times) - statistics.mean(leader))
    assert missing > 0


def _history(items, position, n=None):
    past = items[:position]
    return past if n is None else past[-n:]


def test_feature_frame_against_loops(results, analysis, frame_):
    """Every feature recomputed with plain loops from the definitions."""
    res = {}
    for r in results.collect():
        res.setdefault(r.driver_abbr, []).append(r)
    for items in res.values():
        items.sort(key=lambda r: (r.season, r.round_number))
    lap = {}
    for r in analysis.collect():
        lap.setdefault(r.driver_abbr, []).append(r)
    for items in lap.values():
        items.sort(key=lambda r: (r.season, r.round_number))
    finished = {d: [r for r in items if not r.is_dnf] for d, items in res.items()}
    slots = {}
    for items in finished.values():
        for r in items:
            if r.finish_position is not None:
                slots.setdefault(r.grid_position, []).append(r.finish_position)
    expected = {g: statistics.mean(v) for g, v in slots.items()}
    teams = {}
    for items in res.values():
        for r in items:
            entry = teams.setdefault(r.team_name, {}).setdefault((r.season, r.round_number), [0, False])
            entry[0] += r.points
            entry[1] |= r.is_dnf
    got = {(r.season, r.round_number, r.driver_abbr): r for r in features.int_driver_race_features(frame_).collect()}
    assert len(got) == sum(len(v) for v in res.values())
    mean = lambda v, default: statistics.mean(v) if v else default
    for driver, items in res.items():
        for i, r in enumerate(items):
            g = got[r.season, r.round_number, driver]
            past = items[:i]
            good = lambda n: sum(p.finish_position is not None and p.finish_position <= n and not p.is_dnf for p in past)
            for n in (3, 5, 10, 15):
                assert g[f"top{n}_rate"] == pytest.approx(good(n) / len(past) if past else 0)
            assert g.dnf_rate == pytest.approx(sum(p.is_dnf for p in past) / len(past) if past else 0)
            assert g.driver_points == sum(p.points for p in past)
            assert g.points_momentum == pytest.approx(mean([p.points for p in past[-5:]], 0))
            places = [p.finish_position for p in past[-6:] if not p.is_dnf and p.finish_position is not None]
            assert g.finish_consistency == pytest.approx(statistics.stdev(places) if len(places) > 1 else 5.0)
            at = (r.season, r.round_number)
            rounds = [v for k, v in teams[r.team_name].items() if k < at]
            assert g.team_points == sum(v[0] for v in rounds)
            assert g.team_reliability == pytest.approx(1 - sum(v[1] for v in rounds) / len(rounds) if rounds else 0.9)
            surplus = [
                expected[p.grid_position] - p.finish_position
                for p in [p for p in finished[driver] if (p.season, p.round_number) < at][-6:]
                if p.finish_position is not None
            ]
            assert g.perf_vs_expected == pytest.approx(0 if r.is_dnf else mean(surplus, 0), abs=1e-9)
            own = [(x.season, x.round_number) for x in lap.get(driver, [])]
            recent = [x for x in lap.get(driver, []) if (x.season, x.round_number) < at][-6:] if at in own else []
            assert g.lap_time_consistency == pytest.approx(mean([x.lap_time_std for x in recent], 3.0))
            paces = [x.relative_pace for x in recent if x.relative_pace is not None]
            assert g.relative_pace == pytest.approx(mean(paces, 5.0))


def test_features_do_not_see_later_races(results, analysis):
    early = "season = 2024 AND round_number <= 5"
    whole = features.feature_frame(results, analysis, as_of=True)
    part = features.feature_frame(results.where(early), analysis.where(early), as_of=True)
    pick = lambda df: rows(features.int_driver_race_features(df.where(early)))
    assert pick(whole) == pick(part)


def test_cumulative_stats_match_feature_frame(results, frame_):
    stats = features.int_driver_cumulative_stats(results)
    shared = ["season", "round_number", "driver_abbr", "prev_races_started", "prev_team_points", "dnf_rate"]
    assert rows(stats, *shared) == rows(frame_, *shared)


def test_team_points_by_row(results):
    plain = features.with_team_history(results, "rows")
    columns = ["season", "round_number", "driver_abbr", "prev_team_points"]
    assert rows(plain, *columns) != rows(features.with_team_history(results), *columns)
    with pytest.raises(ValueError):
        features.with_team_history(results, "other")


def test_marts(results, races, analysis, frame_):
    staged = staging.stg_races(races)
    drivers = marts.dim_drivers(frame_)
    assert drivers.count() == 9
    assert drivers.where("driver_abbr = 'D2'").first().current_team == "T9"
    teams = {r.team_name: r for r in marts.dim_teams(results).collect()}
    assert sum(t.total_race_entries for t in teams.values()) == results.count()
    circuits = marts.dim_circuits(staged, results)
    assert circuits.count() == 16
    assert rows(circuits.where("most_recent_round = 8"), "total_starters", "circuit_dnf_rate") == [(0, None)] * 2
    facts = marts.fct_race_results(frame_, staged, with_history_pace=True)
    assert facts.count() == results.count() and "relative_pace_hist" in facts.columns
    standings = marts.fct_championship_standings(results)
    last = standings.where("season = 2025 AND round_number = 7 AND championship_position = 1").first()
    total = results.where("season = 2025").groupBy("driver_abbr").agg(F.sum("points").alias("p"))
    assert last.total_points == total.agg(F.max("p")).first()[0]
    performance = marts.fct_driver_performance(frame_)
    assert performance.agg(F.sum("races_entered")).first()[0] == results.count()
    summary = marts.fct_race_summary(staged, results, analysis)
    assert summary.count() == 16 and summary.where("winner IS NULL").count() == 2


def test_declared_checks(results, laps, races, analysis, frame_):
    report = declared_checks.run_checks(
        {
            "races": races.where("season IS NOT NULL"),
            "stg_results": results,
            "stg_lap_times": laps,
            "fct_race_results": marts.fct_race_results(frame_, staging.stg_races(races)),
        }
    )
    failing = {(r.relation, r.check): r.failures for r in report.where("verdict = 'error'").collect()}
    assert failing[("fct_race_results", "not_null")] == 1
    assert set(failing) == {("fct_race_results", "not_null"), ("stg_lap_times", "no_orphan_laps")}


def test_number_of_declared_checks():
    declared = sum(map(len, declared_checks.NOT_NULL.values())) + sum(map(len, declared_checks.RANGES.values()))
    assert declared + len(declared_checks.UNIQUE) == 69
    assert len(declared_checks.RAW_RESULTS_SUITE) == 14


def test_team_moves(results):
    moves = history_from_facts(results, "driver_abbr", "team_name")
    got = rows(moves.where("driver_abbr = 'D2'"))
    assert got == [("D2", "T2", 2024, 1, 2024, 4, 2024, 5), ("D2", "T9", 2024, 5, 2025, 7, None, None)]
    assert moves.count() == 10


def test_refresh(spark, raw_results, raw_laps, races, tmp_path):
    from paddock.plans import models
    from paddock.sources import sinks

    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    sinks.load_races(races.where("season IS NOT NULL").drop("loaded_at"), raw)
    sinks.load_results(raw_results.where("driver_abbr IS NOT NULL").drop("loaded_at"), raw)
    sinks.load_laps(raw_laps.drop("loaded_at"), raw)
    first = models.refresh(spark, raw, out)
    assert first["checks"].count() == 71 and first["suite"].count() == 14
    assert first["snapshot"].count() == 9
    moved = raw_results.where("driver_abbr = 'D1'").withColumn("team_name", F.lit("T7")).drop("loaded_at")
    sinks.load_results(moved, raw)
    again = models.refresh(spark, raw, out)
    assert again["snapshot"].count() == 10
    assert models.read_mart(spark, f"{out}/marts", "dim_drivers").where("current_team = 'T7'").count() == 1
    assert sinks.versions(spark, f"{out}/marts/dim_drivers") == [1, 2]
    models.refresh(spark, raw, out)
    assert sinks.versions(spark, f"{out}/marts/dim_drivers") == [2, 3]


def test_upsert_reads_only_touched_partitions(spark, frame, tmp_path):
    from paddock.sources import sinks

    path = str(tmp_path / "t")
    rows_ = [(2024, r, f"D{d}", r * d) for r in range(1, 9) for d in range(3)]
    df = frame(rows_, "season int, round_number int, driver_abbr string, v int")
    sinks.upsert(df, path, staging.ENTRY)
    before = {f for f in spark.read.parquet(path).inputFiles()}
    sinks.upsert(df.where("round_number = 3").withColumn("v", F.lit(-1)), path, staging.ENTRY)
    after = spark.read.parquet(path)
    kept = {f for f in after.inputFiles()} & before
    assert len(kept) == len({f for f in before if "round_number=3" not in f})
    assert after.where("v = -1").count() == 3 and after.count() == 24


def test_checks_counted_by_the_writes(spark, raw_results, raw_laps, races, tmp_path):
    """Same report as by reading the relations again; row checks of written relations read nothing."""
    from paddock.plans import models

    row_checks = declared_checks.RowChecks()
    relations = models.build(races, raw_results, raw_laps, row_checks)
    relations = models.write_marts(relations, str(tmp_path / "marts"), row_checks)
    counted = row_checks.found()
    assert set(counted) == set(declared_checks.NOT_NULL) - {"lap_times"}
    assert rows(declared_checks.run_checks(relations, counted)) == rows(declared_checks.run_checks(relations))
    assert counted["results"] == [1, 0] and counted["fct_race_results"][3] == 1
    alone = {n: df for n, df in relations.items() if n in counted and n not in declared_checks.UNIQUE}
    plan = declared_checks.run_checks({n: alone[n] for n in ("dim_circuits", "int_lap_analysis")}, counted)
    assert "Scan parquet" not in plan._jdf.queryExecution().executedPlan().toString()


def test_counts_of_an_empty_relation(spark, tmp_path):
    from paddock.plans import models

    none = [spark.createDataFrame([], s) for s in (schemas.RACES, schemas.RESULTS, schemas.LAP_TIMES)]
    row_checks = declared_checks.RowChecks()
    relations = models.write_marts(models.build(*none, row_checks), str(tmp_path / "marts"), row_checks)
    report = declared_checks.run_checks(relations, row_checks.found())
    assert report.count() == 71 and report.where("failures > 0").isEmpty()

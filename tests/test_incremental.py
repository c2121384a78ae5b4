"""Features and standings refreshed round by round against a build over all rounds."""

import random
import shutil

import pytest

from paddock import schemas
from paddock.plans import features, incremental, marts, staging
from paddock.sources import catalog, sinks

DRIVERS = [f"D{i}" for i in range(7)]
ROUNDS = [(s, r) for s in (2024, 2025) for r in range(1, 8)]


def season_rows(seed, rounds=ROUNDS):
    """Results and laps with missing drivers, moves, retirements, missing grids and laps without a result."""
    rng = random.Random(seed)
    results, laps = [], []
    for season, rnd in rounds:
        order = [d for d in DRIVERS if rng.random() < 0.85]
        rng.shuffle(order)
        for place, driver in enumerate(order, start=1):
            team = f"T{(int(driver[1:]) + (season, rnd > 4)[1]) % 3}"
            grid = None if rng.random() < 0.1 else rng.randrange(1, 5)
            finish = None if rng.random() < 0.05 else float(place)
            dnf = None if driver == "D6" else rng.random() < 0.3
            results.append((season, rnd, driver, driver, team, grid, finish, str(place), "x", 1.0, dnf))
        for driver in [*order, "L1"]:
            for lap in range(1, rng.choice([3, 7, 9]) + 1):
                ms = 90_000.0 + rng.randrange(5000) * (10 if lap == 2 else 1)
                laps.append((season, rnd, driver, lap, ms, None, None, None, "SOFT", lap, False))
    return results, laps


@pytest.fixture(scope="module")
def load(frame):
    columns = lambda schema: schema.replace(", loaded_at timestamp", "")

    def build(root, rows, rounds):
        results, laps = ([r for r in table if (r[0], r[1]) in rounds] for table in rows)
        sinks.load_results(frame(results, columns(schemas.RESULTS)), root)
        sinks.load_laps(frame(laps, columns(schemas.LAP_TIMES)), root)

    return build


def exact(df):
    """Rows with all bits of doubles, columns by name."""
    names = sorted(df.columns)
    return sorted((tuple(v.hex() if isinstance(v, float) else v for v in r) for r in df.select(*names).collect()), key=repr)


def full(spark, raw):
    results = staging.stg_results(catalog.read_raw(spark, raw, "results")).cache()
    laps = staging.stg_lap_times(catalog.read_raw(spark, raw, "lap_times"))
    frame = features.feature_frame(results, features.int_lap_analysis(laps, results).cache(), as_of=True)
    return {
        "int_driver_cumulative_stats": features.int_driver_cumulative_stats(results),
        "int_driver_race_features": features.int_driver_race_features(frame),
        "fct_championship_standings": marts.fct_championship_standings(results),
    }


def same(spark, raw, got):
    return {name: exact(df) for name, df in got.items()} == {name: exact(df) for name, df in full(spark, raw).items()}


@pytest.mark.parametrize("cuts", [[14], [1, 2, 9, 14]])
def test_rounds_one_after_the_other(spark, load, tmp_path, cuts):
    raw, out, rows, start = str(tmp_path / "raw"), str(tmp_path / "out"), season_rows(1), 0
    for cut in cuts:
        load(raw, rows, ROUNDS[start:cut])
        got = incremental.refresh(spark, raw, out)
        start = cut
    assert same(spark, raw, got)
    assert exact(incremental.refresh(spark, raw, out)[incremental.RELATIONS[0]]) == exact(got[incremental.RELATIONS[0]])


def test_a_round_is_loaded_again(spark, load, tmp_path):
    raw, out, rows = str(tmp_path / "raw"), str(tmp_path / "out"), season_rows(2)
    for cut in (range(0, 5), range(5, 8), range(8, 14)):
        load(raw, rows, [ROUNDS[i] for i in cut])
        incremental.refresh(spark, raw, out)
    load(raw, season_rows(3, ROUNDS[6:7]), ROUNDS[6:7])
    assert same(spark, raw, incremental.refresh(spark, raw, out, since=ROUNDS[6]))
    load(raw, season_rows(4, ROUNDS[:1]), ROUNDS[:1])
    assert same(spark, raw, incremental.refresh(spark, raw, out, since=ROUNDS[0]))


def test_only_new_rounds_are_read(spark, load, tmp_path):
    """The folders of earlier rounds are away while a new one is taken in."""
    raw, out, rows = tmp_path / "raw", str(tmp_path / "out"), season_rows(5)
    load(str(raw), rows, ROUNDS[:12])
    incremental.refresh(spark, str(raw), out)
    kept = tmp_path / "kept"
    shutil.copytree(raw, kept)
    load(str(raw), rows, ROUNDS[12:])
    shutil.copytree(raw, kept, dirs_exist_ok=True)
    for table in ("results", "lap_times"):
        for season, rnd in ROUNDS[:12]:
            folder = raw / table / f"season={season}" / f"round_number={rnd}"
            for part in folder.glob("*.parquet"):
                part.write_bytes(b"not to be read")
    got = incremental.refresh(spark, str(raw), out)
    assert same(spark, str(kept), got)


def test_a_refresh_that_ends_early_is_repeated(spark, load, tmp_path, monkeypatch):
    raw, out, rows = str(tmp_path / "raw"), str(tmp_path / "out"), season_rows(6)
    load(raw, rows, ROUNDS[:6])
    incremental.refresh(spark, raw, out)
    load(raw, rows, ROUNDS[6:9])
    state = incremental.next_state
    for _ in range(2):
        monkeypatch.setattr(incremental, "next_state", lambda *args: (_ for _ in ()).throw(InterruptedError))
        with pytest.raises(InterruptedError):
            incremental.refresh(spark, raw, out)
    monkeypatch.setattr(incremental, "next_state", state)
    assert same(spark, raw, incremental.refresh(spark, raw, out))


def test_old_states_go(spark, load, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "KEPT_STATES", 1)
    raw, out, rows = str(tmp_path / "raw"), str(tmp_path / "out"), season_rows(7, ROUNDS[:3])
    for i in range(3):
        load(raw, rows, ROUNDS[i : i + 1])
        got = incremental.refresh(spark, raw, out)
    assert sinks.versions(spark, f"{out}/state/slots") == [2024003]
    assert same(spark, raw, got)
    # no state before the round is left: all rounds are read
    load(raw, season_rows(8, ROUNDS[1:2]), ROUNDS[1:2])
    assert same(spark, raw, incremental.refresh(spark, raw, out, since=ROUNDS[1]))


def test_nothing_stored(spark, tmp_path):
    assert incremental.stored_rounds(spark, str(tmp_path / "none")) == []
    at, state = incremental.read_state(spark, str(tmp_path / "none"), (2024, 1))
    assert at == 0 and all(df.isEmpty() for df in state.values())

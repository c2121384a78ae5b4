"""The race view gives the same rows when its groups are split."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paddock.plans import features, marts, race_view, staging
from paddock.registry import load
from paddock.session import shared_dir
from paddock.sources.sinks import materialize_table

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


def test_results(spark):
    got = race_view.results(spark, SF_DIR)
    places = got.groupBy("season", "round_number").agg(F.sort_array(F.collect_list("finish_position")).alias("p"))
    assert all(r.p == [float(n) for n in range(1, len(r.p) + 1)] for r in places.collect())


def test_laps(spark):
    got = race_view.laps(spark, SF_DIR, with_numbers=True)
    numbers = got.groupBy("season", "round_number", "driver_abbr").agg(F.sort_array(F.collect_list("lap_number")).alias("n"))
    assert all(r.n == list(range(1, len(r.n) + 1)) for r in numbers.collect())
    assert race_view.laps(spark, SF_DIR).where("lap_number IS NOT NULL").isEmpty()


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """The raw tables of the view, stored."""
    root = tmp_path_factory.mktemp("raw")
    frames = {"results": race_view.results, "laps": race_view.laps, "races": race_view.races}
    return {n: materialize_table(f(spark, SF_DIR), f"{root}/{n}") for n, f in frames.items()}


def frame(raw):
    results = staging.stg_results(raw["results"])
    return features.feature_frame(results, features.int_lap_analysis(staging.stg_lap_times(raw["laps"]), results))


PLANS = {
    "pl6": lambda raw: features.int_driver_race_features(frame(raw)),
    "pl7": lambda raw: marts.dim_drivers(features.driver_frame(staging.stg_results(raw["results"]))),
    "pl10": lambda raw: marts.fct_race_results(frame(raw), staging.stg_races(raw["races"])),
    "pl11": lambda raw: marts.fct_championship_standings(staging.stg_results(raw["results"])),
    "pl12": lambda raw: marts.fct_driver_performance(frame(raw)),
}


@pytest.mark.parametrize("name", PLANS)
def test_plans_write_nothing_and_run_nothing(spark, raw, name):
    folder = Path(shared_dir(spark).removeprefix("file:"))
    tracker, written = spark.sparkContext.statusTracker(), set(folder.iterdir())
    before = set(tracker.getJobIdsForGroup(None))
    plan = PLANS[name](raw)._jdf.queryExecution().executedPlan().toString()
    assert set(tracker.getJobIdsForGroup(None)) == before
    assert set(folder.iterdir()) == written
    if name == "pl7":
        assert "relative_pace" not in plan and "lap_time" not in plan


@pytest.mark.parametrize("name", ["pl3", "pl6", "pl10", "pl12"])
def test_registered_plans_are_small(spark, name):
    """Raw results are stored once per query; then no raw table is scanned over and over."""
    run = next(q.run for n, q in load().items() if n.startswith(f"{name}_"))
    plan = run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= (2 if name == "pl3" else 9)
    assert plan.count("Exchange hashpartitioning") <= (1 if name == "pl3" else 20)

"""Features and standings kept up to date round by round.

A refresh reads the touched rounds and a stored state, not the history before them. The state
has a row per driver (counts, sums, the last entries that rolling frames look back on), per
team and per grid slot; it is stored once per refresh under the last round it includes, so a
round that is loaded again starts from the state before it. The relations are partitioned by
season and round, and a refresh replaces the rounds it computed.

Expected finishes are taken from earlier races only (``as_of``); averages over all races would
change every earlier row with each round.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from paddock.operators.history import prior, prior_count_if, prior_rate, prior_stddev
from paddock.plans import features, staging
from paddock.plans.features import CARRIED, FEATURES, FILL, MOMENTUM_RACES, ROLLING_RACES, TOP_N
from paddock.plans.marts import race_positions
from paddock.plans.staging import ENTRY, RACE
from paddock.session import remove, scratch_scope
from paddock.sources.catalog import read_raw
from paddock.sources.sinks import PARTITIONS, materialize_table, replace_partition, versions

RELATIONS = ("int_driver_cumulative_stats", "int_driver_race_features", "fct_championship_standings")
#: States kept: a round can be loaded again as long as a state before it is there, else all rounds are read.
KEPT_STATES = 8
_KEEP_LAST = max(MOMENTUM_RACES, ROLLING_RACES)
_LAST_ENTRY = "array<struct<season: int, round_number: int, points: int, finish_position: double, is_dnf: boolean>>"
_LAST_VALUE = "array<struct<season: int, round_number: int, {}>>"
_COUNTS = ["races", *[f"top{n}" for n in TOP_N], "dnfs", "points"]
STATE = {
    "drivers": ", ".join(
        [
            "driver_abbr string",
            *[f"{c} bigint" for c in _COUNTS],
            "season int, season_points bigint",
            f"entries {_LAST_ENTRY}",
            f"finishes {_LAST_VALUE.format('surplus: double')}",
            f"laps {_LAST_VALUE.format('lap_time_std: double, race_pace: double')}",
        ]
    ),
    "teams": "team_name string, races bigint, dnfs bigint, points bigint",
    "slots": "grid_position int, finishes double, races bigint",
}


def _number(season: int, round_number: int) -> int:
    """A round as one rising number."""
    if not 0 <= round_number < 1000:
        raise ValueError(f"round {round_number} is out of range")
    return season * 1000 + round_number


def stored_rounds(spark: SparkSession, raw_root: str, table: str = "results") -> list[tuple[int, int]]:
    """Rounds of a raw table, from the names of its folders; nothing is read."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = path_of(raw_root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = store.globStatus(path_of(f"{raw_root}/{table}/season=*/round_number=*"))
    names = [re.search(r"season=(\d+)/round_number=(\d+)$", status.getPath().toString()) for status in found or []]
    return sorted((int(m[1]), int(m[2])) for m in names if m)


def read_state(spark: SparkSession, root: str, before: tuple[int, int]) -> tuple[int, dict[str, DataFrame]]:
    """The newest state that ends before a round, and the number of its last round (0 and empty tables without one)."""
    kept = [v for v in versions(spark, f"{root}/state/slots") if v < _number(*before)]
    if not kept:
        return 0, {name: spark.createDataFrame([], schema) for name, schema in STATE.items()}
    at = kept[-1]
    read = lambda name: spark.read.schema(STATE[name]).parquet(f"{root}/state/{name}/version={at}")
    return at, {name: read(name) for name in STATE}


def refresh(
    spark: SparkSession, raw_root: str, root: str, since: tuple[int, int] | None = None
) -> dict[str, DataFrame]:
    """Bring the relations below ``root`` up to the raw tables and give them.

    ``since`` is the first round that was loaded (again); by default the rounds after the last
    state. Rounds from there on are computed from the state before them. Rounds that are gone
    from the raw tables are not noticed; load them empty or start with a new ``root``.
    """
    rounds = stored_rounds(spark, raw_root)
    known = versions(spark, f"{root}/state/slots")
    first = since or next((r for r in rounds if not known or _number(*r) > known[-1]), None)
    if first is not None and rounds:
        at, state = read_state(spark, root, first)
        later_rounds = [r for r in rounds if _number(*r) > at]
        if later_rounds:
            # the bound is on the partition columns: no other folder is read
            season, number = later_rounds[0]
            later = f"season > {season} OR (season = {season} AND round_number >= {number})"
            results = staging.stg_results(read_raw(spark, raw_root, "results").where(later))
            raw_laps = read_raw(spark, raw_root, "lap_times").where(later)
            with scratch_scope(spark):
                _advance(spark, root, state, results, raw_laps, _number(*rounds[-1]), at)
    return {name: spark.read.parquet(f"{root}/{name}") for name in RELATIONS}


def _advance(
    spark: SparkSession,
    root: str,
    state: dict[str, DataFrame],
    results: DataFrame,
    raw_laps: DataFrame,
    last: int,
    at: int,
) -> None:
    """Compute the new rounds, store them, then the state after them.

    The state is the commit: states of rounds that are computed anew go first, so a refresh
    that ends early is repeated by the next one.
    """
    stored = versions(spark, f"{root}/state/slots")
    for version in [v for v in stored if v > at]:
        _drop_state(spark, root, version)
    results = materialize_table(results, label="new-results")
    analysis = features.int_lap_analysis(staging.stg_lap_times(raw_laps), results)
    rows = materialize_table(new_rows(results, analysis, state), label="new-rows")
    entries = rows.where("_is_new AND _has_result")
    made = {
        "int_driver_cumulative_stats": entries.selectExpr(*STATS),
        "int_driver_race_features": entries.select(*[c for c in CARRIED if c != "points"], *FEATURES),
        "fct_championship_standings": new_standings(results, state["drivers"]),
    }
    for name, relation in made.items():
        replace_partition(relation, f"{root}/{name}", PARTITIONS)
    for name, relation in next_state(rows, results, state).items():
        materialize_table(relation, f"{root}/state/{name}/version={last}")
    earlier = [v for v in stored if v <= at]
    for version in earlier[: max(0, len(earlier) + 1 - KEPT_STATES)]:
        _drop_state(spark, root, version)


def _drop_state(spark: SparkSession, root: str, version: int) -> None:
    for name in reversed(STATE):  # the last one written makes a state valid
        remove(spark, f"{root}/state/{name}/version={version}")


STATS = [
    *CARRIED,
    "prev_races_started",
    *[f"prev_top{n}_count" for n in TOP_N],
    "prev_dnf_count",
    "prev_cumulative_points",
    "prev_team_points",
    "points_momentum",
    "finish_consistency_raw AS finish_consistency",
    *[f"top{n}_rate" for n in TOP_N],
    "dnf_rate",
    "finish_consistency AS finish_consistency_filled",
]


def new_rows(results: DataFrame, analysis: DataFrame, state: dict[str, DataFrame]) -> DataFrame:
    """Rows of the new rounds with every feature, and the remembered entries they look back on.

    The windows run over new rows and the last entries of the state, told apart by flags in the
    window partition as in ``features.feature_frame``; counts and sums begin at the state's.
    """
    pace = F.col("relative_pace").alias("race_pace")
    laps = analysis.select(*ENTRY, "lap_time_std", pace, F.lit(True).alias("_has_laps"))
    entries = (
        with_teams(results.select(*CARRIED), state["teams"])
        .join(expectations(results, state["slots"]), ["grid_position", *RACE], "left")
        .withColumn("_has_result", F.lit(True))
    )
    fresh = entries.join(laps, ENTRY, "full").withColumns(
        {
            "_has_result": F.coalesce("_has_result", F.lit(False)),
            "_has_laps": F.coalesce("_has_laps", F.lit(False)),
            "_finished": F.coalesce(~F.col("is_dnf"), F.lit(False)),
            "surplus": F.col("expected_finish") - F.col("finish_position"),
            "_is_new": F.lit(True),
        }
    )
    drivers = state["drivers"]
    remembered = [
        _remembered(drivers, "entries", "_has_result"),
        _remembered(drivers, "finishes", "_finished"),
        _remembered(drivers, "laps", "_has_laps"),
    ]
    both = fresh
    for rows in remembered:
        both = both.unionByName(rows, allowMissingColumns=True)
    flags = {c: F.coalesce(c, F.lit(False)) for c in ("_has_result", "_has_laps", "_finished", "_is_new")}
    base = drivers.select("driver_abbr", *[F.col(c).alias(f"_{c}") for c in _COUNTS])
    both = both.withColumns(flags).join(base, "driver_abbr", "left").repartition("driver_abbr")
    return _with_history(both)


def _remembered(drivers: DataFrame, column: str, flag: str) -> DataFrame:
    rows = drivers.select("driver_abbr", F.explode(column).alias("_row"))
    return rows.select("driver_abbr", "_row.*", F.lit(True).alias(flag), F.lit(False).alias("_is_new"))


def _with_history(rows: DataFrame) -> DataFrame:
    keys = ["driver_abbr", "_has_result"]
    before, new = prior(keys), F.col("_is_new")
    finish, dnf = F.col("finish_position"), F.col("is_dnf")
    since = lambda name, added: F.coalesce(F.col(f"_{name}"), F.lit(0)) + F.coalesce(added, F.lit(0))
    counted = rows.withColumns(
        {
            "prev_races_started": since("races", prior_count_if(new, before)),
            **{
                f"prev_top{n}_count": since(f"top{n}", prior_count_if(new & (finish <= n) & ~dnf, before)) for n in TOP_N
            },
            "prev_dnf_count": since("dnfs", prior_count_if(new & dnf, before)),
            "prev_cumulative_points": since("points", F.sum(F.when(new, F.col("points"))).over(before)),
            "points_momentum": F.coalesce(F.avg("points").over(prior(keys, last=MOMENTUM_RACES)), F.lit(0.0)),
            "finish_consistency_raw": prior_stddev(F.when(~dnf, finish), prior(keys, last=ROLLING_RACES)),
        }
    )
    started = F.col("prev_races_started")
    finishes = prior(["driver_abbr", "_finished"], last=ROLLING_RACES)
    laps = prior(["driver_abbr", "_has_laps"], last=ROLLING_RACES)
    past = lambda flag, value, window: F.when(F.col(flag), F.avg(value).over(window))
    return counted.withColumns(
        {
            **{f"top{n}_rate": prior_rate(F.col(f"prev_top{n}_count"), started) for n in TOP_N},
            "dnf_rate": prior_rate(F.col("prev_dnf_count"), started),
            "finish_consistency": F.coalesce("finish_consistency_raw", F.lit(FILL["finish_consistency"])),
            "perf_vs_expected": F.coalesce(past("_finished", "surplus", finishes), F.lit(FILL["perf_vs_expected"])),
            "lap_time_consistency": F.coalesce(
                past("_has_laps", "lap_time_std", laps), F.lit(FILL["lap_time_consistency"])
            ),
            "relative_pace": F.coalesce(past("_has_laps", "race_pace", laps), F.lit(FILL["relative_pace"])),
            "grid_log": staging.grid_log(F.col("grid_position")),
            "driver_points": F.col("prev_cumulative_points"),
            "team_points": F.col("prev_team_points"),
        }
    )


def _team_races(results: DataFrame) -> DataFrame:
    return results.groupBy("team_name", *RACE).agg(
        F.sum("points").alias("_p"), F.bool_or("is_dnf").cast("int").alias("_d")
    )


def with_teams(results: DataFrame, teams: DataFrame) -> DataFrame:
    """New results with ``prev_team_points`` and ``team_reliability``, which begin at the state's."""
    before = prior(["team_name"])
    since = lambda name, added: F.coalesce(F.col(name), F.lit(0)) + F.coalesce(added, F.lit(0))
    races = since("races", F.count(F.lit(1)).over(before))
    rate = 1.0 - since("dnfs", F.sum("_d").over(before)).cast("double") / races
    told = _team_races(results).join(teams, "team_name", "left").select(
        "team_name",
        *RACE,
        since("points", F.sum("_p").over(before)).alias("prev_team_points"),
        F.when(races > 0, rate).otherwise(F.lit(FILL["team_reliability"])).alias("team_reliability"),
    )
    return results.join(told, ["team_name", *RACE], "left").withColumn(
        "prev_team_points", F.coalesce("prev_team_points", F.lit(0))
    )


def _slot_races(results: DataFrame) -> DataFrame:
    return results.where(~F.col("is_dnf")).groupBy("grid_position", *RACE).agg(
        F.sum("finish_position").alias("_sum"), F.count("finish_position").alias("_n")
    )


def expectations(results: DataFrame, slots: DataFrame) -> DataFrame:
    """Mean finish of each grid slot over races before each new one."""
    before = prior(["grid_position"])
    # as in a build over all races, a slot without a finisher in the race has no row there
    own = _slot_races(results).join(slots, "grid_position", "left")
    # a sum of nothing is NULL, and so is the mean
    summed = lambda first, added: F.coalesce(F.col(first) + F.coalesce(added, F.lit(0)), added)
    total = summed("finishes", F.sum("_sum").over(before))
    n = F.coalesce(F.col("races"), F.lit(0)) + F.coalesce(F.sum("_n").over(before), F.lit(0))
    return own.select("grid_position", *RACE, F.when(n > 0, total / n).alias("expected_finish"))


def new_standings(results: DataFrame, drivers: DataFrame) -> DataFrame:
    """Running points of the new rounds, on top of the state's points of the same season, and the rank in each race."""
    so_far = W.partitionBy("season", "driver_abbr").orderBy("round_number")
    base = drivers.select("driver_abbr", "season", "season_points")
    totals = (
        results.select(*ENTRY, "team_name", F.col("points").alias("race_points"))
        .join(base, ["driver_abbr", "season"], "left")
        .withColumn(
            "total_points", F.sum("race_points").over(so_far) + F.coalesce("season_points", F.lit(0))
        )
    )
    return race_positions(totals.select(*ENTRY, "team_name", "race_points", "total_points"))


def next_state(rows: DataFrame, results: DataFrame, state: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The state after the new rounds."""
    finish, dnf, points = F.col("finish_position"), F.col("is_dnf"), F.col("points")
    entry = F.col("_is_new") & F.col("_has_result")
    at = [F.col("season").alias("season"), F.col("round_number").alias("round_number")]

    def last(flag: str, *columns: str) -> Column:
        """The newest rows of a kind, oldest first; a driver has one row per race."""
        kept = F.collect_list(F.when(F.col(flag), F.struct(*at, *columns)))
        newest = F.slice(F.sort_array(kept, asc=False), 1, _KEEP_LAST)
        return F.sort_array(newest)

    count = lambda condition: F.count_if(entry & condition)
    added = rows.groupBy("driver_abbr").agg(
        count(F.lit(True)).alias("+races"),
        *[count((finish <= n) & ~dnf).alias(f"+top{n}") for n in TOP_N],
        count(dnf).alias("+dnfs"),
        F.sum(F.when(entry, points)).alias("+points"),
        F.max(F.when(entry, F.col("season"))).alias("+season"),
        last("_has_result", "points", "finish_position", "is_dnf").alias("entries"),
        last("_finished", "surplus").alias("finishes"),
        last("_has_laps", "lap_time_std", "race_pace").alias("laps"),
    )
    seasons = results.groupBy("driver_abbr", F.col("season").alias("+season")).agg(F.sum("points").alias("+season_points"))
    old = state["drivers"].drop("entries", "finishes", "laps")
    both = added.join(seasons, ["driver_abbr", "+season"], "left").join(old, "driver_abbr", "full")
    plus = lambda c: (F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"+{c}"), F.lit(0))).cast("bigint").alias(c)
    same = F.col("+season").isNull() | F.col("+season").eqNullSafe(F.col("season"))
    carried = F.when(same, F.coalesce("season_points", F.lit(0))).otherwise(0)
    drivers = both.select(
        "driver_abbr",
        *[plus(c) for c in _COUNTS],
        F.coalesce("+season", "season").alias("season"),
        (carried + F.coalesce("+season_points", F.lit(0))).cast("bigint").alias("season_points"),
        "entries",
        "finishes",
        "laps",
    )

    def merged(stored: DataFrame, new: DataFrame, key: str, **columns: Column) -> DataFrame:
        kinds = {f.name: f.dataType for f in stored.schema.fields}
        own = new.groupBy(key).agg(*[c.cast(kinds[name]).alias(name) for name, c in columns.items()])
        every = stored.unionByName(own)
        return every.groupBy(key).agg(*[F.sum(name).cast(kinds[name]).alias(name) for name in columns])

    n = F.count(F.lit(1))
    return {
        "drivers": drivers,
        "teams": merged(
            state["teams"], _team_races(results), "team_name", races=n, dnfs=F.sum("_d"), points=F.sum("_p")
        ),
        "slots": merged(
            state["slots"], _slot_races(results), "grid_position", finishes=F.sum("_sum"), races=F.sum("_n")
        ),
    }

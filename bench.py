"""Time the headline queries and print one JSON line, with the jobs and shuffles of each.

``ag7_median``, ``wn12_rank_orders`` and ``pl11`` have groups that hold a third to a tenth of
all rows, so they show the path of large groups.

BENCH_SF_DIR: folder with the tables (default /root/testdata/sf0.1).
BENCH_CPUS: local cores (default: all). BENCH_RUNS: runs per query; the best one counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import pyspark  # noqa: E402

from paddock.registry import load  # noqa: E402
from paddock.session import local_session  # noqa: E402

HEADLINE = [
    "pl2_stg_results",
    "pl3_stg_lap_times",
    "pl4_int_lap_analysis",
    "pl5_int_driver_cumulative_stats",
    "pl6_int_driver_race_features",
    "pl7_dim_drivers",
    "pl8_dim_teams",
    "pl9_dim_circuits",
    "pl10_fct_race_results",
    "pl11_fct_championship_standings",
    "pl12_fct_driver_performance",
    "pl13_fct_race_summary",
    "src3_build_results",
    "snk2_upsert_results",
    "scd3_hard_deletes",
    "scd4_history_from_facts",
    "st5_dedup_by_event_id",
    "jn1_inner",
    "ag4_sum_avg_min_max",
    "ag7_median",
    "ag11_pivot",
    "wn5_rolling_avg_orders",
    "wn12_rank_orders",
    "wn13_row_number",
    "top1_deduplicate",
    "set3_except",
    "set5_unpivot",
    "fn7_surrogate_key",
    "fn9_haversine_pairs",
    "fn12_url_breakdown",
    "dq5_equality",
    "dq8_mutually_exclusive_ranges",
    "dq15_sequential_values",
    "dq16_unique_combination",
    "dq29_raw_results_suite",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, int(cpus))
    registered = load()
    registered["ag1_count"].run(spark, sf_dir).collect()
    seconds, jobs, exchanges = {}, {}, {}
    for name in HEADLINE:
        times = []
        for run in range(runs):
            spark.sparkContext.setJobGroup(f"{name}-{run}", name)
            start = time.perf_counter()
            result = registered[name].run(spark, sf_dir)
            result.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
            jobs[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"{name}-{run}"))
        seconds[name] = round(min(times), 3)
        plan = result._jdf.queryExecution().executedPlan().toString()
        exchanges[name] = plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "jobs": jobs,
                "exchanges": exchanges,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
                "spark": pyspark.__version__,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Times the headline queries, warm, and prints one JSON line."""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import tempfile
import time

from daystar.session import INITIAL_PARTITIONS, build_session
from daystar.suite.queries import QUERIES

HEADLINE = [
    "silver_cases",
    "silver_tests",
    "dim_date",
    "fact_cases",
    "fact_testing",
    "fact_denormalised",
    "moving_avg_positivity",
    "first_n_per_region",
    "cases_trend",
    "combined_tests",
    "top_new_cases_on_date",
    "positivity_trend",
    "cases_vs_tests",
    "daily_total_new_cases",
    "top_regions_total",
    "orphan_dates",
    "daily_delta_signed",
    "daily_delta_cut_series",
    "cast_lenient_long",
    "qa_count_by_region",
    "pipeline_star",
    "pipeline_default",
    "cases_vs_tests_by_key",
    "appended_days",
    "preview_ranges",
]


WIDE = ["silver_cases", "fact_cases", "cases_trend", "combined_tests"]


def timed(spark, sf_dir, name, runs):
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        # Every column of every row is computed; nothing is stored or collected.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - start)
    return statistics.median(seconds)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.checkpoint.dir": scratch,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
        partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        timed(spark, sf_dir, name, 1)
    times = {name: round(timed(spark, sf_dir, name, runs), 3) for name in names}
    # A few again with the partitions that a session starts with where none are given.
    spark.conf.set(
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(INITIAL_PARTITIONS)
    )
    wide = {name: round(timed(spark, sf_dir, name, 1), 3) for name in WIDE if name in times}
    spark.stop()
    shutil.rmtree(scratch, ignore_errors=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "with_session_partitions": {"partitions": INITIAL_PARTITIONS, **wide},
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()

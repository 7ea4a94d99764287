"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of local cores. The trip
files that the analyses read are derived from the tables before the clock starts. Each
query runs once to warm up and then BENCH_RUNS times; its median counts. Results go to
Spark's no-op sink, so every row is computed and none is kept.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rideframe.catalog import QUERIES  # noqa: E402
from rideframe.catalog.fixtures import trip_files  # noqa: E402
from rideframe.session import build_session, shuffle_partitions_for  # noqa: E402

HEADLINE = (
    "price_anomaly",
    "price_anomaly_df",
    "tip_impact_weather",
    "tip_impact_df",
    "price_anomaly_report",
    "tip_diff_report",
    "feature_profile",
    "class_averages",
    "class_avg_broadcast_join",
    "zone_minutes",
    "trim_outliers",
    "weather_broadcast_join",
    "all_combinations_impact",
    "monthly_pattern",
    "tip_by_feature_bin",
    "top_amounts",
)


def input_bytes(sf_dir: str) -> int:
    return sum(entry.stat().st_size for entry in os.scandir(sf_dir) if entry.is_file())


def run(spark, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "rideframe-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=shuffle_partitions_for(input_bytes(sf_dir), cpus),
        extra={
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    trip_files(spark, sf_dir)
    seconds = {}
    for name in names:
        run(spark, sf_dir, name)
        seconds[name] = round(statistics.median(run(spark, sf_dir, name) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

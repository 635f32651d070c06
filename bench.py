"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then three times, written to nowhere; the median counts.
Queries that warm up for longer than three seconds run once more only.
``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose input and cores.
"""

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from downfold.plans.catalog import QUERIES

HEADLINE = (
    "accepted_alarms decode_errors downtime_intervals downtime_intervals_ttl latest_node_state "
    "downtime_intervals_sliced downtime_intervals_from_messages "
    "state_transitions active_down_nodes active_down_series state_misses node_flaps shard_balance "
    "total_outages affected_nodes uptime_pct_by_node outages_over_time top_nodes_downtime "
    "duration_histogram hourly_pattern recent_outages max_outages_per_node daily_node_partials "
    "node_sla_report event_rate_sliding counter_rate histogram_quantile exact_quantiles "
    "ingest_lag_gauge e2e_quantiles domain_metrics alert_state evaluate_rules write_intervals "
    "downtime_intervals_stream interval_job"
).split()

RUNS = 3
LONG = 3.0


def seconds(run, spark, sf_dir):
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("downfold-bench")
        .config("spark.sql.shuffle.partitions", cpus.replace("*", "8"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="downfold-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    times, rows_per_sec = {}, 0
    for name in only or HEADLINE:
        run = QUERIES[name].run
        runs = RUNS if seconds(run, spark, sf_dir) < LONG else 1
        times[name] = round(statistics.median(seconds(run, spark, sf_dir) for _ in range(runs)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    if "downtime_intervals" in times:
        alarms = spark.read.parquet(f"{sf_dir}/events.parquet").count()
        rows_per_sec = round(alarms / times["downtime_intervals"])
    print(
        json.dumps(
            {
                "metric": "total_seconds_of_headline_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": cpus,
                "alarms_folded_per_sec": rows_per_sec,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()

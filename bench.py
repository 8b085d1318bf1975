"""Headline timings as one line of JSON.

``queries`` runs on the tables in ``$BENCH_SF_DIR``, each the best of
``$BENCH_REPEATS`` runs; ``phases`` runs the whole job
on ``$BENCH_RECORDS`` generated records (0 to leave it out): generate and store,
order by all keys, verify and reconcile, each with its records per second.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"

from pyspark.sql import SparkSession  # noqa: E402

from feedloom import scratch  # noqa: E402
from feedloom.contract import SORT_KEYS  # noqa: E402
from feedloom.plans import job  # noqa: E402
from feedloom.plans.queries import all_queries  # noqa: E402
from feedloom.sinks.files import write_feed  # noqa: E402
from feedloom.sources.files import scan_feed  # noqa: E402
from feedloom.sources.synthetic import generate_feed  # noqa: E402

HEADLINES = (
    "three_orderings", "sorted_by_id", "sorted_by_name", "sorted_by_continent", "sorted_runs",
    "merge_runs", "parse_feed", "rejects", "intake_stats", "cap_per_partition", "fixed_batches",
    "head_of_ordering", "throughput", "idle_cut", "milestones", "verify_sorted", "reconcile",
    "stream_sort", "generate_feed",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def run_to_end(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def phases(spark: SparkSession, records: int, cpus: int) -> dict[str, float]:
    path = scratch.new_path(spark, "bench")
    seconds = {
        "generate": timed(
            lambda: write_feed(generate_feed(spark, records, tasks=4 * cpus), f"{path}/feed")
        ),
        "order": timed(lambda: job.order_feed(scan_feed(spark, f"{path}/feed"), path)),
        "read_orderings": timed(
            lambda: [
                run_to_end(job.read_ordering(spark, f"{path}/key={key}")) for key in SORT_KEYS
            ]
        ),
        "verify": timed(lambda: [checked.collect() for checked in job.report(spark, path).values()]),
    }
    total = seconds["generate"] + seconds["order"]
    return {
        **{f"{name}_sec": round(value, 3) for name, value in seconds.items()},
        "order_records_per_sec": round(records / seconds["order"]),
        "end_to_end_records_per_sec": round(records / total),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    records = int(os.environ.get("BENCH_RECORDS", "5000000"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("feedloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(2 * cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINES
    seconds = {}
    for name in names:
        runs = [timed(lambda: run_to_end(queries[name](spark, sf_dir))) for _ in range(repeats)]
        seconds[name] = round(min(runs), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    if records:
        result["generated_records"] = records
        result["phases"] = phases(spark, records, cpus)
    print(json.dumps(result))
    scratch.release(spark)
    spark.stop()


if __name__ == "__main__":
    main()

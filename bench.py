"""Headline timings: one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the tables and the local cores."""
import json
import os
import statistics
import time

from stintflow.session import local_session
from stintflow.sources.shared import staging
from stintflow.workload import QUERIES

HEADLINE = ("running_score", "lineup_fold", "lineup_on_event", "possessions_corrected", "possession_start", "foul_stats",
            "garbage_time", "lineup_stats", "lineup_index", "attach_lineup_ids", "schedule_pairs", "group_filter", "rows_update",
            "first_per_key", "pivot_first", "unpivot_cols", "scan_season_files", "season_outputs")


def seconds(spark, key: str, sf_dir: str) -> float:
    start = time.perf_counter()
    with staging(spark):
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session("bench", cores=cores, partitions=int(cores))
    timings = {}
    for key in HEADLINE:
        seconds(spark, key, sf_dir)  # warm-up
        timings[key] = round(statistics.median(seconds(spark, key, sf_dir) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

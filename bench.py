"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 1, the median counts), BENCH_FILES (default 16: the trips' source table is
rewritten in that many files before anything is timed, as one file with one row group is read by a
single task; 0 leaves it as it is). Every query runs once before it is timed.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from datetime import datetime
from pathlib import Path

from tripledger.catalog import QUERIES, SETTINGS, Frames
from tripledger.plans import pipeline
from tripledger.session import local_session, scratch_dir
from tripledger.sources.tables import Store

HEADLINE = (
    "trip_feed", "silver_typed", "dq_evaluated", "id_occurrences", "silver_trips", "quarantine",
    "trip_performance", "demand_metrics", "geographic_metrics", "vendor_performance",
    "data_quality", "kpi_012", "kpi_rollup", "exec_tiles", "top_areas_routes",
    "quarantine_breakdown", "profile_schema", "profile_numeric_stats", "profile_geo",
    "profile_quality", "duration_by_dim", "duplicate_types", "threshold_candidates", "star_schema",
)


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def full_build(spark, sf_dir: str) -> None:
    """Silver and gold tables from landing text, stored."""
    store = Store(spark, scratch_dir(spark, "bench-build"))
    pipeline.build(Frames(spark, sf_dir).landed, store, SETTINGS)


def full_profile(spark, sf_dir: str) -> None:
    """The six profile tables, stored."""
    frames = Frames(spark, sf_dir)
    store = Store(spark, scratch_dir(spark, "bench-profile"))
    judged = store.replace("silver", "silver_dq_evaluated", frames.judged)
    pipeline.write_profile(frames.landed, judged, store, SETTINGS, "BENCH", datetime(2024, 1, 1))


def timed(action, repeat: int) -> float:
    action()
    times = []
    for _ in range(repeat):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "tripledger-bench")
    files = int(os.environ.get("BENCH_FILES", "16"))
    if files:
        split = scratch_dir(spark, "bench-tables")
        (spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(files)
         .write.parquet(f"{split}/lineitem.parquet"))
    sf_name, sf_dir = Path(sf_dir).name.removeprefix("sf"), split if files else sf_dir
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    seconds = {name: timed(lambda: run(QUERIES[name](spark, sf_dir)), repeat) for name in HEADLINE}
    for name, action in (("full_build", full_build), ("full_profile", full_profile)):
        seconds[name] = timed(lambda: action(spark, sf_dir), 1)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": {name: round(s, 3) for name, s in seconds.items()},
        "sf": sf_name,
    }))


if __name__ == "__main__":
    main()

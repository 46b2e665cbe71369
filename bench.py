"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores (default 8).
"""

from __future__ import annotations

import json
import os
import pathlib
import sys
import time

from millrace.plans import QUERIES
from millrace.session import local_session

# One per kind of work: scan and project, group, running totals, ranges, ledger, meters, writes.
HEADLINE = [
    "process_messages",
    "json_to_csv",
    "encode_payload",
    "dead_letter",
    "route",
    "group_by_key",
    "batch_messages",
    "size_rolls",
    "idle_rolls",
    "topic_throughput",
    "offset_ranges",
    "line_offsets",
    "read_new_lines",
    "read_ranges",
    "batch_lines",
    "deletable_files",
    "latest_state",
    "mark_run",
    "mark_done",
    "status_counts",
    "page",
    "value_distribution",
    "encode_values",
    "decode_values",
    "path_tree",
    "resolve_settings",
    "write_hourly",
    "hourly_stream",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    seconds(spark, "status_counts", sf_dir)  # start the engine
    times = {name: round(seconds(spark, name, sf_dir), 3) for name in names}
    spark.stop()
    scale = pathlib.Path(sf_dir).name.removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(scale)}
        )
    )


if __name__ == "__main__":
    main()

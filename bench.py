"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once to warm up and then three times; the median counts. All result rows are produced (a sink
that discards them), so nothing is optimised away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from catalog import QUERIES
from tests.session import local_session
from tidespan.sources.scratch import workspace

HEADLINE = {
    # query: table whose rows count as its input
    "campaign_counts": "events",
    "equi_join_throughput": "lineitem",
    "start_edge_join": "lineitem",
    "perf_where": "lineitem",
    "perf_select": "lineitem",
    "perf_count": "lineitem",
    "perf_sum": "lineitem",
    "perf_average": "lineitem",
    "perf_max": "lineitem",
    "perf_min": "lineitem",
    "perf_group_count": "lineitem",
    "group_apply": "events",
    "cross_join": "events",
    "anti_join": "events",
    "detect_sequence": "events",
    "detect_plus_plus": "events",
    "session": "events",
    "count_by_return_flag": "lineitem",
    "maximum": "events",
    "snapshot_general": "events",
    "sum_doubles": "events",
    "extremes_open": "events",
    "percentile_continuous": "events",
    "stream_tumbling": "events",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    spark = local_session(cpus, cpus)
    rows = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in {HEADLINE.get(n, "events") for n in names}}

    def run(name: str) -> float:
        with workspace(spark):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = statistics.median(run(name) for _ in range(3))
    report = {
        "metric": "total of the median times of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {n: round(s, 3) for n, s in seconds.items()},
        "rows_per_sec": {n: round(rows[HEADLINE.get(n, "events")] / s) for n, s in seconds.items()},
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()

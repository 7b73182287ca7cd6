"""Time the headline queries: one JSON line on stdout.

Reads BENCH_SF_DIR (default sf0.1) with BENCH_CPUS cores. Every query is run to
its last row through a no-op sink, once to warm up and once timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bindings import QUERIES  # noqa: E402
from dockwise.session import local_session  # noqa: E402

HEADLINE = [
    "net_counts",
    "daily_unit_totals",
    "daily_period_group_totals",
    "turnstile_pipeline",
    "monthly_summary",
    "annual_by_year",
    "stale_flag",
    "status_pipeline",
    "join_station_by_id_era",
    "trips_summary_year",
    "trips_summary_all",
    "stations_of_trips",
    "harmonize_trips",
    "scan_comments",
    "bin_sum_lineitem",
    "focal_sum_lineitem",
    "rasterize_lines",
    "rasterize_polygons",
    "clip_points",
    "distance_to_nearest",
    "nearest_value",
    "normalize",
    "siting_pipeline",
    "suitability",
    "stream_net_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    seconds = {}
    for name in names:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    line = {
        "metric": "headline queries, warm, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()

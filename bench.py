"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the data and the cores.
Each query runs once to warm the JVM and then BENCH_RUNS times (default 1); the median counts. Results
are computed in full by the no-op sink.
"""

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from unitgrid.plans import catalog  # noqa: E402
from unitgrid.session import local_session  # noqa: E402

HEADLINE = [
    "night_index_table", "k2_normalize", "k4_progress", "d5_merge_valid", "d8_count_scenes", "c8_cloud_filter_or_all",
    "c10_prefer_collection", "e1_zonal_stats", "e2_night_zonal", "e3_composite_median", "i1_add_indices", "d10_clip_zonal",
    "d13_clip_line_length", "j3_open_lines", "j5_components_8", "j7_water_metrics", "j8_industrial_metrics",
    "j9_road_metrics", "f5_failure_streaks", "g1_natural_order", "e13_latest_by", "d12_compare_rasters", "l4_tumbling_counts",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "unitgrid-bench")
    seconds = {}
    for name in HEADLINE:
        runs = []
        for attempt in range(1 + int(os.environ.get("BENCH_RUNS", "1"))):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:] or runs), 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                      "sf": float(scale.group(1)) if scale else None}))


if __name__ == "__main__":
    main()

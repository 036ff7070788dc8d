"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 2), BENCH_QUERIES (comma separated names, or ``all``).
Each query runs once to warm up and then BENCH_RUNS times into the noop sink; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import headwater.plans  # noqa: E402, F401
from headwater import build_session  # noqa: E402
from headwater.plans.registry import REGISTRY  # noqa: E402

HEADLINE = [
    "huc_statistics", "secondary_metrics", "metric_summary", "normalize_projects", "index_projects", "search_projects",
    "search_facets", "map_clusters", "rme_wide", "dgo_igo_view", "missing_or_stale", "match_collect", "match_most_recent",
    "sync_compare", "points_in_bbox", "huc4_status", "percent_complete", "task_cost", "older_duplicates", "latest_by_version",
    "epoch_metrics_table", "metrics_eav_to_wide", "measurement_docs", "tags_canonical", "content_hash",
    "ras_bin_continuous", "ras_bin_categorical", "ras_mosaic", "ras_overviews", "vec_measures", "vec_dissolve",
    "vec_simplify_coverage", "ras_zone_mask",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(REGISTRY) if wanted == "all" else wanted.split(",") if wanted else HEADLINE

    spark = build_session("bench", f"local[{cpus}]", cpus, spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale, "cpus": cpus}))


if __name__ == "__main__":
    main()

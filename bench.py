"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: one JSON line with seconds per query.

Each query runs once to warm up, then ``BENCH_RUNS`` times (default 1); the
median counts.  Results go to the ``noop`` sink, so all rows are computed and
nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from catalog import QUERIES
from framewright.session import local_session

HEADLINE = (
    "ag05_frame_fates",
    "ag03_frame_report",
    "so01_review_order",
    "so03_category_order",
    "wn06_numbered_boxes",
    "jn07_box_iou_merge",
    "ag31_detection_quality",
    "wn12_ordered_dedupe",
    "wn02_stratified_split",
    "wn01_scene_numbers",
    "job_handmade_tally",
    "ag09_findings",
    "prj13_trust_verdict",
    "ag16_scorecard",
    "ag18_run_comparison",
    "ag25_brand_palettes",
    "jn08_similar_pairs",
    "gr01_duplicate_groups",
)


def run(build, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, app="bench", partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(QUERIES[name], spark, sf_dir)
        seconds[name] = round(statistics.median(run(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

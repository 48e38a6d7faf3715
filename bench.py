"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gripline.plans import catalog  # noqa: E402
from gripline.sources.session import SETTINGS  # noqa: E402

HEADLINE = (
    "step_index",
    "gripper_norm",
    "grasp_phases",
    "phase_ranges",
    "five_phase_confidence",
    "smooth_phases",
    "contact_metrics",
    "threshold_sweep",
    "future_trace",
    "nearest_camera",
    "fit_affine",
    "trace_summary",
    "export_frames",
    "export_trajectory",
    "contact_patch",
    "point_cloud",
    "mask_bbox",
    "best_gripper",
    "normalize_segments",
    "grounding_record",
    "mark_tasks",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    for name, value in {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.log.level": "ERROR",
    }.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    catalog.QUERIES["gripper_range"](spark, folder).write.format("noop").mode("overwrite").save()  # start-up outside the clock
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        began = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()

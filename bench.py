"""Times the headline queries; prints one JSON line."""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from quarry.plans import catalogue

HEADLINE = (
    "q03_count_class_dist", "q06_obb_features", "q07_pair_overlap", "q09_confidence_profile",
    "q10_triage_score", "q12_simhash_pairs", "q14_dup_components", "q16_stratified_split", "q17_split_leakage",
    "q20_frame_stride", "q21_time_spaced", "q22_log_pattern_counts", "q32_quality_score",
    "q08_rotated_iou", "q24_greedy_match", "q25_issue_summary", "q47_detection_profile", "q61_image_statistics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small but heavy partitions
        .config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='quarry-bench-')}")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = catalogue.queries(), {}
    queries["q03_count_class_dist"](spark, sf_dir).collect()  # warm-up
    for name in HEADLINE:
        began = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()

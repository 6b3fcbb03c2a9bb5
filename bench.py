"""Time the headline queries; prints one JSON line."""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from auditloom.plans import checks  # noqa: E402

HEADLINE = [
    "audit_flatten",
    "class_rollup",
    "extract_json",
    "parse_reasons",
    "conform_types",
    "event_validation",
    "fan_out",
    "reconcile",
    "event_summary",
    "latest_generation",
    "attempt_numbers",
    "delete_plan",
    "job_claim",
    "job_upsert",
    "delete_superseded",
    "delete_object",
    "merge_urls",
    "active_records",
    "first_per_image",
    "url_payload",
    "config_versions",
    "taxonomy",
    "fraction_check",
    "weight_check",
    "score_batch",
    "table_changes",
    "stream_latest",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Warm the JVM before the clock runs: one flagship run on the smallest data.
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    checks.QUERIES["audit_flatten"](spark, small if os.path.isdir(small) else sf_dir).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        checks.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

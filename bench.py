"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (input folder), BENCH_CPUS (local cores).
"""
from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pitf.catalog import registered  # noqa: E402

HEADLINE = (
    "label_base_rate", "transaction_profile", "feature_snapshot", "feature_table", "labels_relative",
    "monthly_activity_profile", "cutoff_feasibility", "label_sweep", "chosen_cutoff", "adaptive_cutoff",
    "amount_quantiles", "ranking_metrics", "candidate_metrics", "gate_decisions", "registry_promoted",
    "score_drift", "feature_drift", "latest_predictions", "raw_transactions",
    "trained_candidate_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start-up is not part of any query

    times = {}
    catalogue = registered.queries()
    for name in HEADLINE:
        start = time.perf_counter()
        catalogue[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": Path(sf_dir).name}))
    spark.stop()


if __name__ == "__main__":
    main()

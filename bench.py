"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Each query runs once unmeasured, then the median of the measured runs counts; a run includes building
the plan and consuming every row.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskspark.catalog import QUERIES  # noqa: E402
from riskspark.session import local_session  # noqa: E402

HEADLINE = {
    "delinquency_features": "delinquency_features",
    "forward_outcomes": "forward_outcomes",
    "credit_report_asof": "credit_report_asof",
    "credit_report_min_score": "credit_report_min_score",
    "staging_rules": "staging_rules",
    "stage_totals": "stage_totals",
    "stage_walk": "stage_walk",
    "default_rate_by_month": "default_rate_by_month",
    "sample_account_month": "sample_account_month",
    "roc_auc_gini": "roc_auc_gini",
    "average_precision": "average_precision",
    "customer_scores": "customer_scores",
    "admission_data": "admission_data",
    "sampled_tape": "sampled_tape",
    "training_set": "training_set",
    "compare_scores": "compare_scores",
    "model_metrics_by_split": "model_metrics_by_split",
    "tape_anova": "tape_anova",
}


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, memory="16g")
    times = {}
    for label, name in HEADLINE.items():
        timed(spark, name, sf_dir)
        times[label] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({"metric": "headline queries, summed median seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()

"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.queries import REGISTRY  # noqa: E402
from ledgerline.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))
# Fits take part once: their cost is the passes over the rows, not the first compilation.
FITS = {"logistic_regression", "decision_tree", "boosted_trees"}

HEADLINE = [
    "csv_date_range_scan",
    "cleaned_loans",
    "missing_rates",
    "duplicate_rows",
    "date_order_check",
    "numeric_summary",
    "describe_numeric",
    "iqr_outliers",
    "correlation_matrix",
    "categorical_cardinality",
    "split_by_rank",
    "split_by_position",
    "hash_sample",
    "series_pivot",
    "loans_with_state_series",
    "rate_by_rounded_series",
    "rate_by_grade_and_regime",
    "rate_by_state_difference",
    "feature_chain",
    "full_evaluation",
    "roc_corner_points",
    "threshold_sweep",
    "rejected_applicants",
    "risk_tiers",
    "applicants_under_scenarios",
    "nearest_neighbor_scores",
    "logistic_regression",
    "decision_tree",
    "boosted_trees",
]


def seconds(spark, name: str) -> float:
    """One run; every column of every row is produced and thrown away."""
    started = time.perf_counter()
    REGISTRY[name].run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = local_session("bench", cores=CPUS, shuffle_partitions=int(CPUS))
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        if name in FITS:
            times[name] = round(seconds(spark, name), 4)
            continue
        seconds(spark, name)  # warm
        times[name] = round(statistics.median(seconds(spark, name) for _ in range(REPEATS)), 4)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()

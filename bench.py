"""Benchmark: headline catalog queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed completely with a ``noop`` write (no collect to the driver) and
timed; one JSON line is printed:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "cap_outliers", "missing_profile", "describe_columns", "target_correlation", "correlation_matrix",
    "iqr_bounds", "class_distribution", "best_threshold_pr", "roc_auc", "average_precision",
    "evaluate_on_test", "threshold_sensitivity", "best_threshold_grid", "class_report",
    "stratified_split", "yeo_johnson", "apply_median", "polynomial_features", "mean_probability",
    "optimise_ensemble", "vote", "compare_variants", "impute_knn",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from stratum.session import get_session
    from stratum.plans.catalog import REGISTRY
    spark = get_session(f"local[{cpus}]", int(cpus))
    times = {}
    for n in names:
        fn = REGISTRY[n][0]
        t0 = time.time()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[n] = round(time.time() - t0, 3)
        except Exception as e:  # keep going; a failed query is reported as null
            print(f"{n} failed: {type(e).__name__}: {str(e)[:300]}", file=sys.stderr)
            times[n] = None
    ok = [v for v in times.values() if v is not None]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(ok), 3), "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir, "failed": len(times) - len(ok)}))
    spark.stop()


if __name__ == "__main__":
    main()

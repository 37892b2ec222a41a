"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "rows", "sf"};
``rows`` are the row counts, to be compared between runs.
Each query result is fully materialised (``count`` over the whole result
through a no-op write, so every column is computed).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "model_matrix", "supplier_features", "plateau_flags", "impute_target", "lag_features",
    "rolling_features", "interpolate_gaps", "hourly_grid", "panel_join", "clip_rules",
    "sequence_windows", "time_folds", "cv_summary", "group_metrics", "portfolio_metrics",
    "knn_regression", "forest_forecast",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from gridcast.session import get_session
    from gridcast.plans.queries import Q

    spark = get_session(f"local[{cpus}]", int(cpus) * 2, app="gridcast-bench",
                        extra={"spark.driver.memory": "16g"})
    names = [n for n in HEADLINE if n in Q]
    if len(sys.argv) > 1:
        names = [n for n in sys.argv[1:] if n in Q]
    # warm-up: JVM start and first-query planning are not query time
    Q["normalize_target"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, rows = {}, {}
    for name in names:
        t0 = time.time()
        seen = Observation()
        Q[name](spark, sf_dir).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
        times[name], rows[name] = round(time.time() - t0, 3), seen.get.get("n")
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "rows": rows, "sf": sf}))


if __name__ == "__main__":
    main()

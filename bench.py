"""Time the headline queries: one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS choose data, cores and repeats. Each query runs BENCH_RUNS times (2 by
default) and its last, warm run counts. Results go to a sink that takes all columns of all rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelkit.session import local_session  # noqa: E402
from panelkit.workload import cases, inputs  # noqa: E402

HEADLINE = (
    "weekly_panel",
    "lag_family",
    "rolling_mean_median",
    "panel_features",
    "panel_train",
    "panel_test",
    "series_summary",
    "series_bins",
    "series_stats",
    "unit_slope_line",
    "slope_line_half",
    "feature_matrix",
    "label_table",
    "auc_scores",
    "regression_by_entity",
    "ensemble_mean",
    "vote_mode",
    "counts_and_ratio",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=cpus, memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    all_cases = cases()
    inputs.ROUNDING = False
    spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_suppkey").count().write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        for _ in range(runs):
            start = time.perf_counter()
            all_cases[name][0](spark, sf).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_wall_time", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()

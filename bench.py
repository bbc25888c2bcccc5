"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS] and prints one JSON line."""

import json
import os
import statistics
import time
import warnings

warnings.filterwarnings("ignore")

from fleetrisk.checks import all_queries  # noqa: E402
from fleetrisk.session import build_session  # noqa: E402

HEADLINE = [
    "maintenance_priority", "fleet_kpis", "weekly_trends", "daily_moving_average", "recommendations", "fleet_summary",
    "daily_predictions", "left_join_predictions", "rolling_mean_7", "pct_change_7", "violations_7", "ffill_bfill",
    "feature_table_all", "next_fault_asof", "target_horizon", "ordered_split", "null_profile", "duplicate_count",
    "iqr_outlier_profile", "numeric_profile", "cap_outliers", "clean_readings", "class_metrics", "roc_auc", "roc_curve",
    "calibration_bins", "scoring_features", "recommended_action", "batch_score",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = all_queries(), {}
    for name in os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split():
        taken = []
        for _ in range(runs + 1):  # the first run warms up
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(json.dumps({"metric": "total_seconds_headline_queries", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "event_rows": rows,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()

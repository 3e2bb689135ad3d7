"""Headline timings: every result row is computed, none is collected.

Prints one JSON line.  BENCH_SF_DIR names the table folder, BENCH_CPUS the threads,
BENCH_QUERIES optionally a comma-separated choice of registered queries.
"""

from __future__ import annotations

import json
import os
import time

from checks.catalogue import REGISTRY
from featuremart.session import build_session, ensure_shared_folder

RUNS = 2  # the first run also compiles the generated code; the better one counts

HEADLINES = [
    "silver_loans", "silver_attributes", "silver_financials", "label_store", "gold_attributes",
    "gold_financials", "bad_rate_curve", "pit_mean_features", "as_of_latest", "point_in_time_join",
    "pretrain_features", "training_table", "latest_per_key", "stratified_split", "stratified_folds",
    "null_profile", "describe_numbers", "histogram", "duplicate_keys", "value_counts",
    "impute_median", "standard_scale", "multi_hot", "roc_auc_by_month", "ks_statistic", "psi",
    "monthly_drift", "evaluate_splits", "monitor", "month_coverage", "write_snapshot",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINES
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
        },
    )
    ensure_shared_folder(spark)
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start-up
    seconds: dict[str, float] = {}
    for name in chosen:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            REGISTRY.queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    print(json.dumps({
        "metric": "total_wall_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()

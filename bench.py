"""Times the headline queries on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from contactflow.plans.queries import REGISTRY
from contactflow.session import local_session

HEADLINE = [
    "a09_customers_by_commune",
    "s09_insert_ignore_phones",
    "w01_latest_pending",
    "t01_fifo_batch",
    "t03_priority_batch",
    "m03_apply_results",
    "m09_replace_addresses",
    "w03_contact_slots",
    "s06_customer_export_sink",
    "a01_day_status_message",
    "a03_import_statistics",
    "a05_summary_with_total",
    "u01_provenance_union",
    "v07_staging_rows",
    "j05_client_contacts",
    "r04_daily_rollup",
]
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus=cpus, partitions=cpus)
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

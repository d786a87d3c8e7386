"""Time the headline queries: one warm-up, then the median of three runs, rows written nowhere.

Prints one JSON line. BENCH_SF_DIR names the data, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from quaylake import registry
from quaylake.session import local_session

HEADLINE = (
    "console_status", "console_status_value", "console_top_suppliers", "dashboard_top_suppliers",
    "dashboard_daily", "dashboard_summary", "top_suppliers_by_sales", "range_rows", "range_totals",
    "range_slice", "slice_unmatched", "profile_nulls", "profile_distinct", "describe_lineitem",
    "distinct_rows", "listing_objects", "listing_mentions", "strict_casts", "tolerant_numbers",
    "silver_supervisors", "silver_invoices", "page_sequence", "bronze_vehicles", "bronze_vehicle_daily",
    "bronze_notifications", "bronze_maintenance_reminders", "newest_snapshots", "sales_summary",
)
RUNS = 3


def seconds(run, spark, folder: str) -> float:
    start = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores) if cores.isdigit() else 8)
    runs = registry.queries()
    times = {}
    for name in HEADLINE:
        seconds(runs[name], spark, folder)
        times[name] = round(statistics.median(seconds(runs[name], spark, folder) for _ in range(RUNS)), 3)
    scale = os.path.basename(folder).removeprefix("sf")
    result = {
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()

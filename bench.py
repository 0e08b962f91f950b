"""Time the headline queries; prints one JSON line.

Each query is run into a no-op sink, which computes every row and column
without collecting them. The first run warms code generation; the reported
time is the median of the following ones.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

from ordermill import catalog
from ordermill.session import build_session

HEADLINE = [
    "q1_monthly_revenue", "q2_mom_growth", "q3_top3_category_state",
    "q4_running_total_seller", "q5_delivery_by_state", "q6_repeat_rate",
    "q7_cohort_retention", "q8_no_payment", "q9_dedup", "q10_city_filter",
    "wh_q1", "wh_q3", "wh_q5", "wh_star_adhoc", "biz_q1_category", "biz_q2_state",
    "biz_q3_trend", "biz_q4_late_state", "biz_q5_late_sellers",
    "mart_revenue_daily", "mart_delivery_performance", "mart_customer_cohorts",
    "serve_q1_category", "serve_q2_state", "serve_q3_trend", "serve_q4_late_state",
    "serve_q5_sellers", "serve_q5_cohorts", "serve_q5_overall",
    "stage_customers", "stage_orders", "stage_items", "dedup_latest", "scd2_merge",
    "surrogate_keys", "build_fact", "dim_geography", "extract_children",
    "dq_staging_phase", "dq_warehouse_phase", "dq_key_fk", "partitioned_sink",
    "parquet_scan_pruned", "csv_scan",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", cores, shuffle_partitions=cores,
                          spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"))
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        laps = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            laps.append(time.perf_counter() - start)
        times[name] = round(statistics.median(laps[1:]), 4)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
        "cores": cores, "runs": runs}))


if __name__ == "__main__":
    main()

"""Time the queries on one machine; prints one line of JSON.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the median
counts.  Results are computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from kontor.session import local_session
from workload import queries

HEADLINE = [
    "sales_by_quarter_region", "sales_pivot_region", "sales_by_month", "sales_by_channel",
    "channel_share", "top10_promotions", "store_sales_month", "top5_store_quarters",
    "dim_product", "dim_employee", "dim_customer", "dim_reseller",
    "fact_internet_sales", "fact_reseller_sales", "fact_sales_reason", "fact_survey_response",
    "fact_sales_quota", "datamart_dim_product", "insert_only_new", "line_numbers",
    "line_numbers_large_groups", "surrogate_keys", "pk_violations", "fk_orphans",
    "translate_with_fallback",
]


def seconds(name: str, spark, folder: str) -> float:
    start = time.perf_counter()
    queries.run(name, spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    partitions = 2 * int(cores) if cores.isdigit() else 16
    spark = local_session(cores, partitions, os.environ.get("BENCH_MEMORY", "8g"))
    times = {}
    for name in names:
        seconds(name, spark, folder)
        times[name] = round(statistics.median(seconds(name, spark, folder) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "median seconds per query, summed",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Headline queries, warm, median of three, noop sink. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.queries import REGISTRY
from storecast.session import build_session

HEADLINE = [
    "best_sellers",
    "category_performance",
    "revenue_trends",
    "trend_analysis",
    "low_stock_risk",
    "region_performance",
    "top_customers",
    "full_report",
    "profile_orders",
    "profile_order_items",
    "validate_cleaned",
    "clean_orders",
    "clean_order_items",
    "fk_quarantine",
    "daily_sales",
    "complete_grid",
    "build_features",
    "forecast_7d_rolling",
    "inventory_report",
    "proportional_allocation",
    "assemble_baskets",
    "exact_sample",
    "load_retail",
    "linear_regression",
    "random_forest",
]
RUNS = 3


def seconds(spark, name: str, folder: str) -> float:
    # Frames kept by an earlier run must not answer this one.
    spark.catalog.clearCache()
    started = time.perf_counter()
    REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds(spark, name, folder)
        timed[name] = round(statistics.median(seconds(spark, name, folder) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": folder.rsplit("sf", 1)[-1].strip("/"),
            }
        )
    )


if __name__ == "__main__":
    main()

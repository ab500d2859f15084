"""Time the headline queries (or those named): one warm-up, then the median of three runs.

Every run builds the query and writes its whole result to a noop sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from starmart.bindings.catalog import QUERIES
from starmart.session import build_session

HEADLINE = (
    "silver_orders",
    "silver_order_items",
    "silver_payments",
    "silver_reviews",
    "silver_customers",
    "silver_sellers",
    "silver_products",
    "silver_geolocation",
    "silver_category",
    "dim_customer",
    "dim_product",
    "dim_seller",
    "dim_date",
    "dim_location",
    "clean_exact_distinct",
    "agg_payments_by_order",
    "agg_monthly_revenue",
    "join_items_orders",
    "join_payments",
    "join_dim_product",
    "inc_hwm_filter",
    "inc_new_hwm",
    "dq_report",
    "dq_report_all",
    "sink_partitioned_append",
    "fact_sales",
)


def seconds(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "starmart-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": os.environ.get("BENCH_SHARED_DIR", "/tmp/starmart-bench"),
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        seconds(spark, folder, name)
        times[name] = round(statistics.median(seconds(spark, folder, name) for _ in range(3)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()

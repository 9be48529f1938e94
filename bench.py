"""Times headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

Every query runs once cold and three times warm (median reported); results are fully computed and
thrown away by the no-op sink. ``value`` is the sum of the warm medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from dispatchlake.plans.catalog import QUERIES

HEADLINE = [
    "silver_orders",
    "order_items",
    "orders_items_left_join",
    "event_order_lookup",
    "gold_fulfillment",
    "gold_delivery_time",
    "gold_order_volume",
    "gold_order_volume_fanout",
    "gold_eta_accuracy",
    "gold_daily_metrics",
    "hourly_distribution",
    "top_days",
    "courier_timeline",
    "courier_current_state",
    "order_current_state",
    "ops_orders_upsert",
    "ops_courier_upsert",
    "merge_orders",
    "merge_order_items",
    "merge_orders_stored",
    "dedup_events",
    "infer_message_schema",
    "stream_upsert_state",
    "stream_daily_counts",
    "dq_domains",
    "dq_gate_report",
]
WARM_RUNS = 3


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}
    for name in names:
        cold[name] = round(run(spark, name, sf_dir), 3)
        warm[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(WARM_RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "sum of warm query times (median of three)",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": sf_dir.rsplit("/sf", 1)[-1],
                "cpus": cpus,
                "driver_memory": spark.conf.get("spark.driver.memory"),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

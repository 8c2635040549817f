"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the local cores, BENCH_QUERIES (comma-separated) a subset.
Every query runs over its whole tables; all result rows are produced and dropped at the sink.
"""

from __future__ import annotations

import json
import os
import time

from orelode.plans.session import build_session
from orelode.registry.queries import all_queries

HEADLINE = (
    "dq_orders", "silver_order_items_typed", "dedup_shipments", "silver_merge_orders",
    "silver_merge_order_items", "silver_merge_products", "scd2_products", "scd2_customers",
    "pit_lookup", "fact_orders", "fact_sales", "fact_shipments", "fact_payments",
    "kpi_revenue_by_month", "change_feed_net", "stream_silver_orders", "medallion_end_to_end",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "orelode-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    queries = all_queries()
    # Start the JVM's compilers on a query that is not timed.
    queries["dq_products"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        begun = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begun, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from tillstream.registry import QUERIES
from tillstream.session import local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
HEADLINE = ["daily_revenue", "product_performance", "fact_orders", "top_products_20", "cohort_retention_true",
            "aov_by_segment", "revenue_by_day", "user_segments", "merge_orders", "brand_performance", "rank_over_time",
            "funnel", "conversion_funnel", "abandoned_carts", "page_flow", "search_performance", "payment_analytics",
            "kpi_summary", "dq_summary", "batch_summary"]


def run(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, memory="20g")
    run(spark, "orders_by_status")  # start-up
    names = sys.argv[1:] or HEADLINE
    seconds = {n: round(run(spark, n), 3) for n in names}
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()

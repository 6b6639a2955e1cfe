"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. Every query
is run twice into a sink that drops its rows; the faster run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartflow.registry.queries import QUERIES  # noqa: E402
from cartflow.settings import local_session  # noqa: E402

HEADLINE = (
    "orders_enriched",
    "product_revenue",
    "seller_performance",
    "seller_performance_order_grain",
    "monthly_order_volume",
    "order_status_distribution",
    "top_categories",
    "avg_delivery_by_state",
    "delay_rate_by_state",
    "delay_rate_overall",
    "review_score_distribution",
    "top_sellers",
    "run_history",
    "chart_monthly_orders",
    "chart_revenue_by_category",
    "chart_delivery_days_by_state",
    "chart_delay_rate_by_state",
    "dedup_first_by_key",
    "csv_load_order_items",
    "csv_load_multiline_text",
    "upsert_orders_enriched",
    "upsert_product_revenue",
    "upsert_seller_performance",
    "order_documents",
    "doc_sink_orders",
    "mark_synced",
    "run_state",
    "full_chain",
)
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cores, partitions=int(cores) if cores.isdigit() else 8, memory="16g")
    times: dict[str, float] = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
    line = {
        "metric": "total_headline_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()

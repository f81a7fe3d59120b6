"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's result is fully computed into Spark's ``noop`` sink (no driver
collect).  One untimed warm-up pass, then ``$BENCH_REPEATS`` timed runs per
query (default 3); the per-query value is the median.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clv", "customer360", "process_customers_valid", "dim_customers", "rfm_scores", "campaign_performance",
    "order_sequences", "order_anomalies", "product_performance", "inventory_turnover", "stockout_risk",
    "price_elasticity", "optimal_price", "nearest_store", "forecast_sales", "ab_test", "pair_rules",
    "dq_summary", "transform_chain", "t_window_frame", "merge_upsert", "change_feed", "asof_version",
    "clickstream_append",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from tillpoint.catalog.registry import QUERIES, load_all
    from tillpoint.session import local_session

    load_all()
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    names = only or HEADLINE

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:          # warm-up: JIT, file listing caches, Python workers
        run(name)
    per_query = {}
    for name in names:
        per_query[name] = round(statistics.median(run(name) for _ in range(repeats)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(per_query.values()), 3), "unit": "sec",
        "queries": per_query, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus, "repeats": repeats, "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

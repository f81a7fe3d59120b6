"""Hot-key demonstration for per-customer order sequences.

Derives a skewed copy of the orders view in which one customer owns every
third order, then reports the largest number of rows a single window task
receives with the plain window (partition by customer) and with the split
window (``sequence_within_groups``), and checks both give the same numbers.

Usage: python tools/skew_demo.py [--sf DIR]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    a = ap.parse_args()

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from tillpoint.operators import orders as O
    from tillpoint.session import local_session
    from tillpoint.sources import fixtures as fx

    # no coalescing, so task sizes show the partitioning itself
    spark = local_session(8, shuffle_partitions=16,
                          extra={"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    orders = fx.orders(spark, a.sf)
    skewed = orders.withColumn("customer_id", F.when(F.col("order_id") % 3 == 0, F.lit(0))
                               .otherwise(F.col("customer_id")))
    total = skewed.count()

    # rows per task of the plain window stage: the window runs in the partition
    # its customer hashes to
    w = Window.partitionBy("customer_id").orderBy("order_date", "order_id")
    plain = skewed.withColumn("rn", F.row_number().over(w)).withColumn("_task", F.spark_partition_id())
    # (rn is aggregated too, so the window cannot be pruned away)
    per_task = plain.groupBy("_task").agg(F.count(F.lit(1)).alias("n"), F.max("rn").alias("m")).collect()
    plain_max = max(r.n for r in per_task)          # one row per task

    # rows per range partition of the split layout
    ranged = skewed.repartitionByRange(16, "customer_id", "order_date", "order_id") \
        .withColumn("_task", F.spark_partition_id())
    split_max = max(r["count"] for r in ranged.groupBy("_task").count().collect())

    a_ = O.order_sequences(skewed, skew_safe=True).select("order_id", F.col("order_sequence").alias("a"))
    b_ = O.order_sequences(skewed, skew_safe=False).select("order_id", F.col("order_sequence").alias("b"))
    diff = a_.join(b_, "order_id").filter(F.col("a") != F.col("b")).count()
    print(f"rows={total} hot_customer_rows={total // 3} plain_window_max_task_rows={plain_max} "
          f"split_max_task_rows={split_max} mismatches={diff}")
    return 0 if diff == 0 else 1


if __name__ == "__main__":
    raise SystemExit(main())

"""Grouped aggregates shared by several operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mode_by_count(df: DataFrame, key: str, value: str, out: str = "mode", count_out: str | None = None) -> DataFrame:
    """Most frequent ``value`` per ``key``; ties go to the smallest value.

    Two hash aggregates: (key, value) counts — combined map-side, so a hot
    key costs one partial row per distinct value and task — then ``max_by``
    over (count desc, value asc) per key.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_cnt"))
    # smallest (−count, value): highest count first, then the smallest value
    best = counts.groupBy(key).agg(
        F.min_by(F.struct(F.col(value).alias("v"), F.col("_cnt").alias("c")),
                 F.struct((-F.col("_cnt")).alias("nc"), F.col(value).alias("v"))).alias("_b"))
    cols = [key, F.col("_b.v").alias(out)]
    if count_out:
        cols.append(F.col("_b.c").alias(count_out))
    return best.select(*cols)


def order_baskets(df: DataFrame, order_col: str = "order_id", item_col: str = "product_id") -> DataFrame:
    """One sorted, duplicate-free item array per order (FP-Growth input)."""
    return df.groupBy(order_col).agg(F.array_sort(F.collect_set(item_col)).alias("items"))

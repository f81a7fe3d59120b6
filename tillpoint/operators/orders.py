"""Order operators: SLA timelines, per-customer sequences, 3-sigma anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.operators.sequencing import sequence_within_groups


def order_timelines(orders: DataFrame) -> DataFrame:
    """Processing hours (ship − order, second resolution) and SLA compliance.

    Not yet shipped (NULL) counts as not compliant.
    """
    hours = F.timestamp_diff("SECOND", F.col("order_date"), F.col("shipped_date")) / 3600.0
    return orders.withColumn("processing_time_hours", hours).withColumn(
        "sla_compliant",
        F.coalesce(F.col("processing_time_hours") <= F.col("promised_sla_hours"), F.lit(False)))


def order_sequences(orders: DataFrame, skew_safe: bool = True) -> DataFrame:
    """``order_sequence`` (1 = first order) and days since the previous order.

    Ordered by (order_date, order_id): same-day orders get a stable order.
    The default plan splits customers with very many orders over several
    tasks (``sequence_within_groups``); ``skew_safe=False`` gives the plain
    one-window plan.
    """
    if skew_safe:
        seq = sequence_within_groups(orders, ["customer_id"], ["order_date", "order_id"],
                                     rn_col="order_sequence", lags={"_prev_date": "order_date"})
        return seq.withColumn("days_since_last_order",
                              F.datediff(F.col("order_date"), F.col("_prev_date"))).drop("_prev_date")
    w = Window.partitionBy("customer_id").orderBy("order_date", "order_id")
    return orders.withColumns({
        "order_sequence": F.row_number().over(w).cast("long"),
        "days_since_last_order": F.datediff(F.col("order_date"), F.lag("order_date", 1).over(w)),
    })


def tag_anomalies(orders: DataFrame, k: float = 3.0, col: str = "total_amount") -> DataFrame:
    """``is_anomaly``: value above mean + k·(sample stddev).

    The threshold is a scalar subquery (one small aggregate job whose value
    is inlined), so there is no driver collect and no join; NULL values are
    normal.
    """
    threshold = orders.agg((F.avg(col) + F.lit(k) * F.stddev_samp(col)).alias("t")).scalar()
    return orders.withColumn("is_anomaly", F.coalesce(F.col(col) > threshold, F.lit(False)))


def detect_order_anomalies(orders: DataFrame, k: float = 3.0) -> tuple[DataFrame, DataFrame]:
    """(normal, anomalies) from one tagged plan."""
    tagged = tag_anomalies(orders, k)
    return (tagged.filter(~F.col("is_anomaly")).drop("is_anomaly"),
            tagged.filter("is_anomaly").drop("is_anomaly"))

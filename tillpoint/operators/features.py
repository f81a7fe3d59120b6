"""Feature engineering: calendar features and per-customer model inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.functions.stats import safe_div
from tillpoint.operators.customers import _lit_ts


def time_features(df: DataFrame, time_col: str) -> DataFrame:
    """Hour, day of week (1 = Sunday), weekend flag, month, quarter."""
    t = F.col(time_col)
    return df.withColumns({
        "hour_of_day": F.hour(t),
        "day_of_week": F.dayofweek(t),
        "is_weekend": F.dayofweek(t).isin(1, 7),
        "month": F.month(t),
        "quarter": F.quarter(t),
    })


def customer_order_features(customers: DataFrame, orders: DataFrame, as_of, churn_days: int = 365) -> DataFrame:
    """Per customer: order count, spend, average order, tenure, recency,
    account balance and ``is_churned`` (no order for ``churn_days``).  A
    customer without orders has zero counts, sums and tenure, no recency, and
    is churned.  Orders are aggregated before the join."""
    stats = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("total_amount").alias("total_spend"),
        F.avg("total_amount").alias("avg_order_value"),
        F.datediff(F.max("order_date"), F.min("order_date")).alias("tenure_days"),
        F.datediff(_lit_ts(as_of), F.max("order_date")).alias("days_since_last_order"),
    )
    out = customers.select("customer_id", "account_balance", "market_segment", "loyalty_tier").join(
        stats, "customer_id", "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("order_count", "total_spend", "avg_order_value", "tenure_days")}
    return out.withColumns(zero).withColumn(
        "is_churned", F.coalesce(F.col("days_since_last_order") > churn_days, F.lit(True)))


def standardize(df: DataFrame, cols, suffix: str = "_z") -> DataFrame:
    """(x − mean) / sample stddev for each column, from one aggregate pass
    (a scalar subquery of means and deviations, no join); NULL for a
    constant column."""
    stats = df.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(c)
                              for c in cols]).alias("st")).scalar()
    st = F.col("_st")                                  # one subquery, referenced by column
    return df.withColumn("_st", stats).withColumns(
        {f"{c}{suffix}": safe_div(F.col(c) - st[c]["m"], st[c]["s"]) for c in cols}).drop("_st")

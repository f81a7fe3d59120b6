"""Inventory operators: reorder points and stock-out risk buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.functions.stats import normal_cdf


def reorder_points(inventory: DataFrame, forecast: DataFrame, safety: float = 1.2) -> DataFrame:
    """ceil(forecast · safety).  Forecast rows are averaged to one per product
    first, so a per-sale prediction table cannot fan the join out."""
    per_product = forecast.groupBy("product_id").agg(F.avg("prediction").alias("forecasted_demand"))
    return inventory.join(per_product, "product_id").withColumn(
        "reorder_point", F.ceil(F.col("forecasted_demand") * F.lit(safety)))


def stockout_risk(inventory: DataFrame, sales: DataFrame) -> DataFrame:
    """P(demand > stock) under a normal demand model fitted per product:
    1 − Φ((stock − mean)/sd).  Products with a missing or zero sd get NULL
    (and fall in no bucket)."""
    stats = sales.groupBy("product_id").agg(
        F.avg("quantity").alias("avg_daily_sales"),
        F.stddev_samp("quantity").alias("sales_stddev"),
    )
    return inventory.join(stats, "product_id").withColumn(
        "stockout_probability",
        F.lit(1.0) - normal_cdf(F.col("current_stock"), F.col("avg_daily_sales"), F.col("sales_stddev")))


def risk_bucket(p) -> F.Column:
    return (F.when(p > 0.7, "critical").when(p > 0.3, "warning").when(p <= 0.3, "safe"))


def simulate_stockouts(inventory: DataFrame, sales: DataFrame) -> dict[str, DataFrame]:
    risk = stockout_risk(inventory, sales).withColumn("risk_bucket", risk_bucket(F.col("stockout_probability")))
    return {b: risk.filter(F.col("risk_bucket") == b) for b in ("critical", "warning", "safe")}

"""Pricing operators: price elasticity per product and optimal price."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.functions.stats import safe_div


def price_elasticity(sales: DataFrame, product_col: str = "product_id",
                     price_col: str = "price", qty_col: str = "quantity_sold") -> DataFrame:
    """Point elasticity at the means from a per-product least-squares line
    q = a + b·p (the Gaussian/identity GLM slope): e = b · mean(p) / mean(q).

    One grouped aggregate (``regr_slope`` merges partial states map-side), not
    one model fit per product.  Products whose prices never vary get NULL.
    """
    return sales.groupBy(product_col).agg(
        F.regr_slope(F.col(qty_col), F.col(price_col)).alias("slope"),
        F.avg(price_col).alias("avg_price"),
        F.avg(qty_col).alias("avg_quantity"),
        F.count(F.lit(1)).alias("n_obs"),
    ).withColumn("elasticity", safe_div(F.col("slope") * F.col("avg_price"), F.col("avg_quantity")))


def optimize_pricing(products: DataFrame, elasticity: DataFrame, margin_constraint: float = 0.3,
                     default_elasticity: float = -2.0) -> DataFrame:
    """cost/(1−m)·(1 + 1/e); e defaults to −2 for products without an
    estimate; products without cost keep their price; e = 0 gives NULL."""
    e = F.coalesce(F.col("_e"), F.lit(default_elasticity))
    joined = products.join(elasticity.select("product_id", F.col("elasticity").alias("_e")), "product_id", "left")
    optimal = F.when(
        F.col("cost").isNotNull(),
        F.col("cost") / F.lit(1.0 - margin_constraint) * (F.lit(1.0) + safe_div(F.lit(1.0), e)),
    ).otherwise(F.col("price"))
    return joined.withColumn("optimal_price", optimal).drop("_e")

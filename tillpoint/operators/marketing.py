"""Marketing operators: RFM scores and campaign ROI."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.functions.stats import safe_div
from tillpoint.operators.customers import _lit_ts
from tillpoint.operators.ranking import global_ntile


def rfm_base(customers: DataFrame, orders: DataFrame, as_of) -> DataFrame:
    """Per known customer: recency (days), frequency, monetary."""
    per_customer = orders.groupBy("customer_id").agg(
        F.datediff(_lit_ts(as_of), F.max("order_date")).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"),
        F.round(F.sum("total_amount"), 6).alias("monetary"),
    )
    # one row per customer meets the customers, not one per order
    return per_customer.join(customers.select("customer_id"), "customer_id", "left_semi")


def rfm_scores(customers: DataFrame, orders: DataFrame, as_of, buckets: int = 5) -> DataFrame:
    """Quintile scores (5 = best): R by recency (recent is better), F by order
    count, M by spend; ties broken by ``customer_id``.  ``rfm = R*100+F*10+M``.

    Each score is an exact ntile computed by a range-partitioned global rank
    (no single-partition window).
    """
    base = rfm_base(customers, orders, as_of)
    base = global_ntile(base, [F.col("recency_days").desc(), F.col("customer_id").asc()], buckets, "r_score")
    base = global_ntile(base, [F.col("frequency").asc(), F.col("customer_id").asc()], buckets, "f_score")
    base = global_ntile(base, [F.col("monetary").asc(), F.col("customer_id").asc()], buckets, "m_score")
    return base.withColumn("rfm_score", F.col("r_score") * 100 + F.col("f_score") * 10 + F.col("m_score"))


def rfm_scores_approx(customers: DataFrame, orders: DataFrame, as_of, buckets: int = 5,
                      accuracy: int = 10000) -> DataFrame:
    """Approximate quintiles from ``percentile_approx`` cut points.

    One aggregate job computes the cut points (a tiny array per measure);
    scoring is then a map-only projection.  Scores may differ from the exact
    ntile near cut points and on ties.
    """
    base = rfm_base(customers, orders, as_of)
    probs = [i / buckets for i in range(1, buckets)]
    # one scalar subquery holding all cut points (a few numbers; no join)
    cut_points = base.agg(F.struct(
        F.percentile_approx("recency_days", probs, accuracy).alias("r"),
        F.percentile_approx("frequency", probs, accuracy).alias("f"),
        F.percentile_approx("monetary", probs, accuracy).alias("m"),
    ).alias("cuts")).scalar()
    base = base.withColumn("_cuts", cut_points)      # one subquery, referenced below by column
    cuts = F.col("_cuts")

    def score(value: str, cut: str, higher_is_better: bool) -> F.Column:
        # number of cut points below the value (element access, no lambda:
        # subqueries are not allowed inside higher-order functions)
        if higher_is_better:
            below = [F.when(F.col(value) > cuts[cut][i], 1).otherwise(0) for i in range(buckets - 1)]
            return sum(below[1:], below[0]) + 1
        at_or_below = [F.when(F.col(value) >= cuts[cut][i], 1).otherwise(0) for i in range(buckets - 1)]
        return F.lit(buckets) - sum(at_or_below[1:], at_or_below[0])
    out = base.withColumns({
        "r_score": score("recency_days", "r", False).cast("int"),
        "f_score": score("frequency", "f", True).cast("int"),
        "m_score": score("monetary", "m", True).cast("int"),
    }).drop("_cuts")
    return out.withColumn("rfm_score", F.col("r_score") * 100 + F.col("f_score") * 10 + F.col("m_score"))


def campaign_performance(campaigns: DataFrame, orders: DataFrame) -> DataFrame:
    """Revenue and converted customers per campaign; ROI in % and cost per
    acquisition.  Campaigns without orders keep NULL metrics; a zero cost or
    zero conversions gives NULL instead of an error."""
    per_campaign = orders.groupBy("campaign_id").agg(
        F.round(F.sum("total_amount"), 6).alias("revenue"),
        F.countDistinct("customer_id").alias("conversions"),
    )
    out = campaigns.join(per_campaign, "campaign_id", "left")
    return out.withColumns({
        "roi": safe_div(F.col("revenue") - F.col("cost"), F.col("cost")) * 100,
        "cpa": safe_div(F.col("cost"), F.col("conversions")),
    })

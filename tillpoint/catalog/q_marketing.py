"""Marketing, geospatial and experiment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillpoint.catalog.common import round_cols
from tillpoint.catalog.fixture_sql import AS_OF as SQL_AS_OF, with_inputs
from tillpoint.catalog.registry import register
from tillpoint.operators import experiments as X
from tillpoint.operators import geo as G
from tillpoint.operators import marketing as M
from tillpoint.operators import sketches as K
from tillpoint.operators.sequencing import split_window
from tillpoint.session import cut_lineage, scratch_path
from tillpoint.sources import fixtures as fx

_RFM_BASE = f"""
select o.customer_id, cast(date_diff('day', max(o.order_date), {SQL_AS_OF}) as integer) as recency_days,
       count(*) as frequency, round(sum(o.total_amount), 6) as monetary
from f_orders o join f_customers c using (customer_id)
group by o.customer_id"""


@register("rfm_scores", with_inputs(["f_orders", "f_customers"], """
select *, r_score * 100 + f_score * 10 + m_score as rfm_score from (
  select *, cast(ntile(5) over (order by recency_days desc, customer_id) as integer) as r_score,
            cast(ntile(5) over (order by frequency, customer_id) as integer) as f_score,
            cast(ntile(5) over (order by monetary, customer_id) as integer) as m_score
  from b)""", ctes=[("b", _RFM_BASE)]))
def q_rfm_scores(spark, sf):
    return M.rfm_scores(fx.customers(spark, sf), fx.orders(spark, sf), fx.AS_OF)


@register("rfm_scores_sketch", with_inputs(["f_orders", "f_customers"], """
select customer_id, cast(date_diff('day', cast(max(order_date) as date), cast(TIMESTAMP '2002-01-01 00:00:00' as date)) as integer) as recency_days,
       count(*) as frequency, round(sum(total_amount), 6) as monetary, true as scores_within_error
from f_orders where customer_id in (select customer_id from f_customers) group by customer_id"""))
def q_rfm_scores_sketch(spark, sf):
    """Scores from stored daily sketches.  Beside each customer's measures stands whether the scores lie where the exact
    ranks allow, given the sketches' rank error (the cut that a score claims may be off by that much)."""
    orders = fx.orders(spark, sf)
    days = orders.groupBy("customer_id").agg(F.to_date(F.max("order_date")).alias("day"))
    base = cut_lineage(M.rfm_base(fx.customers(spark, sf), orders, fx.AS_OF).join(days, "customer_id"))
    path = scratch_path(spark, "rfm-days")
    K.daily_sketches(base, "day").write.parquet(path)
    scored = K.rfm_scores_sketch(base.drop("day"), spark.read.parquet(path))
    total = base.count()
    for measure, score, descending in (("recency_days", "r_score", True), ("frequency", "f_score", False), ("monetary", "m_score", False)):
        # per value: the share of customers before it and up to it, in the order of the score
        sizes = base.groupBy(F.col(measure).alias("v")).agg(F.count("*").alias("n"))
        by = F.col("v").desc() if descending else F.col("v").asc()
        upto = split_window(sizes.withColumn("one", F.lit(1)), ["one"], [by], [("running_sum", "upto", "n")]).select(
            F.col("v").alias(f"v_{score}"), ((F.col("upto") - F.col("n")) / total).alias(f"lo_{score}"), (F.col("upto") / total).alias(f"hi_{score}"))
        scored = scored.join(upto, F.col(measure) == F.col(f"v_{score}"))
    slack = 2 * K.RANK_ERROR
    fits = [(F.col(f"hi_{s}") >= (F.col(s) - 1) / 5 - slack) & (F.col(f"lo_{s}") <= F.col(s) / 5 + slack) for s in ("r_score", "f_score", "m_score")]
    return scored.select("customer_id", "recency_days", "frequency", "monetary", (fits[0] & fits[1] & fits[2]).alias("scores_within_error"))


@register("rfm_scores_approx")
def q_rfm_scores_approx(spark, sf):
    return M.rfm_scores_approx(fx.customers(spark, sf), fx.orders(spark, sf), fx.AS_OF)


@register("campaign_performance", with_inputs(["f_campaigns", "f_orders"], """
select c.*, o.revenue, o.conversions,
       (o.revenue - c.cost) / nullif(c.cost, 0) * 100 as roi,
       c.cost / nullif(o.conversions, 0) as cpa
from f_campaigns c
left join (select campaign_id, round(sum(total_amount), 6) as revenue,
                  count(distinct customer_id) as conversions
           from f_orders group by campaign_id) o using (campaign_id)"""))
def q_campaign_performance(spark, sf):
    return M.campaign_performance(fx.campaigns(spark, sf), fx.orders(spark, sf))


# --------------------------------------------------------------------------- geo
_NEAREST = with_inputs(["f_customer_geo", "f_stores"], """
select customer_id, store_id as nearest_store_id, round(d, 6) as nearest_store_distance from (
  select customer_id, store_id, d,
         row_number() over (partition by customer_id order by d, store_id) as rn
  from (select c.customer_id, s.store_id,
               2 * 6371.009 * asin(sqrt(least(1.0,
                   pow(sin((radians(s.store_lat) - radians(c.customer_lat)) / 2), 2)
                   + cos(radians(c.customer_lat)) * cos(radians(s.store_lat))
                     * pow(sin((radians(s.store_lon) - radians(c.customer_lon)) / 2), 2)))) as d
        from f_customer_geo c, f_stores s))
where rn = 1""")


@register("nearest_store", _NEAREST)
def q_nearest_store(spark, sf):
    out = G.nearest_store(fx.customer_geo(spark, sf), fx.stores(spark, sf))
    return round_cols(out, ["nearest_store_distance"])


@register("nearest_store_grid", _NEAREST)
def q_nearest_store_grid(spark, sf):
    """Same answer from a deep index (leaves of at most two stores)."""
    out = G.nearest_store(fx.customer_geo(spark, sf), fx.stores(spark, sf), leaf_capacity=2)
    return round_cols(out, ["nearest_store_distance"])


# --------------------------------------------------------------------------- experiments
@register("ab_contingency", with_inputs(["f_experiment"], """
select variant, cast(count_if(coalesce(converted, false)) as bigint) as success, count(*) as total,
       count_if(coalesce(converted, false)) / count(*) as conversion_rate
from f_experiment group by variant"""))
def q_ab_contingency(spark, sf):
    return X.contingency(fx.experiment(spark, sf))


def _chi_sql(fixture: str) -> str:
    return with_inputs([fixture], f"""
select round(chi_square, 6) as chi_square, dof, n_variants, round(p, 6) as p_value, p < 0.05 as is_significant
from (select *, case when dof % 2 = 0
        then exp(-h) * (select sum(pow(h, i) / factorial(cast(i as integer))) from range(0, dof // 2) r(i))
        else 1 - 2 / sqrt(pi()) * exp(-h) * sqrt(h) * (select sum(pow(4 * h, n) * gamma(n + 1) / gamma(2 * n + 2)) from range(0, 80) r(n))
             + exp(-h) * coalesce((select sum(pow(h, i - 0.5) / gamma(i + 0.5))
                                   from range(1, (dof - 1) // 2 + 1) r(i)), 0)
        end as p
      from hh) z""", ctes=[
        ("ct", f"""select variant, count_if(coalesce(converted, false)) as success, count(*) as total
                   from {fixture} group by variant"""),
        ("cells", """select variant, total as row_total, 'success' as outcome, success as observed from ct
                     union all
                     select variant, total, 'failure', total - success from ct"""),
        ("tot", """select *, sum(observed) over () as n, sum(observed) over (partition by outcome) as col_total,
                          cast(count(*) over () / 2 as integer) as n_variants from cells"""),
        ("e", "select *, row_total * col_total / n as expected, n_variants - 1 as dof from tot"),
        ("stat", """select sum(pow(abs(observed - expected)
                               - case when dof = 1 then least(0.5, abs(observed - expected)) else 0 end, 2)
                           / expected) as chi_square,
                       max(dof) as dof, max(n_variants) as n_variants from e"""),
        ("hh", "select *, chi_square / 2 as h from stat"),
    ])


def _ab(spark, sf, arms):
    out = X.chi_square_test(fx.experiment(spark, sf, arms))
    return out.select(F.round("chi_square", 6).alias("chi_square"), "dof", "n_variants",
                      F.round("p_value", 6).alias("p_value"), "is_significant")


@register("ab_test", _chi_sql("f_experiment"))
def q_ab_test(spark, sf):
    return _ab(spark, sf, 2)


@register("ab_test_3arm", _chi_sql("f_experiment3"))
def q_ab_test_3arm(spark, sf):
    return _ab(spark, sf, 3)

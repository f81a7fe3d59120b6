"""Product, pricing and inventory queries."""

from __future__ import annotations

from tillpoint.catalog.common import exact_means, round_cols
from tillpoint.catalog.fixture_sql import with_inputs
from tillpoint.catalog.registry import register
from tillpoint.operators import inventory as I
from tillpoint.operators import pricing as PR
from tillpoint.operators import products as P
from tillpoint.sources import fixtures as fx

# The pricing rules applied by the dynamic_pricing query.
PRICING_RULES = [
    {"condition": "category_id > 40", "multiplier": 1.1},
    {"condition": "price > 1500", "multiplier": 0.9},
    {"condition": "not in_stock", "multiplier": 0.8},
]


@register("product_catalog_summary", with_inputs(["f_products", "f_categories"], """
select p.category_id, c.category_name, count(*) as product_count,
       round(sum(p.price), 6) / count(p.price) as avg_price,
       cast(count_if(p.in_stock) as bigint) as in_stock_count
from f_products p left join f_categories c using (category_id)
group by p.category_id, c.category_name"""))
def q_catalog_summary(spark, sf):
    out = P.catalog_summary(fx.products(spark, sf), fx.categories(spark, sf))
    return exact_means(out, {"avg_price": "product_count"})


@register("product_hierarchy", with_inputs(["f_products", "f_categories"], """
select *, concat_ws(' > ', category_level1, category_level2, category_level3) as full_category_path
from f_products left join f_categories using (category_id)"""))
def q_product_hierarchy(spark, sf):
    return P.product_hierarchy(fx.products(spark, sf), fx.categories(spark, sf))


@register("inventory_turnover", with_inputs(["f_inventory", "f_sales"], """
select i.*, s.total_sold, s.order_count,
       case when i.current_stock > 0 then s.total_sold / i.current_stock else 0.0::double end as turnover_ratio
from f_inventory i
left join (select product_id, sum(quantity) as total_sold, count(distinct order_id) as order_count
           from f_sales group by product_id) s using (product_id)"""))
def q_inventory_turnover(spark, sf):
    return P.inventory_turnover(fx.inventory(spark, sf), fx.sales(spark, sf))


@register("dynamic_pricing", with_inputs(["f_products"], """
select * exclude (p1, p2) replace (case when not in_stock then p2 * 0.8 else p2 end as price) from (
  select *, case when p1 > 1500 then p1 * 0.9 else p1 end as p2 from (
    select *, case when category_id > 40 then price * 1.1 else price end as p1 from f_products))"""))
def q_dynamic_pricing(spark, sf):
    return P.apply_dynamic_pricing(fx.products(spark, sf), PRICING_RULES)


@register("product_performance", with_inputs(["f_products", "f_sales"], """
select p.product_id, p.name, p.category, coalesce(s.units_sold, 0) as units_sold, coalesce(s.revenue, 0) as revenue,
       coalesce(s.order_count, 0) as order_count, s.revenue / nullif(s.units_sold, 0) as avg_unit_price,
       rank() over (partition by p.category order by coalesce(s.revenue, 0) desc, p.product_id) as revenue_rank
from f_products p
left join (select product_id, sum(quantity) as units_sold, round(sum(revenue), 2) as revenue,
             count(distinct order_id) as order_count
      from f_sales group by product_id) s using (product_id)"""))
def q_product_performance(spark, sf):
    return P.product_performance(fx.sales(spark, sf), fx.products(spark, sf))


# --------------------------------------------------------------------------- inventory
@register("reorder_points", with_inputs(["f_inventory", "f_demand_forecast"], """
select i.*, f.forecasted_demand, cast(ceil(f.forecasted_demand * 1.2) as bigint) as reorder_point
from f_inventory i
join (select product_id, avg(prediction) as forecasted_demand from f_demand_forecast group by product_id) f
  using (product_id)"""))
def q_reorder_points(spark, sf):
    return I.reorder_points(fx.inventory(spark, sf), fx.demand_forecast(spark, sf))


# Abramowitz-Stegun 7.1.26 coefficients (same as functions.stats).
_ERF = """(sign(z) * (1 - (((((1.061405429 * t - 1.453152027) * t + 1.421413741) * t - 0.284496736) * t
           + 0.254829592) * t) * exp(-z * z)))"""
_STOCKOUT = f"""
select product_id, current_stock, avg_daily_sales, round(sales_stddev, 6) as sales_stddev,
       round(case when sales_stddev > 0 then 1 - 0.5 * (1 + {_ERF}) end, 6) as stockout_probability
from (select *, 1.0 / (1.0 + 0.3275911 * abs(z)) as t from (
  select i.product_id, i.current_stock, s.avg_daily_sales, s.sales_stddev,
         (i.current_stock - s.avg_daily_sales) / (s.sales_stddev * sqrt(2.0)) as z
  from f_inventory i join (select product_id, avg(quantity) as avg_daily_sales,
                                  stddev_samp(quantity) as sales_stddev
                           from f_sales group by product_id) s using (product_id)))"""


def _stockout(spark, sf, bucket=None):
    risk = round_cols(I.stockout_risk(fx.inventory(spark, sf), fx.sales(spark, sf)),
                      ["sales_stddev", "stockout_probability"])
    if bucket is None:
        return risk
    p = risk["stockout_probability"]
    cond = {"critical": p > 0.7, "warning": (p > 0.3) & (p <= 0.7), "safe": p <= 0.3}[bucket]
    return risk.filter(cond)


@register("stockout_risk", with_inputs(["f_inventory", "f_sales"], "select * from r", ctes=[("r", _STOCKOUT)]))
def q_stockout_risk(spark, sf):
    return _stockout(spark, sf)


@register("stockout_critical", with_inputs(["f_inventory", "f_sales"],
                                           "select * from r where stockout_probability > 0.7",
                                           ctes=[("r", _STOCKOUT)]))
def q_stockout_critical(spark, sf):
    return _stockout(spark, sf, "critical")


@register("stockout_warning", with_inputs(["f_inventory", "f_sales"],
                                          "select * from r where stockout_probability > 0.3 and stockout_probability <= 0.7",
                                          ctes=[("r", _STOCKOUT)]))
def q_stockout_warning(spark, sf):
    return _stockout(spark, sf, "warning")


@register("stockout_safe", with_inputs(["f_inventory", "f_sales"],
                                       "select * from r where stockout_probability <= 0.3",
                                       ctes=[("r", _STOCKOUT)]))
def q_stockout_safe(spark, sf):
    return _stockout(spark, sf, "safe")


# --------------------------------------------------------------------------- pricing
_ELASTICITY = """
select product_id, regr_slope(quantity_sold, price) as slope, avg(price) as avg_price,
       avg(quantity_sold) as avg_quantity, count(*) as n_obs
from f_sales group by product_id"""


@register("price_elasticity", with_inputs(["f_sales"], """
select product_id, round(slope, 6) as slope, round(avg_price, 6) as avg_price, avg_quantity, n_obs,
       round(slope * avg_price / nullif(avg_quantity, 0), 6) as elasticity
from e""", ctes=[("e", _ELASTICITY)]))
def q_price_elasticity(spark, sf):
    return round_cols(PR.price_elasticity(fx.sales(spark, sf)), ["slope", "avg_price", "elasticity"])


@register("optimal_price", with_inputs(["f_products", "f_sales"], """
select p.*, round(case when p.cost is not null
                       then p.cost / (1 - 0.3) * (1 + 1.0 / nullif(coalesce(e.slope * e.avg_price
                                                   / nullif(e.avg_quantity, 0), -2.0), 0))
                       else p.price end, 6) as optimal_price
from f_products p left join e using (product_id)""", ctes=[("e", _ELASTICITY)]))
def q_optimal_price(spark, sf):
    e = PR.price_elasticity(fx.sales(spark, sf))
    return round_cols(PR.optimize_pricing(fx.products(spark, sf), e), ["optimal_price"])

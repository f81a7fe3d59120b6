"""End-to-end batch-job queries: run the retail job into a fresh folder
under the shared checkpoint directory and return one loaded table."""

from __future__ import annotations

from tillpoint.catalog.common import exact_means, round_cols
from tillpoint.catalog.fixture_sql import with_inputs
from tillpoint.catalog.q_models import _DIM_SCALARS, _FACTS, _SUMS, _TOP
from tillpoint.catalog.registry import register
from tillpoint.operators import customers as C
from tillpoint.plans.retail_job import run_retail_job
from tillpoint.session import scratch_path
from tillpoint.sources import fixtures as fx


def _run(spark, sf, **more):
    sources = {
        "customers": C.scalar_columns(fx.customers_raw(spark, sf)),
        "products": fx.products(spark, sf),
        "orders": fx.orders(spark, sf),
        "sales": fx.sales(spark, sf),
        **more,
    }
    out = scratch_path(spark, "retail_job")
    return run_retail_job(spark, sources, out, fx.AS_OF, orders_table="orders_" + out.rsplit("-", 1)[-1])


_VALID = ("valid", """
select * exclude (rn, loyalty_tier, is_valid), coalesce(loyalty_tier, 'standard') as loyalty_tier,
       concat_ws(' ', first_name, last_name) as full_name
from (select *, row_number() over (partition by customer_id order by updated_at desc) as rn,
             coalesce(customer_id is not null
                      and regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$')
                      and registration_date <= TIMESTAMP '2002-01-01 00:00:00', false) as is_valid
      from f_customers_raw where updated_at <= TIMESTAMP '2002-01-01 00:00:00')
where rn = 1 and is_valid""")
_CLV = ("clv", """
select v.*, s.total_spend, s.order_count, s.avg_order_value, s.customer_tenure_days,
       case when s.total_spend > 1000 then 'high' when s.total_spend > 500 then 'medium' else 'low' end
         as clv_segment,
       s.order_count / nullif(s.customer_tenure_days / 30.0, 0) as purchase_frequency
from valid v left join (
  select customer_id, round(sum(total_amount), 6) as total_spend, count(distinct order_id) as order_count,
         round(sum(total_amount), 6) / count(total_amount) as avg_order_value,
         cast(date_diff('day', min(order_date), max(order_date)) as integer) as customer_tenure_days
  from f_orders group by customer_id) s using (customer_id)""")


@register("retail_job_customers", with_inputs(["f_customers_raw", "f_orders"], """
select *, coalesce(days_since_last_activity between 0 and 30, false) as is_active,
          coalesce(days_since_last_activity between 31 and 90, false) as is_lapsing,
          coalesce(days_since_last_activity between 91 and 365, false) as is_churned,
          coalesce(days_since_last_activity >= 366, false) as is_inactive
from (select v.*, c.clv_segment as value_segment,
             cast(date_diff('day', v.last_activity, TIMESTAMP '2002-01-01 00:00:00') as integer)
               as days_since_last_activity
      from valid v left join clv c using (customer_id))""", ctes=[_VALID, _CLV]))
def q_retail_job_customers(spark, sf):
    return _run(spark, sf)["customers"]


@register("retail_job_clv", with_inputs(["f_customers_raw", "f_orders"], "select * from clv", ctes=[_VALID, _CLV]))
def q_retail_job_clv(spark, sf):
    out = _run(spark, sf)["customer_lifetime_value"]
    return exact_means(round_cols(out, ["total_spend"]), {"avg_order_value": "order_count"})


@register("retail_job_dim_customers", with_inputs(["f_customers_raw", "f_orders", "f_payments", "f_sessions"], _DIM_SCALARS, ctes=[_VALID, _FACTS, _TOP, _SUMS]))
def q_retail_job_dim_customers(spark, sf):
    """The job's last stage: the customer dimension over the customers that it loaded."""
    return _run(spark, sf, payments=fx.payments(spark, sf), sessions=fx.sessions(spark, sf))["dim_customers"]


@register("retail_job_products", with_inputs(["f_products", "f_sales"], """
select p.product_id, p.name, p.category, s.units_sold, s.revenue, s.order_count,
       s.revenue / nullif(s.units_sold, 0) as avg_unit_price,
       rank() over (partition by p.category order by s.revenue desc, p.product_id) as revenue_rank
from f_products p
join (select product_id, sum(quantity) as units_sold, round(sum(revenue), 2) as revenue,
             count(distinct order_id) as order_count
      from f_sales group by product_id) s using (product_id)"""))
def q_retail_job_products(spark, sf):
    return _run(spark, sf)["products"]


@register("retail_job_orders", with_inputs(["f_orders"], """
select *, date_diff('second', order_date, shipped_date) / 3600.0::double as processing_time_hours,
       coalesce(date_diff('second', order_date, shipped_date) / 3600.0::double <= promised_sla_hours, false)
         as sla_compliant,
       cast(year(order_date) as integer) as year, cast(month(order_date) as integer) as month
from f_orders"""))
def q_retail_job_orders(spark, sf):
    return _run(spark, sf)["orders"]

"""Order queries: timelines, sequences, anomalies, baskets, mode device."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillpoint.catalog.fixture_sql import with_inputs
from tillpoint.catalog.registry import register
from tillpoint.operators import orders as O
from tillpoint.operators.aggregates import mode_by_count, order_baskets
from tillpoint.sources import fixtures as fx


@register("order_timelines", with_inputs(["f_orders"], """
select *, date_diff('second', order_date, shipped_date) / 3600.0::double as processing_time_hours,
       coalesce(date_diff('second', order_date, shipped_date) / 3600.0::double <= promised_sla_hours, false)
         as sla_compliant
from f_orders"""))
def q_order_timelines(spark, sf):
    return O.order_timelines(fx.orders(spark, sf))


@register("order_sequences", with_inputs(["f_orders"], """
select *, row_number() over w as order_sequence,
       cast(date_diff('day', lag(order_date) over w, order_date) as integer) as days_since_last_order
from f_orders
window w as (partition by customer_id order by order_date, order_id)"""))
def q_order_sequences(spark, sf):
    return O.order_sequences(fx.orders(spark, sf))


_ANOMALY = """
select *, coalesce(total_amount > (select avg(total_amount) + 3 * stddev_samp(total_amount)
                                   from f_orders_outliers), false) as is_anomaly
from f_orders_outliers"""


@register("order_anomalies", with_inputs(["f_orders_outliers"], "select * exclude (is_anomaly) from t where is_anomaly",
                                         ctes=[("t", _ANOMALY)]))
def q_order_anomalies(spark, sf):
    return O.detect_order_anomalies(fx.orders_with_outliers(spark, sf))[1]


@register("order_normal", with_inputs(["f_orders_outliers"], "select * exclude (is_anomaly) from t where not is_anomaly",
                                      ctes=[("t", _ANOMALY)]))
def q_order_normal(spark, sf):
    return O.detect_order_anomalies(fx.orders_with_outliers(spark, sf))[0]


@register("order_baskets", with_inputs(["f_baskets"], """
select order_id, list_sort(list(distinct product_id)) as items, count(distinct product_id) as n_items
from f_baskets group by order_id"""))
def q_order_baskets(spark, sf):
    return order_baskets(fx.baskets(spark, sf)).withColumn("n_items", F.size("items").cast("long"))


@register("mode_device", with_inputs(["f_sessions"], """
select customer_id, device_type as most_common_device, cnt as device_count from (
  select customer_id, device_type, cnt,
         row_number() over (partition by customer_id order by cnt desc, device_type) as rn
  from (select customer_id, device_type, count(*) as cnt from f_sessions group by 1, 2))
where rn = 1"""))
def q_mode_device(spark, sf):
    return mode_by_count(fx.sessions(spark, sf), "customer_id", "device_type",
                         "most_common_device", "device_count")

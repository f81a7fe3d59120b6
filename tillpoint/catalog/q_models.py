"""Customer dimension model queries (full build and incremental merge)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillpoint.catalog.fixture_sql import with_inputs
from tillpoint.catalog.registry import register
from tillpoint.operators import customers as C
from tillpoint.plans.dim_customers import MAPS, dim_customers, incremental_dim_customers
from tillpoint.session import cut_lineage
from tillpoint.sources import fixtures as fx

# One list of facts, one aggregate over it: another road to the same columns.
_FACTS = ("facts", """
select customer_id, 'order' as kind, order_date as day, order_id::varchar as ref, total_amount as amount, null as label from f_orders
union all select customer_id, payment_status, null, payment_id::varchar, amount, null from f_payments
union all select customer_id, 'session', null, device_id::varchar, null, device_type from f_sessions""")
_TOP = ("top_device", """
select customer_id, first(label order by n desc, label) as most_common_device
from (select customer_id, label, count(*) as n from facts where kind = 'session' and label is not null group by all) group by customer_id""")
_SUMS = ("sums", """
select customer_id, min(day) as first_order_date, max(day) as most_recent_order_date,
       nullif(count(*) filter (kind = 'order'), 0) as number_of_orders, sum(amount) filter (kind = 'order') as spend,
       case when bool_or(kind not in ('order', 'session')) then coalesce(sum(amount) filter (kind = 'completed'), 0) end as total_paid,
       case when bool_or(kind not in ('order', 'session')) then coalesce(sum(amount) filter (kind = 'failed'), 0) end as total_failed,
       case when bool_or(kind not in ('order', 'session')) then count(distinct ref) filter (kind = 'completed') end as successful_payments_count,
       case when bool_or(kind = 'session') then count(distinct ref) filter (kind = 'session') end as devices_used
from facts group by customer_id""")
_BANDS = "(values (-1e300, 'bronze'), (100.0, 'silver'), (500.0, 'gold'), (1000.0, 'platinum'))"
_DIM_BODY = """
select {src}.customer_id, first_name, last_name, email, phone, registration_date, loyalty_tier,
       '{{"segment":"' || market_segment || '"}}' as demographics,
       '{{"segments":["' || market_segment || '"]}}' as preferences,
       first_order_date, most_recent_order_date, number_of_orders, round(spend, 6) as lifetime_value,
       round(total_paid, 6) as total_paid, round(total_failed, 6) as total_failed, successful_payments_count,
       devices_used, most_common_device,
       (select arg_max(b.label, b.low) from """ + _BANDS + """ b(low, label) where coalesce(spend, 0) > b.low) as value_segment,
       cast(date_diff('day', first_order_date, DATE '2002-01-01') as integer) as customer_tenure_days,
       cast(date_diff('day', most_recent_order_date, DATE '2002-01-01') as integer) as days_since_last_order,
       updated_at
from {src} left join sums using (customer_id) left join top_device using (customer_id)
{where}"""

#: Over the valid customers of the batch job, which carry no maps.
_DIM_SCALARS = "select * exclude (demographics, preferences) from (" + _DIM_BODY.format(src="valid", where="") + ")"

_INPUTS = ["f_customers", "f_orders", "f_payments", "f_sessions"]


def _maps_as_json(df):
    """Map columns as JSON text, which both engines render alike."""
    return df.withColumns({c: F.to_json(c) for c in MAPS})


def _inputs(spark, sf):
    return (fx.orders(spark, sf), fx.payments(spark, sf), fx.sessions(spark, sf))


@register("dim_customers", with_inputs(_INPUTS, _DIM_BODY.format(src="f_customers", where=""), ctes=[_FACTS, _TOP, _SUMS]))
def q_dim_customers(spark, sf):
    return _maps_as_json(dim_customers(fx.customers(spark, sf), *_inputs(spark, sf), fx.AS_OF))


_LATEST = ("latest", """select * exclude (rn) from (
    select *, row_number() over (partition by customer_id order by updated_at desc) as rn
    from f_customers_raw) where rn = 1""")
_TARGET = ("target", _DIM_BODY.format(src="f_customers", where=""))
_CHANGED = ("changed", _DIM_BODY.format(src="latest", where="where updated_at > (select max(updated_at) from target)"))


@register("dim_customers_incremental", with_inputs(_INPUTS + ["f_customers_raw"], """
select * from target where customer_id not in (select customer_id from changed)
union all
select * from changed""", ctes=[_FACTS, _TOP, _SUMS, _LATEST, _TARGET, _CHANGED]))
def q_dim_customers_incremental(spark, sf):
    """Initial build over the first customer versions, then an incremental
    run over the latest versions: only customers updated after the target's
    high-water mark are rebuilt and merged."""
    orders, payments, sessions = _inputs(spark, sf)
    target = cut_lineage(dim_customers(fx.customers(spark, sf), orders, payments, sessions, fx.AS_OF))
    latest = C.latest_per_key(_maps_as_json(fx.customers_raw(spark, sf)), "customer_id", "updated_at")
    return incremental_dim_customers(_maps_as_json(target), latest, orders, payments, sessions, fx.AS_OF)

"""Customer queries (clean/validate, CLV, 360, PII, contacts, enrichment)."""

from __future__ import annotations

from tillpoint.catalog.common import exact_means, round_cols
from tillpoint.catalog.fixture_sql import AS_OF as SQL_AS_OF, with_inputs
from tillpoint.catalog.registry import register
from tillpoint.operators import customers as C
from tillpoint.operators.setops import except_distinct
from tillpoint.sources import fixtures as fx

SALT = "tillpoint-salt"


# --------------------------------------------------------------------------- CLV
@register("clv", with_inputs(["f_customers", "f_orders"], """
select c.*, s.total_spend, s.order_count, s.avg_order_value, s.customer_tenure_days,
       case when s.total_spend > 1000 then 'high' when s.total_spend > 500 then 'medium' else 'low' end
         as clv_segment,
       s.order_count / nullif(s.customer_tenure_days / 30.0, 0) as purchase_frequency
from f_customers c
left join (
  select customer_id, round(sum(total_amount), 6) as total_spend,
         count(distinct order_id) as order_count,
         round(sum(total_amount), 6) / count(total_amount) as avg_order_value,
         cast(date_diff('day', min(order_date), max(order_date)) as integer) as customer_tenure_days
  from f_orders group by customer_id) s using (customer_id)
"""))
def q_clv(spark, sf):
    out = C.customer_lifetime_value(fx.orders(spark, sf), C.scalar_columns(fx.customers(spark, sf)))
    return exact_means(round_cols(out, ["total_spend"]), {"avg_order_value": "order_count"})


# --------------------------------------------------------------------------- clean + validate
_DEDUP_SQL = f"""
select * exclude (rn, loyalty_tier), coalesce(loyalty_tier, 'standard') as loyalty_tier,
       concat_ws(' ', first_name, last_name) as full_name,
       coalesce(customer_id is not null
                and regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}$')
                and registration_date <= {SQL_AS_OF}, false) as is_valid
from (select *, row_number() over (partition by customer_id order by updated_at desc) as rn
      from f_customers_raw) where rn = 1
"""


@register("process_customers_valid", with_inputs(["f_customers_raw"], """
select * exclude (is_valid) from tagged where is_valid""", ctes=[("tagged", _DEDUP_SQL)]))
def q_customers_valid(spark, sf):
    valid, _ = C.process_customer_data(C.scalar_columns(fx.customers_raw(spark, sf)), fx.AS_OF)
    return valid


@register("process_customers_invalid", with_inputs(["f_customers_raw"], """
select * exclude (is_valid) from tagged where not is_valid""", ctes=[("tagged", _DEDUP_SQL)]))
def q_customers_invalid(spark, sf):
    _, invalid = C.process_customer_data(C.scalar_columns(fx.customers_raw(spark, sf)), fx.AS_OF)
    return invalid


@register("dedup_customers", with_inputs(["f_customers_raw"], """
select * exclude (rn) from (
  select *, row_number() over (partition by customer_id order by updated_at desc) as rn
  from f_customers_raw) where rn = 1"""))
def q_dedup_customers(spark, sf):
    return C.latest_per_key(C.scalar_columns(fx.customers_raw(spark, sf)), "customer_id", "updated_at")


# --------------------------------------------------------------------------- customer 360
@register("customer360", with_inputs(["f_customers", "f_orders", "f_interactions"], f"""
select c.*, o.order_count, o.lifetime_value, o.avg_order_value, o.last_order_date,
       i.interaction_count, i.channels_used, i.last_interaction_date,
       cast(date_diff('day', o.last_order_date, {SQL_AS_OF}) as integer) as days_since_last_order,
       case when o.lifetime_value > 1000 then 'VIP' when o.lifetime_value > 500 then 'Loyal'
            else 'Standard' end as customer_segment
from f_customers c
left join (select customer_id, count(*) as order_count, round(sum(total_amount), 6) as lifetime_value,
                  round(sum(total_amount), 6) / count(total_amount) as avg_order_value, max(order_date) as last_order_date
           from f_orders group by customer_id) o using (customer_id)
left join (select customer_id, count(*) as interaction_count, count(distinct channel) as channels_used,
                  max(interaction_date) as last_interaction_date
           from f_interactions group by customer_id) i using (customer_id)
"""))
def q_customer360(spark, sf):
    out = C.customer_360(C.scalar_columns(fx.customers(spark, sf)), fx.orders(spark, sf),
                         fx.interactions(spark, sf), fx.AS_OF)
    return exact_means(round_cols(out, ["lifetime_value"]), {"avg_order_value": "order_count"})


# --------------------------------------------------------------------------- PII / contacts
@register("anonymize_pii", with_inputs(["f_customers"], f"""
select * exclude (email, phone),
       case when email is not null then sha256(email || '|' || '{SALT}') end as email_hash,
       case when phone is not null then sha256(phone || '|' || '{SALT}') end as phone_hash
from f_customers"""))
def q_anonymize_pii(spark, sf):
    return C.anonymize_pii(C.scalar_columns(fx.customers(spark, sf)), SALT)


_CONTACT_SQL = """
select *, coalesce(regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$'), false)
          and coalesce(regexp_matches(regexp_replace(phone, '[ ()-]', '', 'g'), '^\\+?[0-9]{7,15}$'), false)
          as contact_valid
from f_customers"""


@register("contact_valid", with_inputs(["f_customers"], "select * exclude (contact_valid) from t where contact_valid",
                                       ctes=[("t", _CONTACT_SQL)]))
def q_contact_valid(spark, sf):
    return C.validate_contact_info(C.scalar_columns(fx.customers(spark, sf)))[0]


@register("contact_invalid", with_inputs(["f_customers"],
                                         "select * exclude (contact_valid) from t where not contact_valid",
                                         ctes=[("t", _CONTACT_SQL)]))
def q_contact_invalid(spark, sf):
    return C.validate_contact_info(C.scalar_columns(fx.customers(spark, sf)))[1]


@register("enrich_external", with_inputs(["f_customers", "f_external"], """
select * from f_customers left join f_external using (nation_key)"""))
def q_enrich_external(spark, sf):
    return C.enrich_with_external(C.scalar_columns(fx.customers(spark, sf)),
                                  fx.external_enrichment(spark, sf), ["nation_key"])


@register("activity_segments", with_inputs(["f_customers"], f"""
select *, coalesce(days_since_last_activity between 0 and 30, false) as is_active,
          coalesce(days_since_last_activity between 31 and 90, false) as is_lapsing,
          coalesce(days_since_last_activity between 91 and 365, false) as is_churned,
          coalesce(days_since_last_activity >= 366, false) as is_inactive
from (select *, cast(date_diff('day', last_activity, {SQL_AS_OF}) as integer) as days_since_last_activity
      from f_customers) t
"""))
def q_activity_segments(spark, sf):
    return C.activity_segments(C.scalar_columns(fx.customers(spark, sf)), fx.AS_OF)


@register("except_distinct", with_inputs(["f_customers_raw"], """
select * from f_customers_raw
except
select * exclude (rn) from (
  select *, row_number() over (partition by customer_id order by updated_at desc) as rn
  from f_customers_raw) where rn = 1"""))
def q_except_distinct(spark, sf):
    """Superseded customer versions: all versions EXCEPT the latest ones."""
    raw = C.scalar_columns(fx.customers_raw(spark, sf))
    return except_distinct(raw, C.latest_per_key(raw, "customer_id", "updated_at"))

"""Data-quality and forecasting queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillpoint.catalog.fixture_sql import with_inputs
from tillpoint.catalog.registry import register
from tillpoint.operators import customers as C
from tillpoint.operators import forecast as FC
from tillpoint.operators import quality as Q
from tillpoint.sources import fixtures as fx

# --------------------------------------------------------------------------- data quality
CONSISTENCY = "registration_date <= TIMESTAMP'2002-01-01 00:00:00'"


def _rules(spark, sf):
    valid, _ = C.process_customer_data(C.scalar_columns(fx.customers_raw(spark, sf)), fx.AS_OF)
    return {
        "contacts_complete": {"type": "completeness", "columns": ["email", "phone"], "threshold": 0.1},
        "customer_id_unique": {"type": "uniqueness", "columns": ["customer_id"], "threshold": 5.0},
        "registered_before_run": {"type": "consistency", "condition": CONSISTENCY},
    }, valid


def _finish_sql(name, kind, threshold, fraction: bool) -> str:
    pct = "coalesce(violations * 100.0::double / nullif(total, 0), 0.0::double)"
    ratio = "coalesce(violations::double / nullif(total, 0), 0.0::double)"
    passed = f"{ratio} <= {threshold}" if fraction else f"{pct} <= {threshold}"
    return (f"select '{name}' as check_name, '{kind}' as check_type, column_name, violations, total, "
            f"{pct} as percentage, {float(threshold)}::double as threshold, {passed} as passed")


_COMPLETENESS = _finish_sql("contacts_complete", "completeness", 0.1, True) + """
from (select 'email' as column_name, cast(count_if(email is null) as bigint) as violations, count(*) as total
      from f_customers_raw
      union all
      select 'phone', cast(count_if(phone is null) as bigint), count(*) from f_customers_raw)"""
_UNIQUENESS = _finish_sql("customer_id_unique", "uniqueness", 5.0, False) + """
from (select 'customer_id' as column_name, cast(coalesce(sum(case when n > 1 then n end), 0) as bigint) as violations,
             cast(coalesce(sum(n), 0) as bigint) as total
      from (select customer_id, count(*) as n from f_customers_raw group by customer_id))"""
_CONSISTENCY = _finish_sql("registered_before_run", "consistency", 0.0, True) + """
from (select null::varchar as column_name,
             cast(count_if(not coalesce(registration_date <= TIMESTAMP '2002-01-01 00:00:00', false)) as bigint)
               as violations,
             count(*) as total from f_customers_raw)"""
_VALID = ("valid", """select customer_id from (
    select *, row_number() over (partition by customer_id order by updated_at desc) as rn from f_customers_raw)
  where rn = 1 and customer_id is not null
    and coalesce(regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$'), false)
    and registration_date <= TIMESTAMP '2002-01-01 00:00:00'""")
_REFERENTIAL = _finish_sql("orders_reference_valid_customers", "referential", 0.0, True) + """
from (select 'customer_id' as column_name,
             (select count(*) from f_orders o where o.customer_id is not null
                and o.customer_id not in (select customer_id from valid)) as violations,
             (select count(*) from f_orders) as total)"""


@register("dq_completeness", with_inputs(["f_customers_raw"], _COMPLETENESS))
def q_dq_completeness(spark, sf):
    raw = C.scalar_columns(fx.customers_raw(spark, sf))
    return Q.check_completeness(raw, "contacts_complete", ["email", "phone"], 0.1)


@register("dq_uniqueness", with_inputs(["f_customers_raw"], _UNIQUENESS))
def q_dq_uniqueness(spark, sf):
    raw = C.scalar_columns(fx.customers_raw(spark, sf))
    return Q.check_uniqueness(raw, "customer_id_unique", ["customer_id"], 5.0)


@register("dq_consistency", with_inputs(["f_customers_raw"], _CONSISTENCY))
def q_dq_consistency(spark, sf):
    raw = C.scalar_columns(fx.customers_raw(spark, sf))
    return Q.check_consistency(raw, "registered_before_run", CONSISTENCY)


@register("dq_referential", with_inputs(["f_customers_raw", "f_orders"], _REFERENTIAL, ctes=[_VALID]))
def q_dq_referential(spark, sf):
    _, valid = _rules(spark, sf)
    return Q.check_referential(fx.orders(spark, sf), "orders_reference_valid_customers", "customer_id",
                               valid, "customer_id")


@register("dq_summary", with_inputs(["f_customers_raw", "f_orders"], """
select cast(count_if(passed) as bigint) as passed_checks, cast(count_if(not passed) as bigint) as failed_checks,
       count(*) as total_checks
from (select check_name, bool_and(passed) as passed from all_checks group by check_name)""",
                                    ctes=[_VALID, ("all_checks", " union all ".join(
                                        f"({x})" for x in (_COMPLETENESS, _UNIQUENESS, _CONSISTENCY, _REFERENTIAL)))]))
def q_dq_summary(spark, sf):
    rules, valid = _rules(spark, sf)
    raw = C.scalar_columns(fx.customers_raw(spark, sf))
    results = Q.run_checks(raw, rules).unionByName(
        Q.check_referential(fx.orders(spark, sf), "orders_reference_valid_customers", "customer_id",
                            valid, "customer_id"))
    return Q.summarize(results)


# --------------------------------------------------------------------------- forecasting
_HR = [
    ("s", "select product_id, date, cast(sales as double) as y from f_sales_series"),
    ("s1", "select *, y - lag(y) over (partition by product_id order by date) as d from s"),
    ("s2", "select *, lag(d) over (partition by product_id order by date) as d1 from s1"),
    ("s3", """select *, d - (sum(d * d1) over (partition by product_id)
                         / sum(d1 * d1) over (partition by product_id)) * d1 as e from s2"""),
    ("s4", """select *, lag(e) over (partition by product_id order by date) as e1,
                     d is not null and d1 is not null
                       and lag(e) over (partition by product_id order by date) is not null as ok from s3"""),
    ("s5", """select *, sum(case when ok then d1 * d1 end) over p as sxx, sum(case when ok then e1 * e1 end) over p as see,
                     sum(case when ok then d1 * e1 end) over p as sxe, sum(case when ok then d1 * d end) over p as sxd,
                     sum(case when ok then e1 * d end) over p as sed
              from s4 window p as (partition by product_id)"""),
    ("s6", """select *, greatest(-0.99, least(0.99, (sxd * see - sed * sxe) / nullif(sxx * see - sxe * sxe, 0))) as phi,
                     greatest(-0.99, least(0.99, (sed * sxx - sxd * sxe) / nullif(sxx * see - sxe * sxe, 0))) as theta
              from s5"""),
    ("s7", "select *, case when ok then d - phi * d1 - theta * e1 end as u from s6"),
    ("g", """select product_id, count(*) as n_points, any_value(phi) as phi, any_value(theta) as theta,
                    sum(u * u) as sse, count(u) as n_resid, arg_max(y, date) as last_value,
                    arg_max(d, date) as last_diff, arg_max(u, date) as last_resid
             from s7 group by product_id"""),
    ("params", """select product_id, n_points,
                         case when n_points >= 8 then phi end as phi,
                         case when n_points >= 8 then theta end as theta,
                         case when n_points >= 8 then sse / n_resid end as sigma2,
                         case when n_points >= 8 then n_resid * ln(sse / n_resid)
                                                     + n_resid * (1 + ln(2 * pi())) + 6 end as aic,
                         last_value, last_diff, last_resid from g"""),
]


@register("forecast_params", with_inputs(["f_sales_series"], """
select product_id, n_points, round(phi, 6) as phi, round(theta, 6) as theta, round(sigma2, 4) as sigma2,
       round(aic, 4) as aic from params""", ctes=_HR))
def q_forecast_params(spark, sf):
    p = FC.arima111_params(fx.sales_series(spark, sf))
    return p.select("product_id", "n_points", F.round("phi", 6).alias("phi"), F.round("theta", 6).alias("theta"),
                    F.round("sigma2", 4).alias("sigma2"), F.round("aic", 4).alias("aic"))


@register("forecast_sales", with_inputs(["f_sales_series"], """
select product_id, step,
       round(last_value + (phi * last_diff + theta * last_resid) * (1 - pow(phi, step)) / (1 - phi), 4) as forecast
from params, range(1, 8) r(step)""".replace("range(1, 8) r(step)", "(select cast(range as integer) as step from range(1, 8))"),
                                     ctes=_HR))
def q_forecast_sales(spark, sf):
    f = FC.arima111_forecast(fx.sales_series(spark, sf), steps=7)
    return f.withColumn("forecast", F.round("forecast", 4))

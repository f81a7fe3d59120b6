"""Declarative transformation queries (add_column ... schema_change)."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from tillpoint.catalog.common import exact_means
from tillpoint.catalog.fixture_sql import with_inputs
from tillpoint.catalog.registry import register
from tillpoint.operators.transforms import apply_transformations
from tillpoint.sources import fixtures as fx


def _orders(spark, sf):
    return fx.orders(spark, sf)


def _campaigns_r(spark, sf):
    c = fx.campaigns(spark, sf)
    return c.select(F.col("campaign_id").alias("cid"), "campaign_name", "cost")


# --------------------------------------------------------------------------- chain
CHAIN = [
    {"type": "add_column", "column_name": "order_year", "expression": "year(order_date)"},
    {"type": "filter", "condition": "total_amount > 100 and order_status <> 'P'"},
    {"type": "aggregate", "group_by": ["order_year", "order_status"],
     "aggregations": ["count(*) as n_orders", "round(sum(total_amount), 6) as revenue",
                      "max(total_amount) as max_amount"]},
]


@register("transform_chain", with_inputs(["f_orders"], """
select cast(year(order_date) as integer) as order_year, order_status, count(*) as n_orders,
       round(sum(total_amount), 6) as revenue, max(total_amount) as max_amount
from f_orders where total_amount > 100 and order_status <> 'P'
group by 1, 2"""))
def q_transform_chain(spark, sf):
    return apply_transformations(_orders(spark, sf), CHAIN)


@register("t_add_column", with_inputs(["f_orders"], """
select *, total_amount * 1.08 as gross_amount from f_orders"""))
def q_t_add_column(spark, sf):
    return apply_transformations(_orders(spark, sf), [
        {"type": "add_column", "column_name": "gross_amount", "expression": "total_amount * 1.08"}])


@register("t_filter", with_inputs(["f_orders"], """
select * from f_orders where total_amount > 250 and order_status = 'F'"""))
def q_t_filter(spark, sf):
    return apply_transformations(_orders(spark, sf), [
        {"type": "filter", "condition": "total_amount > 250 and order_status = 'F'"}])


# --------------------------------------------------------------------------- joins
_JOIN_SQL = {
    "inner": "select * from f_orders l join r on l.campaign_id = r.cid",
    "left": "select * from f_orders l left join r on l.campaign_id = r.cid",
    "right": "select * from f_orders l right join r on l.campaign_id = r.cid",
    "full": "select * from f_orders l full join r on l.campaign_id = r.cid",
    "semi": "select * from f_orders l semi join r on l.campaign_id = r.cid and r.cost > 2000",
    "anti": "select * from f_orders l anti join r on l.campaign_id = r.cid and r.cost > 2000",
}
_SPARK_HOW = {"inner": "inner", "left": "left", "right": "right", "full": "full",
              "semi": "left_semi", "anti": "left_anti"}
_R = ("r", "select campaign_id as cid, campaign_name, cost from f_campaigns")


def _join_query(kind):
    cond = "l.campaign_id = r.cid" + (" and r.cost > 2000" if kind in ("semi", "anti") else "")

    def q(spark, sf):
        return apply_transformations(_orders(spark, sf), [
            {"type": "join", "join_with": "campaigns", "join_type": _SPARK_HOW[kind],
             "condition": cond}], join_dfs={"campaigns": _campaigns_r(spark, sf)})
    return q


for _kind, _sql in _JOIN_SQL.items():
    register(f"t_join_{_kind}", with_inputs(["f_orders", "f_campaigns"], _sql, ctes=[_R]))(_join_query(_kind))


@register("t_join_theta", with_inputs(["f_orders", "f_campaigns"], """
select * from f_orders l join r on l.total_amount * 10 >= r.cost and l.total_amount * 10 < r.cost + 1000""",
                                      ctes=[_R]))
def q_t_join_theta(spark, sf):
    """Band (non-equi) join against a dimension whose size is bounded by the
    nation table; Spark plans it as a broadcast nested-loop join."""
    return apply_transformations(_orders(spark, sf), [
        {"type": "join", "join_with": "campaigns", "join_type": "inner", "allow_cross": True,
         "condition": "l.total_amount * 10 >= r.cost and l.total_amount * 10 < r.cost + 1000"}],
        join_dfs={"campaigns": _campaigns_r(spark, sf)})


@register("t_join_band", with_inputs(["f_orders"], """
select l.order_id, l.total_amount, r.near_id, r.near_amount
from f_orders l join (select order_id as near_id, total_amount as near_amount, customer_id as near_customer from f_orders) r
  on r.near_amount between l.total_amount - 0.02 and l.total_amount + 0.02 and l.order_id < r.near_id and l.customer_id <> r.near_customer"""))
def q_t_join_band(spark, sf):
    """Orders of other customers with nearly the same amount: two large sides, met by bands of amounts."""
    near = _orders(spark, sf).select(F.col("order_id").alias("near_id"), F.col("total_amount").alias("near_amount"), F.col("customer_id").alias("near_customer"))
    return apply_transformations(_orders(spark, sf).select("order_id", "customer_id", "total_amount"), [
        {"type": "join", "join_with": "near", "band": {"left": ["total_amount - 0.02", "total_amount + 0.02"], "right": "near_amount"},
         "condition": "l.order_id < r.near_id and l.customer_id <> r.near_customer"}],
        join_dfs={"near": near}).select("order_id", "total_amount", "near_id", "near_amount")


# --------------------------------------------------------------------------- aggregation / pivot
@register("t_aggregate", with_inputs(["f_sales"], """
select return_flag, line_number, count(*) as n_lines, sum(quantity) as qty, max(price) as max_price
from f_sales group by return_flag, line_number"""))
def q_t_aggregate(spark, sf):
    return apply_transformations(fx.sales(spark, sf), [
        {"type": "aggregate", "group_by": ["return_flag", "line_number"],
         "aggregations": ["count(*) as n_lines", "sum(quantity) as qty", "max(price) as max_price"]}])


@register("t_aggregate_global", with_inputs(["f_sales"], """
select count(*) as n_lines, sum(quantity) as qty, min(price) as min_price, count(distinct product_id) as n_products
from f_sales"""))
def q_t_aggregate_global(spark, sf):
    return apply_transformations(fx.sales(spark, sf), [
        {"type": "aggregate", "group_by": [],
         "aggregations": ["count(*) as n_lines", "sum(quantity) as qty", "min(price) as min_price",
                          "count(distinct product_id) as n_products"]}])


_LINES = [1, 2, 3, 4, 5, 6, 7]


@register("t_pivot", with_inputs(["f_sales"], "select return_flag, " + ", ".join(
    f'sum(case when line_number = {v} then quantity end) as "{v}"' for v in _LINES)
    + " from f_sales group by return_flag"))
def q_t_pivot(spark, sf):
    return apply_transformations(fx.sales(spark, sf), [
        {"type": "pivot", "group_by": ["return_flag"], "pivot_col": "line_number", "values": _LINES,
         "aggregations": "sum(quantity)"}])


@register("t_pivot_multi", with_inputs(["f_sales"], "select return_flag, " + ", ".join(
    f'sum(case when line_number = {v} then quantity end) as "{v}_qty", '
    f'count(case when line_number = {v} then 1 end) as "{v}_n"' for v in _LINES)
    + " from f_sales group by return_flag"))
def q_t_pivot_multi(spark, sf):
    return apply_transformations(fx.sales(spark, sf), [
        {"type": "pivot", "group_by": ["return_flag"], "pivot_col": "line_number", "values": _LINES,
         "aggregations": ["sum(quantity) as qty", "count(1) as n"]}])


# --------------------------------------------------------------------------- windows
@register("t_window_rank", with_inputs(["f_orders"], """
select *, rank() over (partition by customer_id order by total_amount desc, order_id) as amount_rank
from f_orders"""))
def q_t_window_rank(spark, sf):
    return apply_transformations(_orders(spark, sf), [
        {"type": "window", "column_name": "amount_rank", "function": "rank()",
         "window_spec": {"partition_by": "customer_id", "order_by": ["total_amount desc", "order_id"]}}])


@register("t_window_frame", with_inputs(["f_orders"], """
select *, round(sum(total_amount) over (partition by customer_id order by order_date, order_id
                                        rows between unbounded preceding and current row), 6) as running_total,
          round(sum(total_amount) over (partition by customer_id order by order_date, order_id
                                        rows between 2 preceding and current row), 6) as last3_total
from f_orders"""))
def q_t_window_frame(spark, sf):
    out = apply_transformations(_orders(spark, sf), [
        {"type": "window", "column_name": "running_total", "function": "sum(total_amount)",
         "window_spec": {"partition_by": "customer_id", "order_by": ["order_date", "order_id"],
                         "frame": {"start": "unboundedPreceding", "end": "currentRow"}}},
        {"type": "window", "column_name": "last3_total", "function": "sum(total_amount)",
         "window_spec": {"partition_by": "customer_id", "order_by": ["order_date", "order_id"],
                         "frame": {"start": -2, "end": 0}}},
    ])
    return out.withColumns({c: F.round(c, 6) for c in ("running_total", "last3_total")})


@register("t_window_range_offset", with_inputs(["f_orders"], """
select order_id, customer_id, total_amount, order_day,
       round(sum(total_amount) over month, 6) as month_total, count(*) over month as month_orders,
       max(total_amount) over (partition by customer_id order by order_day range between 90 preceding and 90 following) as season_max
from (select *, cast(date_diff('day', DATE '1970-01-01', cast(order_date as date)) as integer) as order_day from f_orders) o
window month as (partition by customer_id order by order_day range between 30 preceding and current row)"""))
def q_t_window_range_offset(spark, sf):
    """Frames by distance in days: thirty days back, and ninety days both ways."""
    days = _orders(spark, sf).select("order_id", "customer_id", "total_amount", F.unix_date(F.to_date("order_date")).alias("order_day"))
    spec = lambda start, end: {"partition_by": "customer_id", "order_by": "order_day", "frame": {"kind": "range", "start": start, "end": end}}
    out = apply_transformations(days, [
        {"type": "window", "column_name": "month_total", "function": "sum(total_amount)", "window_spec": spec(-30, 0)},
        {"type": "window", "column_name": "month_orders", "function": "count(*)", "window_spec": spec(-30, 0)},
        {"type": "window", "column_name": "season_max", "function": "max(total_amount)", "window_spec": spec(-90, 90)}])
    return out.withColumn("month_total", F.round("month_total", 6))


@register("t_window_ahead", with_inputs(["f_orders"], """
select order_id, customer_id, total_amount, order_date,
       round(sum(total_amount) over (partition by customer_id order by order_date, order_id rows between 1 following and 3 following), 6) as next3_total,
       min(total_amount) over (partition by customer_id order by order_date, order_id rows between 2 preceding and 2 following) as around_min,
       round(sum(total_amount) over upto, 6) / count(total_amount) over upto as mean_so_far, count(total_amount) over upto as n_so_far
from f_orders window upto as (partition by customer_id order by order_date, order_id rows between unbounded preceding and current row)"""))
def q_t_window_ahead(spark, sf):
    """Frames that look ahead, frames around the row, and a running average."""
    orders = _orders(spark, sf).select("order_id", "customer_id", "total_amount", "order_date")
    spec = lambda start, end: {"partition_by": "customer_id", "order_by": ["order_date", "order_id"], "frame": {"start": start, "end": end}}
    out = apply_transformations(orders, [
        {"type": "window", "column_name": "next3_total", "function": "sum(total_amount)", "window_spec": spec(1, 3)},
        {"type": "window", "column_name": "around_min", "function": "min(total_amount)", "window_spec": spec(-2, 2)},
        {"type": "window", "column_name": "mean_so_far", "function": "avg(total_amount)", "window_spec": spec("unboundedPreceding", "currentRow")},
        {"type": "window", "column_name": "n_so_far", "function": "count(total_amount)", "window_spec": spec("unboundedPreceding", "currentRow")}])
    return exact_means(out.withColumn("next3_total", F.round("next3_total", 6)), {"mean_so_far": "n_so_far"})


# --------------------------------------------------------------------------- UDFs
def _priority_code(p):
    return None if p is None else p.split("-", 1)[0]


def _udf_step(name):
    return {"type": "udf", "udf_name": name, "function": _priority_code, "input_cols": ["priority"],
            "output_col": "priority_code", "return_type": "string"}


@register("t_udf", with_inputs(["f_orders"], """
select *, split_part(priority, '-', 1) as priority_code from f_orders"""))
def q_t_udf(spark, sf):
    return apply_transformations(_orders(spark, sf), [_udf_step("priority_code")])


@register("t_udf_sql_call", with_inputs(["f_orders"], """
select order_id, priority, split_part(priority, '-', 1) as code from f_orders"""))
def q_t_udf_sql_call(spark, sf):
    """The UDF registered by the ``udf`` step is callable from SQL by name."""
    orders = _orders(spark, sf)
    apply_transformations(orders, [_udf_step("prio_code")])
    view = f"orders_{uuid.uuid4().hex[:8]}"
    orders.createOrReplaceTempView(view)
    return spark.sql(f"select order_id, priority, prio_code(priority) as code from {view}")


def _gross(amount: pd.Series, hours: pd.Series) -> pd.Series:
    return amount * 2.0 + hours


def _spread(amount: pd.Series) -> float:
    return float(amount.max() - amount.min())


@register("t_pandas_udf", with_inputs(["f_orders"], """
select *, total_amount * 2.0 + promised_sla_hours as amount_plus_sla from f_orders"""))
def q_t_pandas_udf(spark, sf):
    return apply_transformations(_orders(spark, sf), [
        {"type": "pandas_udf", "pandas_udf_name": "amount_plus_sla", "function": _gross,
         "input_cols": ["total_amount", "promised_sla_hours"], "output_col": "amount_plus_sla",
         "return_type": "double"}])


@register("t_pandas_udaf", with_inputs(["f_orders"], """
select customer_id, max(total_amount) - min(total_amount) as amount_spread from f_orders group by customer_id"""))
def q_t_pandas_udaf(spark, sf):
    return apply_transformations(_orders(spark, sf), [
        {"type": "pandas_udf", "pandas_udf_name": "amount_spread", "function": _spread,
         "function_type": "GROUPED_AGG", "group_by": ["customer_id"], "input_cols": ["total_amount"],
         "output_col": "amount_spread", "return_type": "double"}])


class Variance:
    """Population variance from counts, means and squared deviations, merged pairwise."""

    state = "n long, mean double, m2 double"

    def init(self):
        return 0, 0.0, 0.0

    def update(self, values):
        x = values.drop_null().to_numpy(zero_copy_only=False)
        if not len(x):
            return self.init()
        mean = float(x.mean())
        return len(x), mean, float(((x - mean) ** 2).sum())

    def merge(self, states):
        n, mean, m2 = self.init()
        for k, other, q in states:
            if k:
                gap = other - mean
                m2 += q + gap * gap * n * k / (n + k)
                mean += gap * k / (n + k)
                n += k
        return n, mean, m2

    def finish(self, state):
        n, _, m2 = state
        return m2 / n if n else None


@register("t_arrow_udaf", with_inputs(["f_orders"], """
select order_status, priority, round(var_pop(total_amount), 4) as amount_variance from f_orders group by order_status, priority"""))
def q_t_arrow_udaf(spark, sf):
    """A Python aggregate over a few large groups, folded in parts."""
    out = apply_transformations(_orders(spark, sf), [
        {"type": "pandas_udf", "pandas_udf_name": "amount_variance", "function": Variance(), "function_type": "MERGEABLE",
         "group_by": ["order_status", "priority"], "input_cols": ["total_amount"], "output_col": "amount_variance", "return_type": "double"}])
    return out.withColumn("amount_variance", F.round("amount_variance", 4))


@register("t_schema_change", with_inputs(["f_orders"], """
select order_id as id, customer_id, order_status as status, total_amount, order_date, shipped_date,
       cast(promised_sla_hours as integer) as promised_sla_hours, cast(campaign_id as varchar) as campaign_id
from f_orders"""))
def q_t_schema_change(spark, sf):
    return apply_transformations(_orders(spark, sf), [
        {"type": "schema_change", "changes": {
            "order_id": {"new_name": "id"},
            "order_status": {"new_name": "status", "new_type": "string"},
            "promised_sla_hours": {"new_type": "int"},
            "campaign_id": {"new_type": "string"},
            "priority": {"drop": True},
        }}])

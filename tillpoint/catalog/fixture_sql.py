"""The logical inputs of ``tillpoint.sources.fixtures`` spelled in DuckDB SQL.

Used only by the oracle queries: an independent engine rebuilds the same
inputs from the same tables, so a Spark result can be checked end to end.
Each entry is (dependencies, body); ``with_inputs`` assembles a WITH clause.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2002-01-01 00:00:00'"
EVENTS_AS_OF = "DATE '2024-02-01'"

FIXTURES: dict[str, tuple[tuple[str, ...], str]] = {
    "f_customers": ((), """
        select c_custkey as customer_id,
               'First' || (c_custkey % 50) as first_name,
               'Last' || (c_custkey % 70) as last_name,
               case when c_custkey % 23 = 0 then null
                    when c_custkey % 17 = 0 then 'bad-email'
                    else 'user' || c_custkey || '@example.com' end as email,
               case when c_custkey % 19 = 0 then '12-x'
                    else '+1555' || lpad(cast(c_custkey as varchar), 7, '0') end as phone,
               DATE '1995-01-01' + cast(c_custkey * 7 % 2700 as integer) as registration_date,
               case when c_custkey % 11 = 0 then null
                    when c_mktsegment = 'AUTOMOBILE' then 'gold'
                    when c_mktsegment = 'BUILDING' then 'silver'
                    when c_mktsegment = 'FURNITURE' then 'bronze'
                    else 'standard' end as loyalty_tier,
               TIMESTAMP '2002-01-01 00:00:00' - to_days(cast(c_custkey % 500 as integer)) as last_activity,
               TIMESTAMP '2001-01-01 00:00:00' + to_days(cast(c_custkey % 365 as integer)) as updated_at,
               c_nationkey as nation_key,
               c_acctbal as account_balance,
               c_mktsegment as market_segment
        from customer"""),
    "f_customers_raw": (("f_customers",), """
        select * from f_customers
        union all
        select customer_id, first_name, 'Relast' || (customer_id % 70) as last_name, email, phone,
               registration_date, loyalty_tier, last_activity, updated_at + to_days(30) as updated_at,
               nation_key, account_balance, market_segment
        from f_customers where customer_id % 10 = 0"""),
    "f_customer_geo": ((), """
        select c_custkey as customer_id,
               cast(c_custkey * 37 % 1600 as double) / 10 - 80 as customer_lat,
               cast(c_custkey * 91 % 3600 as double) / 10 - 180 as customer_lon
        from customer"""),
    "f_stores": ((), """
        select s_suppkey as store_id,
               cast(s_suppkey * 53 % 1600 as double) / 10 - 80 as store_lat,
               cast(s_suppkey * 71 % 3600 as double) / 10 - 180 as store_lon
        from supplier"""),
    "f_external": ((), """
        select n_nationkey as nation_key, n_name as nation_name, r_name as region_name
        from nation left join region on n_regionkey = r_regionkey"""),
    "f_orders": ((), """
        select o_orderkey as order_id, o_custkey as customer_id, o_orderstatus as order_status,
               o_totalprice / 1000.0 as total_amount, o_orderdate as order_date,
               case when o_orderkey % 29 = 0 then null
                    else o_orderdate + to_days(cast(o_orderkey % 10 as integer)) end as shipped_date,
               24 * (1 + o_orderkey % 7) as promised_sla_hours,
               o_orderkey % 7 as campaign_id,
               o_orderpriority as priority
        from orders"""),
    "f_orders_outliers": (("f_orders",), """
        select * replace (case when order_id % 500 = 0 then total_amount * 20
                               else total_amount end as total_amount)
        from f_orders"""),
    "f_campaigns": ((), """
        select cast(case when n_nationkey < 10 then n_nationkey else n_nationkey + 100 end as bigint) as campaign_id, n_name as campaign_name,
               cast(n_nationkey * 1000 as double) as cost
        from nation"""),
    "f_change_log": ((), """
        select o_orderkey as order_id, 1 as version, TIMESTAMP '2024-01-01 00:00:00' as commit_ts, 'I' as op,
               o_totalprice / 1000.0 as total_amount, o_orderstatus as order_status, o_custkey as customer_id
        from orders
        union all
        select o_orderkey, 2, TIMESTAMP '2024-01-02 00:00:00', 'U', o_totalprice / 1000.0 * 2, 'U', o_custkey
        from orders where o_orderkey % 10 = 0
        union all
        select o_orderkey, 3, TIMESTAMP '2024-01-03 00:00:00', 'D', null, null, o_custkey
        from orders where o_orderkey % 25 = 0"""),
    "f_products": ((), """
        select p_partkey as product_id, p_name as name, p_brand as brand, p_type as product_type,
               p_size as category_id, 'Cat' || p_size as category, p_retailprice as price,
               case when p_partkey % 13 = 0 then null else p_retailprice * 0.6 end as cost,
               p_partkey % 5 <> 0 as in_stock
        from part"""),
    "f_categories": ((), """
        select case when p_size <= 45 then p_size else p_size + 100 end as category_id, 'Cat' || p_size as category_name,
               'L1-' || (p_size % 3) as category_level1,
               'L2-' || (p_size % 7) as category_level2,
               case when p_size % 4 = 0 then null else 'L3-' || p_size end as category_level3
        from (select distinct p_size from part)"""),
    "f_inventory": ((), """
        select p_partkey as product_id, p_partkey % 60 as current_stock from part"""),
    "f_sales": ((), """
        select l_partkey as product_id, l_orderkey as order_id, l_linenumber as line_number,
               l_quantity as quantity, l_quantity as quantity_sold,
               l_extendedprice / l_quantity as price, l_extendedprice as revenue,
               1 + cast(l_quantity as integer) % 5 as rating, l_returnflag as return_flag
        from lineitem"""),
    "f_sales_dated": (("f_sales",), """
        select s.*, o_custkey as customer_id, o_orderdate as date
        from f_sales s join orders on s.order_id = o_orderkey"""),
    "f_demand_forecast": ((), """
        select l_partkey as product_id, avg(l_quantity) as prediction from lineitem group by l_partkey"""),
    "f_baskets": ((), """
        select l_orderkey as order_id, p_type as product_id
        from lineitem join part on l_partkey = p_partkey"""),
    "f_payments": ((), """
        select o_custkey as customer_id, l_orderkey * 10 + l_linenumber as payment_id,
               case l_returnflag when 'A' then 'completed' when 'R' then 'failed'
                    when 'N' then 'pending' end as payment_status,
               l_extendedprice / 1000.0 as amount
        from lineitem join orders on l_orderkey = o_orderkey"""),
    "f_sales_series": ((), """
        select p_brand as product_id, date_trunc('month', o_orderdate) as date, sum(l_quantity) as sales
        from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
        group by 1, 2"""),
    "f_interactions": ((), """
        select user_id as customer_id, event_type as channel, ts as interaction_date from events"""),
    "f_experiment": ((), """
        select user_id, case when user_id % 2 = 0 then 'A' else 'B' end as variant,
               event_type = 'purchase' as converted
        from events"""),
    "f_experiment3": ((), """
        select user_id, 'V' || (user_id % 3) as variant, event_type = 'purchase' as converted
        from events"""),
    "f_sessions": ((), """
        select user_id as customer_id, user_id * 10 + event_id % 3 as device_id, event_type as device_type
        from events"""),
    "f_clickstream": ((), """
        select ts as event_time, user_id, event_type as page_category, event_id % 200 as product_id
        from events"""),
}


def with_inputs(names, body: str, ctes=()) -> str:
    """``WITH`` clause holding ``names`` (plus dependencies) and the extra
    ``(name, sql)`` pairs in ``ctes``, followed by ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in FIXTURES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} as ({FIXTURES[n][1]}\n)" for n in order]
    parts += [f"{n} as ({sql}\n)" for n, sql in ctes]
    if not parts:
        return body
    return "with " + ",\n".join(parts) + "\n" + body

"""Top-N by inner product, pruned by vector lengths."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillpoint.catalog.fixture_sql import with_inputs
from tillpoint.catalog.registry import register
from tillpoint.operators import topn as T
from tillpoint.sources import fixtures as fx

_LINES = range(1, 8)
_PROFILE = "[" + ", ".join(f"sum(case when line_number = {v} then quantity else 0.0 end)::double" for v in _LINES) + "]"


def _profile(df, key: str):
    """What a customer buys, or a product sells, at each place of an order."""
    place = lambda v: F.sum(F.when(F.col("line_number") == v, F.col("quantity")).otherwise(0.0)).cast("double")
    return df.groupBy(key).agg(F.array(*[place(v) for v in _LINES]).alias("features"))


@register("recommend_topn_pruned", with_inputs(["f_sales_dated"], f"""
select customer_id, rank, product_id, score from (
  select customer_id, product_id, list_inner_product(u.v, i.v) as score,
         row_number() over (partition by customer_id order by list_inner_product(u.v, i.v) desc, product_id) as rank
  from (select customer_id, {_PROFILE} as v from f_sales_dated group by customer_id) u
  cross join (select product_id, {_PROFILE} as v from f_sales_dated group by product_id) i) s
where rank <= 5"""))
def q_recommend_topn_pruned(spark, sf):
    """The five products whose profile fits each customer's best, without the product of customers and products."""
    lines = fx.sales_dated(spark, sf)
    lists, _ = T.top_n(_profile(lines, "customer_id"), _profile(lines, "product_id"), 5, "customer_id", "product_id")
    return lists.select(F.col("user").alias("customer_id"), F.col("rank").cast("long").alias("rank"), F.col("item").alias("product_id"), "score")

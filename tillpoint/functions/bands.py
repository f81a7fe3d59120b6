"""Labels by thresholds, and the measures of a customer's orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values: (label of the rest, ((exclusive lower bound, label), ...)).
SPEND_BANDS = ("low", ((500, "medium"), (1000, "high")))
PROFILE_BANDS = ("Standard", ((500, "Loyal"), (1000, "VIP")))
DIMENSION_BANDS = ("bronze", ((100, "silver"), (500, "gold"), (1000, "platinum")))


def band(value: Column, bands: tuple[str, Sequence[tuple[float, str]]]) -> Column:
    """The label of the highest bound that ``value`` exceeds; the rest, and NULL, get the first label."""
    rest, steps = bands
    passed = F.filter(F.array(*[F.when(value > low, F.lit(label)) for low, label in steps]), lambda x: x.isNotNull())
    return F.coalesce(F.try_element_at(passed, F.lit(-1)), F.lit(rest))


_MEASURES = {
    "orders": lambda: F.count("order_id"),
    "distinct": lambda: F.countDistinct("order_id"),
    "spend": lambda: F.sum("total_amount"),
    "mean": lambda: F.avg("total_amount"),
    "first": lambda: F.min("order_date"),
    "last": lambda: F.max("order_date"),
    "span": lambda: F.datediff(F.max("order_date"), F.min("order_date")),
}


def order_measures(orders: DataFrame, **names: str) -> DataFrame:
    """One row per customer: ``result=measure`` for any of orders, distinct, spend, mean, first, last, span."""
    return orders.groupBy("customer_id").agg(*[_MEASURES[m]().alias(n) for n, m in names.items()])

"""Entity specifications: required columns, primary key, write layout.

A light record instead of a wrapper class hierarchy: operators stay plain
``DataFrame -> DataFrame`` functions, and an ``EntitySpec`` adds the checks
and the merge key that belong to a business entity.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tillpoint.functions.validators import require_columns
from tillpoint.operators.history import merge_upsert


@dataclass(frozen=True)
class EntitySpec:
    name: str
    required: tuple[str, ...]
    key: tuple[str, ...]
    partition_by: tuple[str, ...] = ()

    def validate(self, df: DataFrame) -> DataFrame:
        """Raise when a required column is missing; return ``df`` unchanged."""
        return require_columns(df, self.required, self.name)

    def merge_condition(self) -> str:
        return " and ".join(f"target.{k} = source.{k}" for k in self.key)

    def merge(self, target: DataFrame, source: DataFrame) -> DataFrame:
        """Upsert ``source`` into ``target`` on the entity key."""
        return merge_upsert(self.validate(target), self.validate(source), list(self.key))


# The entities of the retail model.
CUSTOMER = EntitySpec("customers", ("customer_id", "first_name", "last_name", "email", "phone",
                                    "registration_date", "loyalty_tier"), ("customer_id",), ("loyalty_tier",))
PRODUCT = EntitySpec("products", ("product_id", "name", "price", "category_id"), ("product_id",), ("category",))
ORDER = EntitySpec("orders", ("order_id", "customer_id", "total_amount", "order_date"), ("order_id",),
                   ("year", "month"))

"""Market-basket operators: baskets, FP-Growth rules, pair rules and
co-purchase top-N.

Pair counting is bounded per basket: only *frequent* items (support ≥
``min_support``) can appear in a frequent pair, and there are at most
(average distinct items per basket) / min_support of them, so a basket
contributes at most that many squared pairs whatever its own size — a huge
basket cannot blow the pair table up.  The frequent-item table is joined
like any other (AQE broadcasts it from its measured size).
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.operators.aggregates import order_baskets
from tillpoint.session import cut_lineage


def association_rules(lines: DataFrame, min_support: float = 0.01, min_confidence: float = 0.5,
                      order_col: str = "order_id", item_col: str = "product_id") -> DataFrame:
    """FP-Growth rules (antecedent, consequent, confidence, lift, support)."""
    baskets = order_baskets(lines, order_col, item_col)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    return model.associationRules


def _frequent_pairs(lines: DataFrame, min_support: float, order_col: str, item_col: str):
    items = lines.select(F.col(order_col).alias("o"), F.col(item_col).alias("i")).distinct()
    n_orders = items.select("o").distinct().count()
    min_count = min_support * n_orders
    freq = items.groupBy("i").agg(F.count(F.lit(1)).alias("n_i")).filter(F.col("n_i") >= F.lit(min_count))
    # |freq| <= (distinct items per basket on average) / min_support
    kept = cut_lineage(items.join(freq, "i"))          # self-joined below: materialise once
    half = _half_pairs(kept.select("o", "i")).join(freq.toDF("a", "n_a"), "a").join(freq.toDF("b", "n_b"), "b")
    return _mirrored(half), n_orders, min_count


def _half_pairs(items: DataFrame) -> DataFrame:
    """(a, b, n_ab) with a < b: each pair of an order is counted once."""
    a, b = items.select("o", F.col("i").alias("a")), items.select("o", F.col("i").alias("b"))
    return a.join(b, "o").filter(F.col("a") < F.col("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_ab"))


def _mirrored(half: DataFrame) -> DataFrame:
    """Both directions of counted pairs (columns that end in _a and _b swap)."""
    cols = half.columns
    swap = {"a": "b", "b": "a", "n_a": "n_b", "n_b": "n_a"}
    return half.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("turned")).select(
        *[F.when(F.col("turned"), F.col(swap[c])).otherwise(F.col(c)).alias(c) if c in swap else F.col(c) for c in cols])


def pair_rules(lines: DataFrame, min_support: float = 0.01, min_confidence: float = 0.5,
               order_col: str = "order_id", item_col: str = "product_id") -> DataFrame:
    """Single-item rules a → b with support(a ∪ b) ≥ min_support and
    confidence ≥ min_confidence (the 1 → 1 rules FP-Growth would report)."""
    pairs, n, min_count = _frequent_pairs(lines, min_support, order_col, item_col)
    return (pairs.filter(F.col("n_ab") >= F.lit(min_count))
            .select(F.col("a").alias("antecedent"), F.col("b").alias("consequent"),
                    (F.col("n_ab") / F.col("n_a")).alias("confidence"),
                    (F.col("n_ab") * F.lit(float(n)) / (F.col("n_a") * F.col("n_b"))).alias("lift"),
                    (F.col("n_ab") / F.lit(float(n))).alias("support"))
            .filter(F.col("confidence") >= min_confidence))


def copurchase_topn(lines: DataFrame, n: int = 5,
                    order_col: str = "order_id", item_col: str = "product_id") -> DataFrame:
    """For each item, the ``n`` items most often bought in the same order
    (ties by item), with the co-purchase count.  Every item counts, however
    rare; the work follows the squares of the orders' distinct items."""
    items = cut_lineage(lines.select(F.col(order_col).alias("o"), F.col(item_col).alias("i")).distinct())
    pairs = _mirrored(_half_pairs(items))
    w = Window.partitionBy("a").orderBy(F.col("n_ab").desc(), F.col("b"))
    return (pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
            .select(F.col("a").alias("item"), F.col("b").alias("co_item"),
                    F.col("n_ab").alias("co_orders"), "rank"))

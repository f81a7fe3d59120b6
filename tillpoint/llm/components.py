"""Connected components by alternating large and small stars.

Every round turns each node's edges to its smallest neighbour; the number of
rounds follows the logarithm of the longest chain.  A node's neighbours never
meet in one task: the smallest is a combined minimum per node, joined back to
the edges, and a hot node's side of that join may be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.session import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: link larger neighbours to the smallest of (node, neighbours).  Small star: link the
    node and its smaller neighbours to the smallest neighbour."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("lu"), F.least("u", "m").alias("m"))
        pairs = both.filter("v > u").join(low, F.col("u") == F.col("lu")).select(F.col("v").alias("b"), F.col("m").alias("a"))
    else:
        down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "lu")
        hung = down.join(low, F.col("u") == F.col("lu")).select(F.col("v").alias("b"), F.col("m").alias("a"))
        pairs = hung.union(low.select(F.col("lu").alias("b"), F.col("m").alias("a")))
    return pairs.filter("a <> b").select("a", "b").distinct()


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label): label is the smallest node reachable, for every node that has an edge.

    ``edges``: columns a and b of one orderable type; self-loops, repeats and
    both directions are fine; no edges give an empty table.
    """
    edges = cut_lineage(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    state = None
    for _ in range(most_rounds):
        edges = cut_lineage(_star(_star(edges, True), False))
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state or not now[0]:
            break
        state = now
    else:
        raise RuntimeError(f"components didn't settle in {most_rounds} rounds")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("label"))).distinct()

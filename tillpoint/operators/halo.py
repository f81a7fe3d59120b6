"""Window frames of a bounded distance on a range-split layout.

A frame between two offsets needs only rows near the current one.  Rows are
range-partitioned by (keys, order value), so a hot key spans many ranges, and
written once.  Rows that lie within a frame's distance of another range of the
same key are copied into it (the *halo*).  Every range then holds whole frames
for its own rows, an ordinary window computes any aggregate inside it, and the
copies are dropped.  Only keys that span ranges have copies; what is known about
them is one row per range and key at a boundary, so it may be broadcast.

Frames in rows (k before, m after) are the same thing over exact row numbers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType

from tillpoint.operators.sequencing import split_window
from tillpoint.session import scratch_path


def halo_window(df: DataFrame, keys: Sequence[str], order: str, start, end, outputs: Mapping[str, Column],
                descending: bool = False, partitions: int | None = None) -> DataFrame:
    """``df`` with ``outputs`` ({name: aggregate}), each over the rows of the same keys whose ``order`` value lies
    between ``start`` before and ``end`` after the current one (RANGE BETWEEN; numbers, or days for a date).

    Any aggregate that Spark takes over a window will do.  Both offsets are bounded; negative ones precede.
    Rows with a null order value are each other's frame, as in SQL; null keys are one group.
    """
    kind = df.schema[order].dataType
    if not isinstance(kind, (NumericType, DateType)):
        raise ValueError(f"{order} must be a number or a date")
    if start > end:
        raise ValueError("a frame must start before it ends")
    spark = df.sparkSession
    value = F.unix_date(order) if isinstance(kind, DateType) else F.col(order)
    before, after = (-end, -start) if descending else (start, end)      # the frame of v holds the values v + before .. v + after
    by = [*[F.col(k) for k in keys], F.col(order)]
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    path = scratch_path(spark, "halo")
    # written once: the bounds of a range exchange are drawn anew each time it runs
    ranged.select("*", F.spark_partition_id().alias("_hw_pid"), value.alias("_hw_v")).write.parquet(path)
    rows = spark.read.parquet(path)
    spans = rows.filter("_hw_v is not null").groupBy(*keys, "_hw_pid").agg(F.min("_hw_v").alias("lo"), F.max("_hw_v").alias("hi"))
    # a key in two ranges or more stands at a boundary, so there are fewer of them than ranges
    split = spans.groupBy(*[F.col(k).alias(f"_hw_k{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("n"), F.collect_list(F.struct(F.col("_hw_pid").alias("pid"), "lo", "hi")).alias("_hw_spans")).filter("n > 1").drop("n")
    same = [F.col(k).eqNullSafe(F.col(f"_hw_k{i}")) for i, k in enumerate(keys)]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    at_edge = rows.join(F.broadcast(split), cond)
    # the row is in the frame of every v' with v' + before <= v <= v' + after
    needed = F.filter("_hw_spans", lambda s: (s["pid"] != F.col("_hw_pid")) & (s["lo"] <= F.col("_hw_v") - before) & (s["hi"] >= F.col("_hw_v") - after))
    copies = at_edge.withColumn("_hw_to", F.explode(F.transform(needed, lambda s: s["pid"])))
    columns = [F.col(f"`{c}`") for c in df.columns]
    everything = rows.select(*columns, "_hw_v", F.col("_hw_pid").alias("_hw_at"), F.lit(True).alias("_hw_own")).union(
        copies.select(*columns, "_hw_v", "_hw_to", F.lit(False)))
    w = Window.partitionBy("_hw_at", *keys).orderBy(F.col("_hw_v").desc() if descending else F.col("_hw_v")).rangeBetween(start, end)
    made = everything.select(*columns, "_hw_own", *[agg.over(w).alias(name) for name, agg in outputs.items()])
    return made.filter("_hw_own").drop("_hw_own")


def halo_rows_window(df: DataFrame, keys: Sequence[str], ordering: Sequence[Column], start: int, end: int,
                     outputs: Mapping[str, Column], partitions: int | None = None) -> DataFrame:
    """``df`` with ``outputs``, each over the rows from ``start`` to ``end`` places of the current one in its group
    (ROWS BETWEEN; a total ordering).  A frame may look back, ahead or both ways."""
    numbered = split_window(df, keys, ordering, [("row_number", "_hw_rn")], partitions=partitions)
    return halo_window(numbered, keys, "_hw_rn", start, end, outputs, partitions=partitions).drop("_hw_rn")

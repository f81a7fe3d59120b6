"""Halo windows against plain windows: hot keys, nulls, ties, both directions, task sizes."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillpoint.operators import halo as H
from tillpoint.operators.transforms import apply_transformations


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(6)
    out = []
    for i in range(900):
        hot = pick.random() < 0.5
        out.append((i, 7 if hot else pick.choice([None, *range(40)]), None if i % 53 == 0 else pick.randrange(60), round(pick.uniform(0, 9), 2)))
    return spark.createDataFrame(out, "id long, k int, v int, x double").repartition(5).cache()


def same(a, b):
    key = lambda r: tuple((x is not None, round(x, 9) if isinstance(x, float) else x) for x in r)
    return sorted(map(key, a.collect()), key=repr) == sorted(map(key, b.collect()), key=repr)


AGGS = {"s": "sum(x)", "n": "count(*)", "m": "min(v)", "a": "avg(x)", "d": "size(collect_set(id))"}


@pytest.mark.parametrize("start,end", [(-3, 0), (-5, 5), (2, 4), (-9, -2), (0, 0), (-200, 200)])
@pytest.mark.parametrize("descending", [False, True])
def test_range_frames(spark, rows, start, end, descending):
    w = Window.partitionBy("k").orderBy(F.col("v").desc() if descending else F.col("v")).rangeBetween(start, end)
    aggs = {n: f for n, f in AGGS.items() if n != "d"}
    got = H.halo_window(rows, ["k"], "v", start, end, {n: F.expr(f) for n, f in aggs.items()}, descending, partitions=9)
    want = rows.select("*", *[F.expr(f).over(w).alias(n) for n, f in aggs.items()])
    assert got.columns == want.columns and same(got, want)


@pytest.mark.parametrize("start,end", [(1, 3), (-2, 2), (-1, 0), (-70, 70), (-3, -2)])
def test_row_frames(spark, rows, start, end):
    order = [F.col("v"), F.col("id")]
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(start, end)
    got = H.halo_rows_window(rows, ["k"], order, start, end, {"s": F.sum("x"), "l": F.collect_list("id")}, partitions=9)
    want = rows.select("*", F.sum("x").over(w).alias("s"), F.collect_list("id").over(w).alias("l"))
    assert same(got, want)


def test_a_hot_key_spreads_over_ranges(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), (F.col("id") % 997).alias("v"))
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        w = Window.partitionBy("k").orderBy("v").rangeBetween(-5, 5)
        out, plain = H.halo_window(df, ["k"], "v", -5, 5, {"n": F.count("*")}, partitions=20), df.select("*", F.count("*").over(w).alias("n"))
        assert same(out, plain)
        largest = lambda x: max(r["c"] for r in x.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("c"), F.sum("n")).collect())
        assert largest(plain) >= 2000 and largest(out) < 600       # half of the rows in one task, against a few ranges' worth
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_dates_refusals_and_empty_tables(spark):
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(1, day + dt.timedelta(days=i // 2), i) for i in range(40)], "k int, d date, x int")
    w = Window.partitionBy("k").orderBy(F.unix_date("d")).rangeBetween(-7, 0)
    assert same(H.halo_window(df, ["k"], "d", -7, 0, {"s": F.sum("x")}, partitions=5), df.select("*", F.sum("x").over(w).alias("s")))
    assert H.halo_window(df.limit(0), ["k"], "d", -7, 0, {"s": F.sum("x")}).count() == 0
    with pytest.raises(ValueError):
        H.halo_window(df, ["k"], "d", 3, 1, {"s": F.sum("x")})
    with pytest.raises(ValueError):
        H.halo_window(df.withColumn("s", F.lit("a")), ["k"], "s", -1, 1, {"n": F.count("*")})


@pytest.mark.parametrize("function,frame", [
    ("avg(x)", {"kind": "range", "start": -3, "end": 3}), ("avg(x)", {"start": "unboundedPreceding", "end": "currentRow"}), ("avg(v)", None),
    ("max(x)", {"start": -1, "end": 4}), ("stddev(x)", {"kind": "range", "start": -10, "end": -1}), ("avg(x)", {"start": "unboundedPreceding", "end": 2})])
def test_declared_steps_equal_plain_windows(spark, rows, function, frame):
    order = ["v"] if frame and frame.get("kind") == "range" or frame is None else ["v", "id"]
    step = {"type": "window", "column_name": "w", "function": function, "window_spec": {"partition_by": "k", "order_by": order} | ({"frame": frame} if frame else {})}
    got, want = apply_transformations(rows, [step]), apply_transformations(rows, [dict(step, skew_safe=False)])
    assert got.dtypes == want.dtypes and same(got, want)

"""Inputs that used to lose, double or abort data."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillpoint.operators import experiments, features, forecast, history, ml, products, recommend, transforms
from tillpoint.operators.sequencing import split_window
from tillpoint.sinks import tables as K
from tillpoint.sources.entities import CUSTOMER
from tillpoint.streaming import clickstream as CS


def test_overwrite_drops_emptied_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    K.write_table(spark.createDataFrame([(1, "gold"), (2, "silver")], "id int, tier string"), path, partition_by=["tier"])
    K.write_table(spark.createDataFrame([(1, "silver"), (2, "silver")], "id int, tier string"), path, partition_by=["tier"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "silver"), (2, "silver")]


def test_schema_guard_holds_for_partitioned_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    K.write_table(spark.createDataFrame([(1, 2024)], "id int, year int"), path, partition_by=["year"])
    with pytest.raises(ValueError):
        K.write_table(spark.createDataFrame([(1, 2024)], "other int, year int"), path, partition_by=["year"])
    K.write_table(spark.createDataFrame([(2, 2025)], "id int, year int"), path, partition_by=["year"])


def test_merge_refuses_duplicate_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError):
        history.merge_upsert(target, spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"), "k")
    nulls = spark.createDataFrame([(None, "x"), (None, "y")], "k int, v string")
    assert history.merge_upsert(target, nulls, "k").count() == 3


def test_missing_required_column_raises(spark):
    with pytest.raises(ValueError):
        CUSTOMER.validate(spark.createDataFrame([(1,)], "customer_id int"))
    with pytest.raises(ValueError):
        products.product_hierarchy(spark.createDataFrame([(1,)], "product_id int"), spark.createDataFrame([(1,)], "category_id int"))


def test_products_without_sales_stay(spark):
    sales = spark.createDataFrame([(1, 2, 10.0, 7)], "product_id long, quantity long, revenue double, order_id long")
    items = spark.createDataFrame([(1, "a", "c"), (2, "b", "c"), (3, "d", "e")], "product_id long, name string, category string")
    got = {r["product_id"]: r for r in products.product_performance(sales, items).collect()}
    assert sorted(got) == [1, 2, 3] and got[2]["revenue"] == 0 and got[2]["revenue_rank"] == 2 and got[3]["avg_unit_price"] is None


def test_customers_without_orders_get_features(spark):
    customers = spark.createDataFrame([(1, 5.0, "m", "t"), (2, 6.0, "m", "t")], "customer_id long, account_balance double, market_segment string, loyalty_tier string")
    orders = spark.createDataFrame([(1, 3.0, dt.datetime(2024, 1, 1))], "customer_id long, total_amount double, order_date timestamp")
    got = {r["customer_id"]: r for r in features.customer_order_features(customers, orders, dt.datetime(2024, 2, 1)).collect()}
    assert got[2]["order_count"] == 0 and got[2]["is_churned"] and not got[1]["is_churned"]


def test_segments_keep_rows_with_missing_features(spark):
    df = spark.createDataFrame([(i, float(i % 7), None if i % 3 == 0 else float(i)) for i in range(30)], "id int, a double, b double")
    out, _ = ml.segment_customers(df, ["a", "b"], k=2)
    got = {r["id"]: r["segment"] for r in out.select("id", "segment").collect()}
    assert len(got) == 30 and all((got[i] is None) == (i % 3 == 0) for i in got)


def test_constant_series_gives_nulls_and_spares_the_others(spark):
    rows = [(1, dt.date(2024, 1, 1) + dt.timedelta(i), 5.0) for i in range(12)]
    rows += [(2, dt.date(2024, 1, 1) + dt.timedelta(i), float((i * i) % 11)) for i in range(12)]
    rows += [(3, dt.date(2024, 1, 1), 1.0)]
    got = forecast.arima111_forecast(spark.createDataFrame(rows, "product_id int, date date, sales double"), steps=2).collect()
    assert {r["product_id"]: r["forecast"] is None for r in got} == {1: True, 2: False, 3: True}


def test_no_conversions_and_constant_columns(spark):
    df = spark.createDataFrame([("a", False), ("a", False), ("b", False)], "variant string, converted boolean")
    r = experiments.chi_square_test(df).first()
    assert r["chi_square"] is None and r["is_significant"] is None
    assert features.standardize(spark.createDataFrame([(1.0,), (1.0,)], "x double"), ["x"]).first()["x_z"] is None


def test_rare_items_have_co_items(spark):
    lines = [(o, i) for o in range(300) for i in (1, 2)] + [(999, 7), (999, 8), (999, 8)]
    got = recommend.copurchase_topn(spark.createDataFrame(lines, "order_id long, product_id long")).collect()
    assert sorted((r["item"], r["co_item"], r["co_orders"]) for r in got) == [(1, 2, 300), (2, 1, 300), (7, 8, 1), (8, 7, 1)]


def test_join_without_equality_needs_consent(spark):
    df = spark.range(3)
    for cond in ("1=1", "l.id > r.id", None):
        with pytest.raises(ValueError):
            transforms.apply_transformations(df, [{"type": "join", "join_with": "o", "condition": cond}], join_dfs={"o": df})
    step = {"type": "join", "join_with": "o", "condition": "l.id = r.id"}
    assert transforms.apply_transformations(df, [step], join_dfs={"o": df}).count() == 3


@pytest.mark.parametrize("function", ["row_number()", "sum(money)", "sum(n)", "count(n)", "lag(money)", "lag(money, 3)", "lead(n, 40)"])
@pytest.mark.parametrize("frame", [None, {"start": -2, "end": 0}, {"start": -1500, "end": 0}])
def test_split_windows_have_the_plain_type_and_value(spark, function, frame):
    if frame and not function.startswith(("sum", "count")):
        return
    rows = [(1 if i % 3 else 2, i, decimal.Decimal(i) / 4 if i % 5 else None, 2_000_000_000 if i % 7 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, t int, money decimal(10,2), n int")
    spec = {"partition_by": ["k"], "order_by": ["t"]} | ({"frame": frame} if frame else {})
    step = {"type": "window", "column_name": "w", "function": function, "window_spec": spec}
    split = transforms.apply_transformations(df, [step])
    plain = transforms.apply_transformations(df, [step | {"skew_safe": False}])
    assert split.schema["w"].dataType == plain.schema["w"].dataType
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, plain.collect()))


def test_one_key_over_many_ranges(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("t"), (F.col("id") % 13).alias("v"))
    outputs = [("row_number", "n"), ("lag", "a", "v"), ("lead", "b", "v"), ("running_sum", "s", "v"), ("moving_sum", "m", "v", 45),
               ("lag", "a50", "v", 50), ("lead", "b50", "v", 50), ("lag", "a9", "v", 9999)]
    w = Window.partitionBy("k").orderBy("t")
    want = df.select("t", F.row_number().over(w).alias("n"), F.lag("v").over(w).alias("a"), F.lead("v").over(w).alias("b"),
                     F.sum("v").over(w).alias("s"), F.sum("v").over(w.rowsBetween(-45, 0)).alias("m"),
                     F.lag("v", 50).over(w).alias("a50"), F.lead("v", 50).over(w).alias("b50"), F.lag("v", 9999).over(w).alias("a9"))
    got = split_window(df, ["k"], [F.col("t")], outputs, partitions=200).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_chained_distinct_refuses_update_mode(spark):
    with pytest.raises(ValueError):
        CS.clickstream_aggregates(spark.range(1), distinct="chained")


def test_default_stream_starts_in_update_mode(spark, tmp_path):
    events = spark.createDataFrame([(f"2024-01-01 00:00:0{i}", 1, "p", i % 2) for i in range(4)], CS.CLICKSTREAM_SCHEMA)
    events.write.parquet(str(tmp_path / "in"))
    stream = CS.file_stream(spark, str(tmp_path / "in"), "*.parquet", CS.CLICKSTREAM_SCHEMA)
    CS.run_update_to_table(CS.clickstream_aggregates(stream), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = CS.latest_updates(spark.read.parquet(str(tmp_path / "out")), ["window_start", "window_end", "user_id", "page_category"])
    assert [(r["page_views"], r["unique_products_viewed"]) for r in got.collect()] == [(4, 2), (4, 2)]

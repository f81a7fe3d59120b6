"""Logical retail inputs as lazy views over the benchmark tables.

The operators of this package read business-shaped frames (customers, orders,
products, sales, ...).  The benchmark ships TPC-H-like tables instead, so each
logical input is a narrow projection (plus, where needed, one equi-join) over
those tables.  All views are lazy: Catalyst prunes unused columns down to the
parquet scan and pushes filters into it.  Nothing here samples or caps rows:
every view covers its whole source table.

The derivations are deterministic functions of the keys, so an independent
SQL engine can rebuild the same rows (see ``tillpoint.catalog.oracle``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values shared with the oracle SQL (they define the fixtures).
AS_OF = dt.datetime(2002, 1, 1)             # "now" for the orders world
EVENTS_AS_OF = dt.date(2024, 2, 1)          # "now" for the events world
REGISTRATION_EPOCH = dt.date(1995, 1, 1)
UPDATED_EPOCH = dt.datetime(2001, 1, 1)
CHANGE_EPOCH = dt.datetime(2024, 1, 1)
TIER_BY_SEGMENT = {"AUTOMOBILE": "gold", "BUILDING": "silver", "FURNITURE": "bronze"}
PAYMENT_STATUS_BY_FLAG = {"A": "completed", "R": "failed", "N": "pending"}


def ts_ntz(value: dt.datetime) -> Column:
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def plus_days(ts: Column, days: Column) -> Column:
    return F.timestamp_add("DAY", days, ts)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mapped(col: Column, mapping: dict[str, str], default: str | None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(col == k, v) if out is None else out.when(col == k, v)
    return out.otherwise(F.lit(default))


# --------------------------------------------------------------------------- customers
def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("customer_id"),
        F.concat(F.lit("First"), (k % 50).cast("string")).alias("first_name"),
        F.concat(F.lit("Last"), (k % 70).cast("string")).alias("last_name"),
        F.when(k % 23 == 0, F.lit(None).cast("string"))
        .when(k % 17 == 0, F.lit("bad-email"))
        .otherwise(F.concat(F.lit("user"), k.cast("string"), F.lit("@example.com")))
        .alias("email"),
        F.when(k % 19 == 0, F.lit("12-x"))
        .otherwise(F.concat(F.lit("+1555"), F.lpad(k.cast("string"), 7, "0")))
        .alias("phone"),
        F.date_add(F.lit(REGISTRATION_EPOCH), (k * 7 % 2700).cast("int")).alias("registration_date"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .otherwise(_mapped(F.col("c_mktsegment"), TIER_BY_SEGMENT, "standard"))
        .alias("loyalty_tier"),
        F.create_map(F.lit("nation"), F.col("c_nationkey").cast("string")).alias("address"),
        F.create_map(F.lit("segment"), F.col("c_mktsegment")).alias("demographics"),
        F.create_map(F.lit("segments"), F.array(F.col("c_mktsegment"))).alias("preferences"),
        plus_days(ts_ntz(AS_OF), -(k % 500)).alias("last_activity"),
        plus_days(ts_ntz(UPDATED_EPOCH), k % 365).alias("updated_at"),
        F.col("c_nationkey").alias("nation_key"),
        F.col("c_acctbal").alias("account_balance"),
        F.col("c_mktsegment").alias("market_segment"),
    )


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers plus a second, later version of every tenth customer."""
    base = customers(spark, sf_dir)
    k = F.col("customer_id")
    newer = (base.filter(k % 10 == 0)
             .withColumn("last_name", F.concat(F.lit("Relast"), (k % 70).cast("string")))
             .withColumn("updated_at", plus_days(F.col("updated_at"), F.lit(30))))
    return base.unionByName(newer)


def customer_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("customer_id"),
        ((k * 37 % 1600).cast("double") / 10 - 80).alias("customer_lat"),
        ((k * 91 % 3600).cast("double") / 10 - 180).alias("customer_lon"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        k.alias("store_id"),
        ((k * 53 % 1600).cast("double") / 10 - 80).alias("store_lat"),
        ((k * 71 % 3600).cast("double") / 10 - 180).alias("store_lon"),
    )


def external_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation attributes keyed like customers (``nation_key``)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").alias("nation_key"),
        F.col("n_name").alias("nation_name"),
        F.col("r_name").alias("region_name"),
    )


# --------------------------------------------------------------------------- orders
def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        (F.col("o_totalprice") / 1000.0).alias("total_amount"),
        F.col("o_orderdate").alias("order_date"),
        F.when(k % 29 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(plus_days(F.col("o_orderdate"), k % 10)).alias("shipped_date"),
        (24 * (1 + k % 7)).alias("promised_sla_hours"),
        (k % 7).alias("campaign_id"),
        F.col("o_orderpriority").alias("priority"),
    )


def orders_with_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = orders(spark, sf_dir)
    return o.withColumn(
        "total_amount",
        F.when(F.col("order_id") % 500 == 0, F.col("total_amount") * 20).otherwise(F.col("total_amount")),
    )


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    # every nation is a campaign; the keys of fifteen are shifted, so that no order names them
    k = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.when(k < 10, k).otherwise(k + 100).cast("bigint").alias("campaign_id"),
        F.col("n_name").alias("campaign_name"),
        (F.col("n_nationkey") * 1000).cast("double").alias("cost"),
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned history of the orders table.

    v1 inserts every order, v2 updates every tenth, v3 deletes every
    twenty-fifth; commits are one day apart.
    """
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")

    def version(v: int, op: str, rows: DataFrame, amount: Column, status: Column) -> DataFrame:
        return rows.select(
            k.alias("order_id"), F.lit(v).alias("version"),
            plus_days(ts_ntz(CHANGE_EPOCH), F.lit(v - 1)).alias("commit_ts"),
            F.lit(op).alias("op"), amount.alias("total_amount"), status.alias("order_status"),
            F.col("o_custkey").alias("customer_id"),
        )

    amount = F.col("o_totalprice") / 1000.0
    v1 = version(1, "I", o, amount, F.col("o_orderstatus"))
    v2 = version(2, "U", o.filter(k % 10 == 0), amount * 2, F.lit("U"))
    v3 = version(3, "D", o.filter(k % 25 == 0), F.lit(None).cast("double"), F.lit(None).cast("string"))
    return v1.unionByName(v2).unionByName(v3)


# --------------------------------------------------------------------------- products
def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("product_type"),
        F.col("p_size").alias("category_id"),
        F.concat(F.lit("Cat"), F.col("p_size").cast("string")).alias("category"),
        F.col("p_retailprice").alias("price"),
        F.when(k % 13 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("p_retailprice") * 0.6).alias("cost"),
        (k % 5 != 0).alias("in_stock"),
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("p_size")
    # the keys of sizes over 45 are shifted: products of unknown category, categories without products
    return (table(spark, sf_dir, "part").select(s).distinct().select(
        F.when(s <= 45, s).otherwise(s + 100).alias("category_id"),
        F.concat(F.lit("Cat"), s.cast("string")).alias("category_name"),
        F.concat(F.lit("L1-"), (s % 3).cast("string")).alias("category_level1"),
        F.concat(F.lit("L2-"), (s % 7).cast("string")).alias("category_level2"),
        F.when(s % 4 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("L3-"), s.cast("string"))).alias("category_level3"),
    ))


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        (F.col("p_partkey") % 60).alias("current_stock"),
    )


# --------------------------------------------------------------------------- sales
def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line (product-level facts; no order attributes)."""
    q = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        q.alias("quantity"),
        q.alias("quantity_sold"),
        (F.col("l_extendedprice") / q).alias("price"),
        (F.col("l_extendedprice")).alias("revenue"),
        (1 + q.cast("int") % 5).alias("rating"),
        F.col("l_returnflag").alias("return_flag"),
    )


def sales_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the order's customer and date (lineitem ⋈ orders)."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("date"),
    )
    return sales(spark, sf_dir).join(o, "order_id")


def demand_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic stand-in for a demand model: mean quantity per product."""
    return (table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("product_id"))
            .agg(F.avg("l_quantity").alias("prediction")))


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, product_id) with the part type as item; duplicates kept."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").alias("order_id"), F.col("p_type").alias("product_id"))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("customer_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("payment_id"),
        _mapped(F.col("l_returnflag"), PAYMENT_STATUS_BY_FLAG, None).alias("payment_status"),
        (F.col("l_extendedprice") / 1000.0).alias("amount"),
    )


def sales_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly units per brand: (product_id=brand, date=month start, sales)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return (j.groupBy(F.col("p_brand").alias("product_id"),
                      F.date_trunc("month", F.col("o_orderdate")).alias("date"))
            .agg(F.sum("l_quantity").alias("sales")))


# --------------------------------------------------------------------------- events
def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("customer_id"),
        F.col("event_type").alias("channel"),
        F.col("ts").alias("interaction_date"),
    )


def experiment(spark: SparkSession, sf_dir: str, arms: int = 2) -> DataFrame:
    u = F.col("user_id")
    if arms == 2:
        variant = F.when(u % 2 == 0, F.lit("A")).otherwise(F.lit("B"))
    else:
        variant = F.concat(F.lit("V"), (u % arms).cast("string"))
    return table(spark, sf_dir, "events").select(
        u, variant.alias("variant"), (F.col("event_type") == "purchase").alias("converted"))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("customer_id"),
        (F.col("user_id") * 10 + F.col("event_id") % 3).alias("device_id"),
        F.col("event_type").alias("device_type"),
    )


def clickstream_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clickstream as a static frame (same columns as the stream)."""
    return clickstream_shape(table(spark, sf_dir, "events"))


def clickstream_shape(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").cast("string").alias("event_timestamp"),
        F.col("user_id"),
        F.col("event_type").alias("page_category"),
        (F.col("event_id") % 200).alias("product_id"),
    )

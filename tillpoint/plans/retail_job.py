"""The batch retail job: extract → transform → enrich → load → export.

``run_retail_job`` is a function of frames: callers pass the source frames
(any lazily scanned tables), an output folder on shared storage and the run
date.  Stage order follows the original job:

1. extract — customers updated up to the run date;
2. transform — clean + validate customers in one tagged pass (written once
   to the shared checkpoint folder because three outputs read it), rejected
   rows added to a quarantine table under the run's date (dynamic partition
   overwrite, so a retried run does not duplicate them); order timelines;
3. enrich — lifetime value, product performance, activity flags and value
   segment;
4. load — customers partitioned by (loyalty_tier, value_segment), products by
   category, orders as a catalog table partitioned by (year, month) with
   table properties; lifetime value as a plain table;
5. export — customers as snappy parquet partitioned by loyalty tier, and,
   when a JDBC URL is given, products (overwrite) and orders (append) to the
   warehouse with 100 000-row batches and 4 000-character strings;
6. model run — where payments and sessions are given, the customer dimension
   over the valid customers, merged into that of the last run.

Returns the loaded tables, read back from storage.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.operators import customers as C
from tillpoint.operators import orders as O
from tillpoint.operators import products as P
from tillpoint.plans.dim_customers import dim_customers, incremental_dim_customers
from tillpoint.session import cut_lineage
from tillpoint.sinks import jdbc as J
from tillpoint.sinks import tables as K

# Warehouse export options of the pipeline.
WAREHOUSE_OPTIONS = {"maxStrLength": "4000", "batchSize": "100000"}
ORDER_TABLE_PROPERTIES = {"change_feed": "true", "optimize_write": "true"}


def run_retail_job(spark: SparkSession, sources: Mapping[str, DataFrame], out_dir: str, as_of: dt.datetime,
                 jdbc_url: str | None = None, database: str = "ecom_retail",
                 orders_table: str = "orders") -> dict[str, DataFrame]:
    as_of_col = C._lit_ts(as_of)
    # 1. extract
    raw_customers = sources["customers"].filter(F.col("updated_at") <= as_of_col)
    products, orders, sales = sources["products"], sources["orders"], sources["sales"]

    # 2. transform
    tagged = cut_lineage(C.tag_customers(raw_customers, as_of))
    valid = tagged.filter("is_valid").drop("is_valid")
    invalid = tagged.filter(~F.col("is_valid")).drop("is_valid")
    # rejected rows land in this run's partition; a re-run of the same date
    # replaces that partition instead of appending the rows twice
    rejected = invalid.withColumn("run_date", F.lit(as_of.date() if isinstance(as_of, dt.datetime) else as_of))
    K.write_table(rejected, f"{out_dir}/staging/invalid_customers", "overwrite", partition_by=["run_date"],
                  dynamic_partitions=True)
    orders_t = O.order_timelines(orders).withColumns({"year": F.year("order_date"), "month": F.month("order_date")})

    # 3. enrich
    clv = C.customer_lifetime_value(orders, valid)
    performance = P.product_performance(sales, products)
    segmented = C.activity_segments(
        valid.join(clv.select("customer_id", F.col("clv_segment").alias("value_segment")), "customer_id", "left"),
        as_of)

    # 4. load
    K.write_table(segmented, f"{out_dir}/processed/customers", "overwrite",
                  partition_by=["loyalty_tier", "value_segment"])
    K.write_table(performance, f"{out_dir}/processed/products", "overwrite", partition_by=["category"])
    K.write_table(clv, f"{out_dir}/processed/customer_lifetime_value", "overwrite")
    orders_table = K.create_table(orders_t, orders_table, database=database, path=f"{out_dir}/processed/orders",
                                  partition_by=["year", "month"], properties=ORDER_TABLE_PROPERTIES,
                                  overwrite=True)

    # 5. export
    K.export_parquet(segmented, f"{out_dir}/export/customers", partition_by=["loyalty_tier"], compression="snappy")
    if jdbc_url:
        J.write_jdbc(performance, jdbc_url, "dim_products", "overwrite", WAREHOUSE_OPTIONS)
        J.write_jdbc(orders_t, jdbc_url, "fact_orders", "append", WAREHOUSE_OPTIONS)

    # 6. model run: the customer dimension over what was loaded, merged into the one of the last run
    model = {}
    if "payments" in sources and "sessions" in sources:
        path, facts = f"{out_dir}/processed/dim_customers", (orders, sources["payments"], sources["sessions"])
        target = K.read_if_any(spark, path)
        if target is None:
            dimension = dim_customers(valid, *facts, as_of)
        else:   # read and replaced in one run, so the merge is written aside first
            dimension = cut_lineage(incremental_dim_customers(target, valid, *facts, as_of))
        K.write_table(dimension, path, "overwrite")
        model["dim_customers"] = dimension

    def back(df: DataFrame, path: str) -> DataFrame:
        # with the written schema: a table without rows has no file to infer one from
        return spark.read.schema(df.schema).parquet(f"{out_dir}/{path}")

    return {
        "customers": back(segmented, "processed/customers"),
        "products": back(performance, "processed/products"),
        "orders": spark.table(orders_table),
        "customer_lifetime_value": back(clv, "processed/customer_lifetime_value"),
        "invalid_customers": back(rejected, "staging/invalid_customers"),
    } | {name: back(df, f"processed/{name}") for name, df in model.items()}

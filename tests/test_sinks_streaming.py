"""Sinks, table lifecycle side effects and streaming behaviour."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from tillpoint.session import scratch_path
from tillpoint.sinks import jdbc as J
from tillpoint.sinks import tables as K
from tillpoint.streaming import clickstream as CS

from .conftest import SF_SMALL


def _orders(spark):
    from tillpoint.sources import fixtures as fx
    return fx.orders(spark, SF_SMALL)


def test_overwrite_schema_guard(spark):
    path = scratch_path(spark, "guard")
    df = spark.range(5)
    K.write_table(df, path)
    with pytest.raises(ValueError):
        K.write_table(df.withColumn("x", F.lit(1)), path)
    K.write_table(df.withColumn("x", F.lit(1)), path, overwrite_schema=True)
    assert spark.read.parquet(path).columns == ["id", "x"]


def test_unknown_write_mode(spark):
    with pytest.raises(ValueError):
        K.write_table(spark.range(1), scratch_path(spark, "m"), mode="merge")


def test_compaction_reduces_files(spark):
    src, dst = scratch_path(spark, "frag"), scratch_path(spark, "comp")
    _orders(spark).repartition(12).write.parquet(src)
    K.compact(spark, src, dst, files=1)
    n = lambda p: len(glob.glob(os.path.join(p, "*.parquet")))
    assert n(dst) < n(src)
    assert spark.read.parquet(dst).count() == spark.read.parquet(src).count()


def test_create_table_properties_and_replace(spark):
    df = _orders(spark).withColumn("year", F.year("order_date"))
    name = K.create_table(df, "props_t", database="tp_test", path=scratch_path(spark, "props"),
                          partition_by=["year"], properties={"quality": "gold"}, comment="c", overwrite=True)
    K.set_table_properties(spark, name, {"retention_hours": "168"})
    props = K.table_properties(spark, name)
    assert props["quality"] == "gold" and props["retention_hours"] == "168"
    assert spark.table(name).columns[-1] == "year"
    name2 = K.create_table(df.filter("year = 1996"), "props_t", database="tp_test",
                           path=scratch_path(spark, "props2"), partition_by=["year"], overwrite=True)
    assert spark.table(name2).select("year").distinct().collect()[0].year == 1996


def test_jdbc_write_options_caller_wins(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "id long, name string, v double")
    opts = J.write_options(df, "jdbc:x", "t", {"maxStrLength": "4000", "batchSize": "5000", "isolationLevel": "NONE"})
    assert opts["batchsize"] == "5000"
    assert opts["createTableColumnTypes"] == "name VARCHAR(4000)"
    assert opts["isolationLevel"] == "NONE" and opts["dbtable"] == "t"
    with pytest.raises(ValueError):
        J.read_jdbc(spark, "jdbc:x")


def test_kafka_writer_is_built_unstarted(spark):
    schema = CS.CLICKSTREAM_SCHEMA
    d = scratch_path(spark, "kin")
    spark.createDataFrame([], schema).write.parquet(d)
    stream = spark.readStream.schema(schema).parquet(d)
    agg = CS.clickstream_aggregates(stream, distinct="set")
    w = CS.create_kafka_sink(CS.flatten_window(agg), {"bootstrap_servers": "b:9092", "topic": "t",
                                                        "checkpoint_location": scratch_path(spark, "kck")})
    assert w is not None


def test_stream_matches_batch_and_drops_late_rows(spark):
    """Set and chained distinct agree; a late file changes nothing."""
    from tillpoint.sources import fixtures as fx

    events = fx.table(spark, SF_SMALL, "events")
    inbox = scratch_path(spark, "inbox")
    events.write.parquet(f"{inbox}/b=1")
    schema = events.schema

    def run(distinct, out, ck):
        s = CS.events_as_clickstream(spark.readStream.schema(schema).option("recursiveFileLookup", "true")
                                     .parquet(inbox))
        CS.run_to_parquet(CS.clickstream_aggregates(s, distinct=distinct, output_mode="append"), out, ck)
        return sorted(tuple(r) for r in CS.flatten_window(spark.read.parquet(out)).collect())

    out1, ck1 = CS.scratch(spark, "s1")
    out2, ck2 = CS.scratch(spark, "s2")
    first = run("chained", out1, ck1)
    assert first == run("set", out2, ck2)
    t0 = events.agg(F.min("ts")).collect()[0][0]
    events.filter(F.col("ts") < t0 + dt.timedelta(hours=2)).write.parquet(f"{inbox}/b=2")
    assert run("chained", out1, ck1) == first


def test_retail_job_rerun_does_not_duplicate_quarantine(spark):
    from tillpoint.operators import customers as C
    from tillpoint.plans.retail_job import run_retail_job
    from tillpoint.sources import fixtures as fx

    sources = {"customers": C.scalar_columns(fx.customers_raw(spark, SF_SMALL)),
               "products": fx.products(spark, SF_SMALL), "orders": fx.orders(spark, SF_SMALL),
               "sales": fx.sales(spark, SF_SMALL)}
    out = scratch_path(spark, "pipe")
    first = run_retail_job(spark, sources, out, fx.AS_OF, orders_table="o1")["invalid_customers"].count()
    again = run_retail_job(spark, sources, out, fx.AS_OF, orders_table="o2")["invalid_customers"].count()
    assert first == again > 0

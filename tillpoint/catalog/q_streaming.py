"""Streaming queries: the clickstream job run over the events table as a
file stream (``availableNow``), results read back from the sink."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tillpoint.catalog.fixture_sql import with_inputs
from tillpoint.catalog.registry import register
from tillpoint.sources import fixtures as fx
from tillpoint.streaming import clickstream as CS


def _events_stream(spark, directory: str, glob: str = "events*.parquet", max_files: int | None = None):
    schema = spark.read.parquet(f"{directory}/{glob}").schema if glob != "events*.parquet" else \
        fx.table(spark, directory, "events").schema
    return CS.events_as_clickstream(CS.file_stream(spark, directory, glob, schema, max_files))


_WINDOWS = """
select window_start, window_start + interval 60 second as window_end, user_id, page_category,
       count(*) as page_views, count(distinct product_id) as unique_products_viewed
from (select time_bucket(interval 30 second, event_time) as window_start, * from f_clickstream
      union all
      select time_bucket(interval 30 second, event_time) - interval 30 second, * from f_clickstream) w
group by all"""

_APPEND = with_inputs(["f_clickstream"], """
select * from windows
where window_end <= (select max(event_time) from f_clickstream) - interval 5 minute""",
                      ctes=[("windows", _WINDOWS)])


def _append_run(spark, sf, distinct: str):
    out, ckpt = CS.scratch(spark, f"clickstream_{distinct}")
    result = CS.clickstream_aggregates(_events_stream(spark, sf), distinct=distinct, output_mode="append")
    CS.run_to_parquet(result, out, ckpt)
    return CS.flatten_window(spark.read.parquet(out))


@register("clickstream_append", _APPEND)
def q_clickstream_append(spark, sf):
    return _append_run(spark, sf, "chained")


# Fixed value: rows of one file of an inbox; a micro-batch of two files stays of one size whatever the table's.
EVENTS_PER_FILE = 500_000


def bounded_inbox(spark, events, inbox: str, rows_per_file: int = EVENTS_PER_FILE) -> int:
    """The events as files of about ``rows_per_file`` rows, arriving one after the other in time; two files at least.
    Returns their number.

    Dealt by ranges of time once; each range is then its own small append, since a file stream takes files by their age.
    """
    files = max(2, math.ceil(events.count() / rows_per_file))
    ranges = f"{inbox}_ranges"
    events.repartitionByRange(files, "ts").write.parquet(ranges)
    for file in sorted(spark.read.schema(events.schema).parquet(ranges).inputFiles()):      # named by range
        spark.read.schema(events.schema).parquet(file).coalesce(1).write.mode("append").parquet(inbox)
    return files


@register("clickstream_distinct_chained", _APPEND)
def q_clickstream_chained(spark, sf):
    """The chained aggregate over micro-batches of two files' worth."""
    out, ckpt = CS.scratch(spark, "clickstream_chained")
    inbox = f"{out}_inbox"
    bounded_inbox(spark, fx.table(spark, sf, "events"), inbox)
    stream = _events_stream(spark, inbox, "*.parquet", max_files=2)
    CS.run_to_parquet(CS.clickstream_aggregates(stream, distinct="chained", output_mode="append"), out, ckpt)
    return CS.flatten_window(spark.read.parquet(out))


@register("clickstream_update", with_inputs(["f_clickstream"], "select * from windows", ctes=[("windows", _WINDOWS)]))
def q_clickstream_update(spark, sf):
    """Update mode: the last state of every group."""
    out, ckpt = CS.scratch(spark, "clickstream_update")
    CS.run_update_to_table(CS.clickstream_aggregates(_events_stream(spark, sf), distinct="set"), out, ckpt)
    return CS.latest_updates(spark.read.parquet(out), ["window_start", "window_end", "user_id", "page_category"])


@register("clickstream_distinct_approx")
def q_clickstream_approx(spark, sf):
    return _append_run(spark, sf, "approx")


@register("clickstream_complete", with_inputs(["f_clickstream"], "select * from windows",
                                              ctes=[("windows", _WINDOWS)]))
def q_clickstream_complete(spark, sf):
    out, ckpt = CS.scratch(spark, "clickstream_complete")
    result = CS.clickstream_aggregates(_events_stream(spark, sf), distinct="set")
    CS.run_complete_to_table(result, out, ckpt)
    return spark.read.parquet(out)


@register("clickstream_late", _APPEND)
def q_clickstream_late(spark, sf):
    """Two runs from one checkpoint; the second file holds only rows older
    than the watermark, which must not change any emitted window."""
    base_out, ckpt = CS.scratch(spark, "clickstream_late")
    inbox = base_out + "_inbox"
    events = fx.table(spark, sf, "events")
    events.write.mode("overwrite").parquet(f"{inbox}/batch=1")
    schema = StructType([StructField(f.name, f.dataType) for f in events.schema.fields])

    def stream():
        return CS.events_as_clickstream(
            spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(inbox))

    CS.run_to_parquet(CS.clickstream_aggregates(stream(), distinct="chained", output_mode="append"), base_out, ckpt)
    # every event of the first hour, re-sent after the stream has moved on
    first_hour = events.agg(F.min("ts")).scalar() + F.make_dt_interval(F.lit(0), F.lit(1))
    late = events.filter(F.col("ts") < first_hour)
    late.write.mode("overwrite").parquet(f"{inbox}/batch=2")
    CS.run_to_parquet(CS.clickstream_aggregates(stream(), distinct="chained", output_mode="append"), base_out, ckpt)
    return CS.flatten_window(spark.read.parquet(base_out))


@register("kafka_payload", with_inputs(["f_orders"], """
select order_id, customer_id, order_status, total_amount, priority from f_orders"""))
def q_kafka_payload(spark, sf):
    """Rows serialised as the Kafka ``value`` JSON and parsed back."""
    o = fx.orders(spark, sf).select("order_id", "customer_id", "order_status", "total_amount", "priority")
    payload = CS.kafka_payload(o)
    return payload.select(F.from_json("value", o.schema).alias("r")).select("r.*")

"""Streaming queries with state of their own: exact distincts in update mode, panes, the JSON sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillpoint.catalog.fixture_sql import with_inputs
from tillpoint.catalog.q_streaming import _APPEND, _WINDOWS
from tillpoint.catalog.registry import register
from tillpoint.sources import fixtures as fx
from tillpoint.streaming import clickstream as CS
from tillpoint.streaming import panes as P
from tillpoint.streaming import payload_sink as L
from tillpoint.streaming import stateful as S

ROW_GROUP = 8 << 20      # a batch is one file; its tasks share it by row groups
WINDOW_KEYS = ["window_start", "window_end", "user_id", "page_category"]


def inbox_in_time_order(spark, sf, name: str):
    """The events table as three files, one after the other in time: a stream of three batches."""
    events = fx.table(spark, sf, "events")
    out, ckpt = CS.scratch(spark, name)
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    inbox = f"{out}_inbox"
    for k in range(3):
        start, end = lo + (hi - lo) * k / 3, lo + (hi - lo) * (k + 1) / 3
        part = events.filter((F.col("ts") >= start) if k == 2 else (F.col("ts") >= start) & (F.col("ts") < end))
        part.coalesce(1).write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(inbox)
    stream = CS.events_as_clickstream(CS.file_stream(spark, inbox, "*.parquet", events.schema, 1))
    return stream, out, ckpt


@register("clickstream_distinct_stateful", with_inputs(["f_clickstream"], "select * from windows", ctes=[("windows", _WINDOWS)]))
def q_clickstream_distinct_stateful(spark, sf):
    """Update mode over three batches: the last state of every window, with exact distinct products."""
    stream, out, ckpt = inbox_in_time_order(spark, sf, "clickstream_stateful")
    S.run_stateful(S.stateful_distinct(stream), out, ckpt)
    return CS.latest_updates(spark.read.parquet(out), WINDOW_KEYS)


@register("clickstream_panes", _APPEND)
def q_clickstream_panes(spark, sf):
    """Windows merged from panes, over three batches; these windows hold few products, so the sketches are exact."""
    stream, out, ckpt = inbox_in_time_order(spark, sf, "clickstream_panes")
    CS.run_to_parquet(P.pane_aggregates(stream).drop("panes"), out, ckpt)
    return CS.flatten_window(spark.read.parquet(out))


@register("stream_payload_sink", with_inputs(["f_orders"], """
select order_id, customer_id, order_status, total_amount, priority from f_orders"""))
def q_stream_payload_sink(spark, sf):
    """Orders as a stream of JSON payloads into the sink, epoch by epoch, and parsed back from what was committed."""
    orders = fx.orders(spark, sf).select("order_id", "customer_id", "order_status", "total_amount", "priority")
    path, ckpt = CS.scratch(spark, "payload_log")
    inbox = f"{path}_inbox"
    orders.repartition(3, "order_id").write.parquet(inbox)
    stream = CS.file_stream(spark, inbox, "*.parquet", orders.schema, 1)
    L.run_to_payload_log(CS.kafka_payload(stream), path, ckpt)
    return L.read_payload_log(spark, path).select(F.from_json("value", orders.schema).alias("r")).select("r.*")

"""Sliding windows from panes.

``F.window`` with a slide copies every event into each window that covers it,
before any state: a one-hour window sliding by a minute makes sixty rows of one.
Here an event goes into one pane (the greatest common length of window and
slide), where it is counted and its product enters a HyperLogLog sketch; when a
pane closes, its one row goes into the windows that cover it and sketches
merge.  State holds each event once, and overlapping windows cost a row per
pane instead of a row per event.  Page views are exact, distinct products are
the merged sketch's estimate (exact for a few products).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.streaming.clickstream import SLIDE, WATERMARK, WINDOW, with_event_time

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(text: str) -> int:
    """Seconds of an interval text such as "30 seconds" or "1 minute"."""
    total, parts = 0, text.lower().replace("interval", "").split()
    for n, unit in zip(parts[::2], parts[1::2], strict=True):
        total += int(n) * _UNITS[unit.rstrip("s")]
    return total


def pane_length(window: str, slide: str) -> str:
    return f"{math.gcd(seconds(window), seconds(slide))} seconds"


def pane_aggregates(stream: DataFrame, watermark: str = WATERMARK, window: str = WINDOW, slide: str = SLIDE,
                    log_buckets: int = 12) -> DataFrame:
    """(window, user_id, page_category, page_views, unique_products_viewed, panes) in append mode; on a plain frame, all windows."""
    events = with_event_time(stream, watermark)
    pane = events.groupBy(F.window("event_time", pane_length(window, slide)).alias("pane"), "user_id", "page_category").agg(
        F.count(F.lit(1)).alias("views"), F.hll_sketch_agg("product_id", F.lit(log_buckets)).alias("sketch"))
    covered = F.window(F.window_time("pane"), window, slide)
    return pane.groupBy(covered.alias("window"), "user_id", "page_category").agg(
        F.sum("views").alias("page_views"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_products_viewed"),
        F.count(F.lit(1)).alias("panes"))

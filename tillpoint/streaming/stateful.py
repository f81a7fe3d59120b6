"""Exact distinct products per sliding window in update mode, with arbitrary state.

``collect_set`` keeps a window's products as one value that every batch reads
and writes whole.  Here each window is ``GROUPS`` keys of a ``transformWithState``
operator, its users and categories dealt to them by hash.  A key's state is a small
entry per user and category (views, products, the first ``HELD`` products themselves)
and a map with one entry for each product beyond those.  The first ``TOGETHER`` entries
are one value, later ones have a place of their own in a map.  A batch touches that
value, whose size is bounded, and the entries of its own users and products, so its
cost follows the batch and not the window; a key's calls into the state store (its
entries, is the window open, its timer) are shared by its users and categories.  An
event-time timer at the window's end removes the key's state once the watermark
passes it; rows that arrive later are dropped by the operator, as a windowed
aggregation would.

Events travel packed: those of a source task that are in the same windows and the
same group are one row of lists, and a key's rows leave as lists.

The state lives in the RocksDB store that ``transformWithState`` needs; the
session's store provider is set while the query starts and put back after.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StringType, StructField, StructType

from tillpoint.streaming.clickstream import SLIDE, WATERMARK, WINDOW
from tillpoint.streaming.panes import seconds

PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

GROUPS = 8     # state keys per window
HELD = 16      # products kept inside an entry; further ones have entries of their own
TOGETHER = 512           # entries kept as one value of a key; further ones have places of their own
PACK_ROWS = 200_000      # events packed at a time
PACKED = 4096            # events in a packed row, members in a row of results

_MEMBER = StructType([StructField("user_id", LongType()), StructField("page_category", StringType())])
_COUNTS = StructType([StructField("page_views", LongType()), StructField("products", LongType()), StructField("held", ArrayType(LongType()))])
_PRODUCT = StructType([*_MEMBER.fields, StructField("product_id", LongType())])
_SEEN = StructType([StructField("seen", BooleanType())])
_ENTRIES = StructType([StructField("entries", BinaryType())])
_EVENT = ["user_id", "page_category", "product_id"]
_MEMBERS = ["user_id", "page_category", "page_views", "unique_products_viewed"]
_LISTS = ("window_start timestamp, window_end timestamp, user_id array<long>, page_category array<string>, "
          "page_views array<long>, unique_products_viewed array<long>")

class DistinctProducts(StatefulProcessor):
    """Page views and distinct products of the users and categories of one (window_start, window_end, group).

    ``on_expiry`` gives their rows when the window closes (append mode); otherwise every batch gives
    the state so far of the users and categories that it touches (update mode).  Rows of events and of results are lists.
    """

    def __init__(self, on_expiry: bool = False):
        self.on_expiry = on_expiry

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", _ENTRIES)
        self.counts = handle.getMapState("counts", _MEMBER, _COUNTS)
        self.seen = handle.getMapState("seen", _PRODUCT, _SEEN)

    def _rows(self, key, found: Iterator[tuple]) -> Iterator[Row]:
        """Members with views and products, ``PACKED`` to a row."""
        held: list[tuple] = []

        def packed():
            members, views, products = zip(*held)
            users, categories = zip(*members)
            return Row(window_start=key[0], window_end=key[1], user_id=list(users), page_category=list(categories),
                       page_views=list(views), unique_products_viewed=list(products))

        for one in found:
            held.append(one)
            if len(held) == PACKED:
                yield packed()
                held.clear()
        if held:
            yield packed()

    def _updated(self, batch: dict) -> Iterator[tuple]:
        before = self.first.get()
        known, entries = before is not None, pickle.loads(before[0]) if before else {}
        for member, (views, fresh) in batch.items():
            together = member in entries or len(entries) < TOGETHER      # never fewer: who once found no room is in the map
            old = entries.get(member) if together else self.counts.getValue(member) if known and self.counts.containsKey(member) else None
            products, held = 0, []
            if old is not None:
                views, products, held = views + old[0], old[1], list(old[2])
                fresh = fresh.difference(held)
            for product in fresh:
                if len(held) < HELD:
                    held.append(product)
                elif products > HELD and self.seen.containsKey((*member, product)):
                    continue
                else:
                    self.seen.updateValue((*member, product), (True,))
                products += 1
            if together:
                entries[member] = (views, products, held)
            else:
                self.counts.updateValue(member, (views, products, held))
            yield member, views, products
        self.first.update((pickle.dumps(entries, pickle.HIGHEST_PROTOCOL),))
        if not known:
            self.handle.registerTimer(int(self.closes.timestamp() * 1000))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        batch: dict[tuple, list] = {}
        for row in rows:
            for user, category, product in zip(row["user_id"], row["page_category"], row["product_id"]):
                member = batch.get((user, category))
                if member is None:
                    member = batch[user, category] = [0, set()]
                member[0] += 1
                if product is not None:
                    member[1].add(product)
        self.closes = key[1]
        updated = list(self._updated(batch))
        if not self.on_expiry:
            yield from self._rows(key, updated)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        entries = pickle.loads(self.first.get()[0])
        more = len(entries) >= TOGETHER
        if self.on_expiry:
            yield from self._rows(key, ((member, *entry[:2]) for member, entry in entries.items()))
            if more:
                yield from self._rows(key, ((tuple(member), *entry[:2]) for member, entry in self.counts.iterator()))
        self.first.clear()
        if more:
            self.counts.clear()
        if more or any(products > HELD for _, products, _ in entries.values()):
            self.seen.clear()

    def close(self) -> None:
        pass


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB; the session's own provider comes back after."""
    before = spark.conf.get(PROVIDER_CONF, None)
    spark.conf.set(PROVIDER_CONF, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER_CONF)
        else:
            spark.conf.set(PROVIDER_CONF, before)


def _pane_micros(window: str, slide: str) -> int:
    """Microseconds of a pane: its events are in the same windows."""
    try:
        return math.gcd(seconds(window), seconds(slide)) * 1_000_000
    except (KeyError, ValueError):      # a length in other units: only events of one time are known to share their windows
        return 1


def _packer(pane: int):
    def flush(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks()
        micros, group = table["micros"].to_numpy(), table["group"].to_numpy()
        order = np.lexsort((micros, group, micros // pane))
        of, group, micros = (micros // pane)[order], group[order], micros[order]
        change = np.flatnonzero((np.diff(of) != 0) | (np.diff(group) != 0)) + 1
        starts = np.unique(np.concatenate([[0], change, np.arange(0, len(order), PACKED)]))
        offsets = pa.array(np.r_[starts, len(order)].astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pc.take(table[c].combine_chunks(), pa.array(order))) for c in _EVENT]
        last = np.r_[starts[1:], len(order)] - 1                 # the row's latest event carries the watermark
        yield pa.RecordBatch.from_arrays([pa.array(micros[last]), pa.array(group[starts]), *lists], names=["micros", "group", *_EVENT])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= PACK_ROWS:
                yield from flush(held)
                held, rows = [], 0
        if held:
            yield from flush(held)

    return pack


def stateful_distinct(stream: DataFrame, watermark: str = WATERMARK, window: str = WINDOW, slide: str = SLIDE,
                      output_mode: str = "update") -> DataFrame:
    """``clickstream_aggregates`` with exact distinct products in update (or append) mode, from state in maps.

    Start the result inside ``rocksdb_state``.  Null products count as views only; null users and
    categories are groups of their own.
    """
    if output_mode not in ("update", "append"):
        raise ValueError(f"output_mode must be 'update' or 'append', not {output_mode!r}")
    events = stream.select(F.unix_micros(F.to_timestamp("event_timestamp")).alias("micros"),
                           F.pmod(F.hash("user_id", "page_category"), F.lit(GROUPS)).alias("group"),
                           F.col("user_id").cast("long"), F.col("page_category").cast("string"), F.col("product_id").cast("long"))
    packed = events.filter(F.col("micros").isNotNull()).mapInArrow(
        _packer(_pane_micros(window, slide)), "micros long, group int, user_id array<long>, page_category array<string>, product_id array<long>")
    timed = packed.withColumn("event_time", F.timestamp_micros("micros")).withWatermark("event_time", watermark)
    # the window's time carries the watermark: a row is late when its window has closed, not when its event is old
    windowed = timed.select(F.window("event_time", window, slide).alias("window"), "group", *_EVENT)
    open_rows = windowed.select("window", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "group", *_EVENT)
    lists = open_rows.groupBy("window_start", "window_end", "group").transformWithState(
        DistinctProducts(output_mode == "append"), _LISTS, output_mode, "eventTime")
    return lists.select("window_start", "window_end", F.inline(F.arrays_zip(*_MEMBERS)))


def run_stateful(result: DataFrame, path: str, checkpoint: str, output_mode: str = "update") -> list[dict]:
    """Run over everything available now; each batch's rows are written under their epoch.  Returns the progress reports.

    A repeated batch replaces its own folder, so a restart from the checkpoint adds nothing twice.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        plain = batch.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
        plain.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    with rocksdb_state(result.sparkSession):
        q = (result.writeStream.outputMode(output_mode).foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    if q.exception():
        raise q.exception()
    return [dict(p) if isinstance(p, dict) else p for p in q.recentProgress]

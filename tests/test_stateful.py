"""Stateful distincts and pane windows: batch equality, falling state, restarts, late rows, sketches."""

import datetime as dt

from pyspark.sql import functions as F

from tillpoint.catalog import q_streaming as QS
from tillpoint.streaming import clickstream as CS
from tillpoint.streaming import panes as P
from tillpoint.streaming import stateful as S

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
SCHEMA = "event_timestamp string, user_id long, page_category string, product_id long"


def rows_at(minute, n, users=3, products=5, late=0):
    out = []
    for i in range(n):
        t = T0 + dt.timedelta(minutes=minute - late, seconds=(i * 7) % 60)
        out.append((str(t), i % users, "cat" if i % 2 else None, None if i % 11 == 0 else i % products))
    return out


def put(spark, inbox, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)


def source(spark, inbox):
    return CS.file_stream(spark, inbox, "*.parquet", CS.CLICKSTREAM_SCHEMA, 1)


def latest(spark, out):
    got = CS.latest_updates(spark.read.parquet(out), ["window_start", "window_end", "user_id", "page_category"])
    return {tuple(r)[:4]: (r["page_views"], r["unique_products_viewed"]) for r in got.collect()}


def batch(spark, rows):
    df = CS.clickstream_aggregates(spark.createDataFrame(rows, SCHEMA), distinct="set")
    return {tuple(r)[:4]: (r["page_views"], r["unique_products_viewed"]) for r in CS.flatten_window(df).collect()}


def test_state_falls_and_a_restart_adds_nothing(spark):
    out, ckpt = CS.scratch(spark, "tws")
    inbox = out + "_in"
    first, second, third = rows_at(0, 60), rows_at(30, 40), rows_at(60, 5)
    put(spark, inbox, first)
    S.run_stateful(S.stateful_distinct(source(spark, inbox)), out, ckpt)
    assert latest(spark, out) == batch(spark, first)
    put(spark, inbox, second)
    put(spark, inbox, third)
    reports = S.run_stateful(S.stateful_distinct(source(spark, inbox)), out, ckpt)       # a new query from the checkpoint
    want = batch(spark, first + second + third)
    assert latest(spark, out) == want
    held = [p["stateOperators"][0]["numRowsTotal"] for p in reports]
    assert held[-1] < max(held) and held[-1] <= 4 * len(batch(spark, third))             # only what is still open is kept
    S.run_stateful(S.stateful_distinct(source(spark, inbox)), out, ckpt)                 # nothing new
    assert latest(spark, out) == want
    put(spark, inbox, rows_at(60, 30, late=50))                                          # windows that closed long ago
    S.run_stateful(S.stateful_distinct(source(spark, inbox)), out, ckpt)
    assert latest(spark, out) == want


def test_append_mode_gives_closed_windows_once(spark):
    out, ckpt = CS.scratch(spark, "tws_append")
    inbox = out + "_in"
    put(spark, inbox, rows_at(0, 50))
    put(spark, inbox, rows_at(30, 1))
    S.run_stateful(S.stateful_distinct(source(spark, inbox), output_mode="append"), out, ckpt, "append")
    got = spark.read.parquet(out).drop("epoch").collect()
    want = {k: v for k, v in batch(spark, rows_at(0, 50)).items()}
    assert len(got) == len(want) and {tuple(r)[:4]: tuple(r)[4:] for r in got} == want


def test_store_provider_is_put_back(spark):
    before = spark.conf.get(S.PROVIDER_CONF, None)
    with S.rocksdb_state(spark):
        assert spark.conf.get(S.PROVIDER_CONF) == S.ROCKSDB
    assert spark.conf.get(S.PROVIDER_CONF, None) == before


def test_panes_equal_sliding_windows_and_count_each_event_once(spark):
    rows = rows_at(0, 300, users=2, products=400) + rows_at(3, 10)
    df = spark.createDataFrame(rows, SCHEMA)
    for window, slide in (("1 minute", "30 seconds"), ("5 minutes", "1 minute"), ("90 seconds", "1 minute"), ("1 minute", "1 minute")):
        panes = CS.flatten_window(P.pane_aggregates(df, window=window, slide=slide))
        plain = CS.flatten_window(CS.clickstream_aggregates(df, distinct="set", window=window, slide=slide))
        key = ["window_start", "window_end", "user_id", "page_category"]
        a, b = ({tuple(r[k] for k in key): r for r in x.collect()} for x in (panes, plain))
        assert {k: r["page_views"] for k, r in a.items()} == {k: r["page_views"] for k, r in b.items()}
        for k, r in a.items():
            true = b[k]["unique_products_viewed"]
            assert abs(r["unique_products_viewed"] - true) <= max(1, 0.05 * true)
    plan = P.pane_aggregates(df, window="1 hour", slide="1 minute")._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.rindex("Aggregate"):]
    assert "Expand" not in below                       # events aren't copied per window; panes are
    assert P.seconds("1 hour 30 minutes") == 5400 and P.pane_length("90 seconds", "1 minute") == "30 seconds"
    assert P.pane_aggregates(df.filter(F.lit(False))).count() == 0


def test_users_of_a_window_share_state_keys_and_many_products_stay_exact(spark):
    out, ckpt = CS.scratch(spark, "tws_groups")
    inbox = out + "_in"
    wide = [(str(T0), u, "cat", u) for u in range(200)]
    deep = [[(str(T0), 1000 + i % 2, None, (i * i) % p) for i in range(120)] for p in (S.HELD, 40, 97)]      # products held, some beyond, most beyond
    parts = [wide + deep[0], deep[1], deep[2]]
    for rows in parts:
        put(spark, inbox, rows)
    reports = S.run_stateful(S.stateful_distinct(source(spark, inbox)), out, ckpt)
    assert latest(spark, out) == batch(spark, sum(parts, []))
    timers = [p["stateOperators"][0]["customMetrics"]["numRegisteredTimers"] for p in reports]
    assert 0 < sum(timers) <= 2 * S.GROUPS                     # two windows; before, one key and one timer per user


def test_chained_batches_stay_of_one_size(spark, tmp_path):
    """Before, the whole table was one batch of two files, whose tasks' memory grew with it."""
    events = spark.range(3000).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"), F.when(F.col("id") % 3 > 0, "view").alias("event_type"),
                                      F.when(F.col("id") % 50 > 0, F.timestamp_seconds(F.lit(1704110400) + F.col("id") * 1237 % 3000)).alias("ts"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    events = spark.read.parquet(str(tmp_path / "events.parquet"))
    assert QS.bounded_inbox(spark, events, inbox, 400) == 8
    sizes = [r["count"] for r in spark.read.parquet(inbox).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 800
    stream = QS._events_stream(spark, inbox, "*.parquet", max_files=2)
    CS.run_to_parquet(CS.clickstream_aggregates(stream, distinct="chained", output_mode="append"), out, str(tmp_path / "ck"))
    got = CS.flatten_window(spark.read.parquet(out))
    want = CS.flatten_window(CS.clickstream_aggregates(CS.events_as_clickstream(events), distinct="set")).filter(
        F.col("window_end") <= events.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=5))
    assert want.count() > 500 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


class _Store:
    """The states of one key, kept here; counts the calls."""

    def __init__(self):
        self.calls, self.timers, self.states = 0, [], {}

    def registerTimer(self, at):
        self.timers.append(at)

    def getValueState(self, name, schema):
        return self.getMapState(name, schema)

    def getMapState(self, name, *schemas):
        store, held = self, self.states.setdefault(name, {})

        class State:
            def __getattribute__(self, what):
                store.calls += 1
                return {"get": lambda: held.get(0), "update": lambda v: held.update({0: v}), "clear": held.clear, "exists": lambda: bool(held),
                        "containsKey": held.__contains__, "getValue": held.get, "updateValue": held.__setitem__, "iterator": lambda: list(held.items())}[what]

        return State()


def _fed(processor, key, events):
    users, categories, products = map(list, zip(*events))
    rows = processor.handleInputRows(key, [{"user_id": users, "page_category": categories, "product_id": products}], None)
    return {(u, c): (v, p) for r in rows for u, c, v, p in zip(r.user_id, r.page_category, r.page_views, r.unique_products_viewed)}


def test_members_of_a_key_share_calls_into_the_store_and_further_ones_stay_exact(monkeypatch):
    """Before, every member of a key was a call of its own into the store (at least one per batch)."""
    key = (T0, T0 + dt.timedelta(minutes=1), 0)
    one, store = S.DistinctProducts(), _Store()
    one.init(store)
    assert len(_fed(one, key, [(u, "cat", u) for u in range(300)])) == 300 and store.calls < 10
    for room in (2, 512):
        monkeypatch.setattr(S, "TOGETHER", room)
        events = [(u % 5 if u % 7 else None, "cat" if u % 3 else None, None if u % 11 == 0 else (u * u) % 61) for u in range(600)]
        expected = {}
        for user, category, product in events:
            views, products = expected.setdefault((user, category), [0, set()])
            expected[user, category] = [views + 1, products | ({product} - {None})]
        expected = {m: (views, len(products)) for m, (views, products) in expected.items()}
        assert any(products > S.HELD for _, products in expected.values())
        for expiry in (False, True):
            one, store, last = S.DistinctProducts(expiry), _Store(), {}
            one.init(store)
            for at in range(0, 600, 45):
                last |= _fed(one, key, events[at:at + 45])
            assert store.timers == [int(key[1].timestamp() * 1000)] and last == ({} if expiry else expected)
            rows = list(one.handleExpiredTimer(key, None, None))
            closed = {(u, c): (v, p) for r in rows for u, c, v, p in zip(r.user_id, r.page_category, r.page_views, r.unique_products_viewed)}
            assert closed == (expected if expiry else {}) and not any(store.states.values())


def test_events_of_a_pane_and_group_are_packed(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(S, "PACKED", 40)
    micros = [(i * 7919) % 90_000_000 - 45_000_000 for i in range(500)]      # also before 1970
    events = {"micros": micros, "group": [i % 3 for i in range(500)], "user_id": [i if i % 9 else None for i in range(500)],
              "page_category": ["a" if i % 2 else None for i in range(500)], "product_id": list(range(500))}
    batches = pa.table(events, schema=pa.schema([("micros", pa.int64()), ("group", pa.int32()), ("user_id", pa.int64()),
                                                 ("page_category", pa.string()), ("product_id", pa.int64())])).to_batches(max_chunksize=64)
    rows = pa.Table.from_batches(list(S._packer(S._pane_micros("1 minute", "30 seconds"))(iter(batches)))).to_pylist()
    assert len(rows) < 50 and max(len(r["product_id"]) for r in rows) <= 40
    seen = [(p, u, c, r["group"], r["micros"] // 30_000_000) for r in rows for p, u, c in zip(r["product_id"], r["user_id"], r["page_category"])]
    assert sorted(x[0] for x in seen) == list(range(500))
    assert all((u, c, g, pane) == (events["user_id"][p], events["page_category"][p], p % 3, micros[p] // 30_000_000) for p, u, c, g, pane in seen)
    assert all(r["micros"] == max(micros[p] for p in r["product_id"]) for r in rows)
    assert S._pane_micros("1 minute", "7 parsecs") == 1

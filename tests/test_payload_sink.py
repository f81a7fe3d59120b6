"""The payload sink: epochs once, restarts, aborted attempts, odd rows."""

import pyarrow as pa
import pytest

from tillpoint.streaming import clickstream as CS
from tillpoint.streaming import payload_sink as L

SCHEMA = "id long, text string"


def put(spark, inbox, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(2).write.mode("append").parquet(inbox)


def run(spark, inbox, path, ckpt):
    stream = CS.file_stream(spark, inbox, "*.parquet", spark.createDataFrame([], SCHEMA).schema, 1)
    L.run_to_payload_log(CS.kafka_payload(stream), path, ckpt)
    return sorted(r["value"] for r in L.read_payload_log(spark, path).collect())


def test_end_to_end_with_a_restart(spark):
    path, ckpt = CS.scratch(spark, "sink")
    inbox = path + "_in"
    put(spark, inbox, [(1, "a\nb"), (2, None), (3, 'q" é'), (3, 'q" é')])
    first = run(spark, inbox, path, ckpt)
    assert len(first) == 4 and first[0] == '{"id":1,"text":"a\\nb"}'
    assert run(spark, inbox, path, ckpt) == first
    put(spark, inbox, [(9, "z")])
    assert run(spark, inbox, path, ckpt) == sorted([*first, '{"id":9,"text":"z"}'])


def test_a_repeated_epoch_adds_nothing(spark):
    path, _ = CS.scratch(spark, "sink")
    batch = lambda *v: iter([pa.RecordBatch.from_pydict({"value": pa.array(v, pa.string())})])
    w = L.PayloadWriter(path)
    w.commit([w.write(batch("a", None, "b")), w.write(batch(None)), None], 0)
    w.commit([w.write(batch("a", "b")), w.write(batch())], 0)             # the same epoch once more
    lost = w.write(batch("never committed"))
    assert sorted(r["value"] for r in L.read_payload_log(spark, path).collect()) == ["a", "b"]
    w.abort([lost, None], 1)
    w.abort([lost], 1)
    w.commit([w.write(batch("c"))], 1)
    assert sorted(r["value"] for r in L.read_payload_log(spark, path).collect()) == ["a", "b", "c"]
    assert sum(L.committed_files(path).values()) == 3


def test_empty_logs_and_refusals(spark):
    path, _ = CS.scratch(spark, "sink")
    assert L.read_payload_log(spark, path).count() == 0
    with pytest.raises(ValueError):
        L.PayloadLog({"path": path}).streamWriter(spark.createDataFrame([], "x int").schema, False)
    with pytest.raises(ValueError):
        L.PayloadLog({}).streamWriter(spark.createDataFrame([], "value string").schema, False)

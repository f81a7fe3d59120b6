"""Grouped Python aggregates that combine in parts.

A grouped pandas UDF sees a whole group as one Series in one task.  A mergeable
aggregate doesn't need that: each task folds its own rows of a group into a small
state (``update`` on Arrow slices, ``merge`` of states), only states are
shuffled, and the states of a group, one per task and flush at most, are merged
and finished.  A group that holds half of all rows is folded where its rows lie.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

MAX_HELD = 50_000      # groups a task holds before it sends their states on
MERGE_AT = 32          # states of a group before they become one


class MergeableAggregate(Protocol):
    """state: the state's columns as DDL.  A state is a tuple of their values."""

    state: str

    def init(self) -> tuple: ...
    def update(self, *columns: pa.Array) -> tuple: ...
    def merge(self, states: Sequence[tuple]) -> tuple: ...
    def finish(self, state: tuple) -> Any: ...


def _slices(batch: pa.RecordBatch, keys: Sequence[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(key, rows) of every group of the batch; nulls are a key of their own."""
    if not keys:
        yield (), batch
        return
    codes = [batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False) for k in keys]
    order = np.lexsort(codes[::-1])
    new = np.zeros(len(order), bool)
    new[0] = True
    for c in codes:
        new[1:] |= c[order][1:] != c[order][:-1]
    bounds = np.r_[np.flatnonzero(new), len(order)]
    ordered = batch.take(pa.array(order))
    firsts = zip(*[ordered.column(k).take(pa.array(bounds[:-1])).to_pylist() for k in keys])
    for key, a, b in zip(firsts, bounds[:-1].tolist(), bounds[1:].tolist()):
        yield key, ordered.slice(a, b - a)


def _hashable(key: tuple) -> tuple:
    """Keys as Spark groups them: all NaN are one, and so are both zeros."""
    return tuple(("nan",) if isinstance(x, float) and x != x else x for x in key)


class _Held:
    """States by group, merged now and then."""

    def __init__(self, fn: MergeableAggregate):
        self.fn, self.states = fn, {}

    def add(self, key: tuple, state: tuple) -> None:
        _, own = self.states.setdefault(_hashable(key), (key, []))
        own.append(state)
        if len(own) >= MERGE_AT:
            own[:] = [self.fn.merge(own)]

    def drain(self) -> list[tuple[tuple, tuple]]:
        out = [(key, own[0] if len(own) == 1 else self.fn.merge(own)) for key, own in self.states.values()]
        self.states = {}
        return out


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def arrow_aggregate(df: DataFrame, keys: Sequence[str], input_cols: Sequence[str], fn: MergeableAggregate, output_col: str,
                    return_type: str) -> DataFrame:
    """One row per group (one in all without keys): the keys and ``fn`` over ``input_cols``.

    Null keys are a group; an empty table has no groups, and without keys one row with ``fn.finish(fn.init())``.
    """
    keys = list(keys)
    spark = df.sparkSession
    kinds = [StructField(f"_k{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    result = spark.createDataFrame([], f"r {return_type}").schema["r"].dataType
    state_fields = spark.createDataFrame([], fn.state).schema.fields
    states = StructType(kinds + [StructField(f"_s{i}", f.dataType) for i, f in enumerate(state_fields)])
    finished = StructType([StructField(k, f.dataType) for k, f in zip(keys, kinds)] + [StructField(output_col, result)])
    state_schema, out_schema = to_arrow_schema(states), to_arrow_schema(finished)
    names, n_keys = [f.name for f in kinds], len(keys)

    def fold(batches):
        held = _Held(fn)
        for batch in batches:
            if not batch.num_rows:
                continue
            for key, rows in _slices(batch, names):
                held.add(key, fn.update(*[rows.column(n_keys + i) for i in range(rows.num_columns - n_keys)]))
            if len(held.states) > MAX_HELD:
                yield _batch([k + tuple(s) for k, s in held.drain()], state_schema)
        yield _batch([k + tuple(s) for k, s in held.drain()], state_schema)

    def close(batches):
        held, last, empty = _Held(fn), None, True
        for batch in batches:
            done = []
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                key, empty = row[:n_keys], False
                if last is not None and _hashable(key) != last:      # sorted: a key that has passed doesn't return
                    done += held.drain()
                last = _hashable(key)
                held.add(key, row[n_keys:])
            if done:
                yield _batch([k + (fn.finish(s),) for k, s in done], out_schema)
        rest = held.drain()
        if not n_keys and empty:
            rest = [((), fn.init())]
        yield _batch([k + (fn.finish(s),) for k, s in rest], out_schema)

    rows = df.select(*[df[f"`{k}`"].alias(f"_k{i}") for i, k in enumerate(keys)], *[df[f"`{c}`"].alias(f"_c{i}") for i, c in enumerate(input_cols)])
    partial = rows.mapInArrow(fold, states)
    met = partial.repartition(*names).sortWithinPartitions(*names) if keys else partial.repartition(1)     # a state per task at most
    return met.mapInArrow(close, finished)

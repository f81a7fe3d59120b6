"""Declarative transformations: a list of typed dicts folded over a frame.

Supported ``type`` values and their keys:

* ``add_column``   — column_name, expression (SQL text)
* ``filter``       — condition (SQL text; NULL drops the row)
* ``join``         — join_with (key of ``join_dfs``), join_type (default
  "inner"; any Spark join type), condition (SQL text; the current frame is
  aliased ``l`` and the other one ``r``); band {left, right} joins overlapping
  ranges, each an expression or a pair (low, high) over the side's columns,
  by bands instead of comparing all pairs (condition: a further test)
* ``aggregate``    — group_by (name or list; empty = global), aggregations
  (list of SQL aggregate texts)
* ``pivot``        — pivot_col, values (optional), group_by, aggregations
* ``window``       — window_spec {partition_by, order_by, frame {start, end}},
  function (SQL text such as "rank()" or "sum(x)", or a Column), column_name,
  skew_safe (default True: ranking, lag/lead, running sum/count/average and
  aggregates over frames of bounded distance, in rows or in values, are
  computed split across hot partition keys)
* ``udf``          — udf_name, function, input_cols, output_col, return_type
* ``pandas_udf``   — pandas_udf_name, function, input_cols, output_col,
  return_type, function_type ("SCALAR", "GROUPED_AGG" or "MERGEABLE"; a grouped
  aggregate needs group_by or window_spec.partition_by; MERGEABLE takes an
  object with init, update, merge and finish and folds groups in parts)
* ``schema_change`` — changes {column: {drop, new_name, new_type}}

Each step is a lazy DataFrame transformation; the whole list becomes one
Catalyst plan.  An unknown type raises ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
import re
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, NumericType, StringType

from tillpoint.operators.arrowagg import arrow_aggregate
from tillpoint.operators.bandjoin import band_join
from tillpoint.operators.halo import halo_rows_window, halo_window
from tillpoint.operators.sequencing import split_window

FRAME_TOKENS = {
    "unboundedpreceding": Window.unboundedPreceding,
    "unboundedfollowing": Window.unboundedFollowing,
    "currentrow": Window.currentRow,
}


def _as_list(v) -> list:
    if v is None:
        return []
    return list(v) if isinstance(v, (list, tuple)) else [v]


def _sort_col(spec) -> Column:
    if isinstance(spec, Column):
        return spec
    parts = str(spec).strip().split()
    c = F.col(parts[0])
    mods = [p.lower() for p in parts[1:]]
    if "desc" in mods:
        c = c.desc_nulls_last() if "last" in mods else c.desc()
    elif "first" in mods and "nulls" in mods:
        c = c.asc_nulls_first()
    elif "last" in mods:
        c = c.asc_nulls_last()
    else:
        c = c.asc()
    return c


def _frame_bound(v) -> int:
    if isinstance(v, str):
        key = v.replace("_", "").replace(" ", "").lower()
        if key in FRAME_TOKENS:
            return FRAME_TOKENS[key]
        return int(v)
    return int(v)


def window_spec(spec: Mapping[str, Any]):
    w = Window.partitionBy(*_as_list(spec.get("partition_by")))
    order = _as_list(spec.get("order_by"))
    if order:
        w = w.orderBy(*[_sort_col(o) for o in order])
    frame = spec.get("frame")
    if frame:
        kind = frame.get("kind", "rows")
        start, end = _frame_bound(frame["start"]), _frame_bound(frame["end"])
        w = w.rangeBetween(start, end) if kind == "range" else w.rowsBetween(start, end)
    return w


def _expr(v) -> Column:
    return v if isinstance(v, Column) else F.expr(v)


def add_column(df: DataFrame, t: Mapping, **_) -> DataFrame:
    return df.withColumn(t["column_name"], _expr(t["expression"]))


def filter_rows(df: DataFrame, t: Mapping, **_) -> DataFrame:
    return df.filter(_expr(t["condition"]))


def _compares_every_pair(joined: DataFrame) -> bool:
    """Does Spark find no equality between the sides by which rows could meet?  Asked of the analysed plan, so
    an equality under an OR doesn't count and one of expressions does."""
    plan = joined._jdf.queryExecution().analyzed()
    keys = joined.sparkSession._jvm.org.apache.spark.sql.catalyst.planning.ExtractEquiJoinKeys
    return plan.nodeName() == "Join" and not keys.unapply(plan).isDefined()


def join(df: DataFrame, t: Mapping, join_dfs: Mapping[str, DataFrame] | None = None, **_) -> DataFrame:
    name = t["join_with"]
    if not join_dfs or name not in join_dfs:
        raise ValueError(f"no frame named {name!r} was given to join with")
    how = t.get("join_type", "inner")
    other = join_dfs[name]
    cond = t.get("condition")
    if t.get("band"):
        return band_join(df, other, t["band"]["left"], t["band"]["right"], cond, how)
    left, right = df.alias("l"), other.alias("r")
    if how == "cross" or not cond:
        joined = left.crossJoin(right) if not cond else left.join(right, on=_expr(cond), how="cross")
    else:
        joined = left.join(right, on=_expr(cond), how=how)
    if _compares_every_pair(joined) and not t.get("allow_cross", False):
        # every pair of rows is looked at: output may grow with the product of both inputs
        raise ValueError("a join without an equality needs a band, or allow_cross=True in its step")
    return joined


def aggregate(df: DataFrame, t: Mapping, **_) -> DataFrame:
    return df.groupBy(*_as_list(t.get("group_by"))).agg(*[_expr(a) for a in _as_list(t["aggregations"])])


def pivot(df: DataFrame, t: Mapping, **_) -> DataFrame:
    grouped = df.groupBy(*_as_list(t.get("group_by"))).pivot(t["pivot_col"], t.get("values"))
    return grouped.agg(*[_expr(a) for a in _as_list(t["aggregations"])])


_RANKING = re.compile(r"^\s*(row_number|rank|dense_rank)\s*\(\s*\)\s*$", re.I)
_SHIFT = re.compile(r"^\s*(lag|lead)\s*\(\s*`?(\w+)`?\s*(?:,\s*([1-9]\d*)\s*)?\)\s*$", re.I)
_RUNNING = re.compile(r"^\s*(sum|count)\s*\(\s*(\*|1|`?\w+`?)\s*\)\s*$", re.I)


def _split_plan(t: Mapping):
    """(kind, input column, range frame?) when the window can run split
    across a hot partition key (see ``operators.sequencing``), else None."""
    spec = t["window_spec"]
    fn = t["function"]
    if not isinstance(fn, str) or not _as_list(spec.get("partition_by")) or not _as_list(spec.get("order_by")):
        return None
    frame = spec.get("frame")
    m = _RANKING.match(fn)
    if m and not frame:
        return m.group(1).lower(), None, False
    m = _SHIFT.match(fn)
    if m and not frame:
        return m.group(1).lower(), m.group(2), int(m.group(3) or 1)
    m = _RUNNING.match(fn)
    if m:
        col = m.group(2).strip("`")
        kind = "running_sum" if m.group(1).lower() == "sum" else "running_count"
        if kind == "running_sum" and col in ("*", "1"):
            return None
        if not frame:
            return kind, col, True                     # default frame: range, unbounded → current
        start, end = _frame_bound(frame["start"]), _frame_bound(frame["end"])
        rows = frame.get("kind", "rows") == "rows"
        if start == Window.unboundedPreceding and end == Window.currentRow:
            return kind, col, not rows
        if rows and end == Window.currentRow and Window.unboundedPreceding < start <= 0:
            # k preceding .. current row: every range carries its last k values
            return kind.replace("running", "moving"), col, -start
    return None


_AVERAGE = re.compile(r"^\s*(?:avg|mean)\s*\(\s*(`?\w+`?)\s*\)\s*$", re.I)
_AGGREGATES = re.compile(r"^\s*(?:sum|avg|mean|min|max|count|stddev\w*|var\w*|collect_list|collect_set|first|last|bool_and|bool_or)\s*\(.*\)\s*$", re.I)


def _halo_plan(df: DataFrame, t: Mapping):
    """How an aggregate over a frame of bounded distance runs on split ranges: ("range", column, descending, start, end) or
    ("rows", None, None, start, end); None where it can't."""
    spec, fn = t["window_spec"], t["function"]
    frame, order = spec.get("frame"), _as_list(spec.get("order_by"))
    if not frame or not order or not _as_list(spec.get("partition_by")) or not isinstance(fn, str) or not _AGGREGATES.match(fn):
        return None
    start, end = _frame_bound(frame["start"]), _frame_bound(frame["end"])
    if start <= Window.unboundedPreceding or end >= Window.unboundedFollowing or start > end:
        return None
    if frame.get("kind", "rows") == "rows":
        return "rows", None, None, start, end
    words = str(order[0]).lower().split()
    name = str(order[0]).split()[0]
    if len(order) != 1 or isinstance(order[0], Column) or name not in df.columns or "nulls" in words or \
            not isinstance(df.schema[name].dataType, (NumericType, DateType)):
        return None
    return "range", name, "desc" in words, start, end


def _running_average(df: DataFrame, t: Mapping) -> DataFrame | None:
    """avg over everything up to the current row, as a running sum over a running count."""
    m = _AVERAGE.match(t["function"]) if isinstance(t["function"], str) else None
    if not m:
        return None
    parts = [dict(t, function=f"{f}({m.group(1)})", column_name=f"_avg_{f}") for f in ("sum", "count")]
    plans = [_split_plan(p) for p in parts]
    if None in plans or not all(p[0].startswith("running") for p in plans):
        return None
    both = _run_window_batch(df, {"steps": list(zip(parts, plans)), "range": plans[0][2]})
    kind = df.select(_expr(t["function"]).over(window_spec(t["window_spec"])).alias("x")).schema["x"].dataType
    mean = F.try_divide(F.col("_avg_sum").cast("double") if isinstance(kind, DoubleType) else F.col("_avg_sum"), F.col("_avg_count"))
    return both.withColumn(t["column_name"], mean.cast(kind)).drop("_avg_sum", "_avg_count")


def window(df: DataFrame, t: Mapping, **_) -> DataFrame:
    """Window step.  Over a partitioned, ordered window these run split across hot
    keys unless the step sets ``skew_safe: False``: ranking, lag/lead, running
    sum/count/average, and any aggregate over a frame of bounded distance (rows or
    values, backwards or ahead).  Other functions use a plain Spark window."""
    safe = t.get("skew_safe", True)
    plan = _split_plan(t) if safe else None
    if plan is None and safe:
        averaged = _running_average(df, t)
        if averaged is not None:
            return averaged
        halo = _halo_plan(df, t)
        if halo is not None:
            kind, name, descending, start, end = halo
            keys, made = _as_list(t["window_spec"]["partition_by"]), {t["column_name"]: _expr(t["function"])}
            if kind == "range":
                return halo_window(df, keys, name, start, end, made, descending)
            return halo_rows_window(df, keys, [_sort_col(o) for o in _as_list(t["window_spec"]["order_by"])], start, end, made)
    if plan is None:
        return df.withColumn(t["column_name"], _expr(t["function"]).over(window_spec(t["window_spec"])))
    return _run_window_batch(df, {"steps": [(t, plan)], "range": plan[2] if plan[0].startswith("running") else None})


def _udf_args(t: Mapping) -> list[Column]:
    return [F.col(c) for c in _as_list(t["input_cols"])]


def python_udf(df: DataFrame, t: Mapping, **_) -> DataFrame:
    """Row UDF (Arrow-batched), also registered for SQL under ``udf_name``."""
    rtype: DataType | str = t.get("return_type", StringType())
    fn: Callable = t["function"]
    u = F.udf(fn, rtype, useArrow=True)
    df.sparkSession.udf.register(t["udf_name"], u)
    return df.withColumn(t["output_col"], u(*_udf_args(t)))


def _make_pandas_udf(fn, rtype, kind: str):
    """Type-hinted functions declare their kind themselves; untyped callables
    fall back to the explicit (legacy) function type."""
    if getattr(fn, "__annotations__", None):
        return F.pandas_udf(fn, rtype)
    from pyspark.sql.functions import PandasUDFType
    return F.pandas_udf(fn, rtype, getattr(PandasUDFType, kind))


def pandas_udf(df: DataFrame, t: Mapping, **_) -> DataFrame:
    """Vectorised UDF.  SCALAR maps Series → Series; GROUPED_AGG reduces
    Series → scalar per group (``group_by``) or per window partition.  MERGEABLE
    folds each group in parts (see ``operators.arrowagg``)."""
    kind = str(t.get("function_type", "SCALAR")).upper()
    fn = t["function"]
    rtype = t["return_type"]
    if kind in ("SCALAR", "SCALAR_ITER"):
        u = _make_pandas_udf(fn, rtype, kind)
        df.sparkSession.udf.register(t["pandas_udf_name"], u)
        return df.withColumn(t["output_col"], u(*_udf_args(t)))
    if kind == "GROUPED_AGG":
        u = _make_pandas_udf(fn, rtype, kind)
        df.sparkSession.udf.register(t["pandas_udf_name"], u)
        if t.get("group_by") is not None:
            return df.groupBy(*_as_list(t["group_by"])).agg(u(*_udf_args(t)).alias(t["output_col"]))
        return df.withColumn(t["output_col"], u(*_udf_args(t)).over(window_spec(t["window_spec"])))
    if kind == "MERGEABLE":
        return arrow_aggregate(df, _as_list(t.get("group_by")), _as_list(t["input_cols"]), fn, t["output_col"], rtype)
    raise ValueError(f"unsupported pandas_udf function_type {kind!r}")


def schema_change(df: DataFrame, t: Mapping, **_) -> DataFrame:
    changes = t["changes"]
    cols = []
    for name in df.columns:
        ch = changes.get(name)
        if ch is None:
            cols.append(F.col(name))
            continue
        if ch.get("drop", False):
            continue
        c = F.col(name)
        if ch.get("new_type"):
            c = c.try_cast(ch["new_type"]) if ch.get("lenient") else c.cast(ch["new_type"])
        cols.append(c.alias(ch.get("new_name") or name))
    return df.select(*cols)


STEPS: dict[str, Callable[..., DataFrame]] = {
    "add_column": add_column, "filter": filter_rows, "join": join, "aggregate": aggregate,
    "pivot": pivot, "window": window, "udf": python_udf, "pandas_udf": pandas_udf,
    "schema_change": schema_change,
}


def _window_batches(transformations: Sequence[Mapping[str, Any]]):
    """Group consecutive split-eligible window steps over the same partition
    and order (and compatible frames) so they share one range split."""
    out: list = []
    for t in transformations:
        plan = _split_plan(t) if t.get("type") == "window" and t.get("skew_safe", True) else None
        if plan is not None:
            spec = t["window_spec"]
            sig = (tuple(_as_list(spec.get("partition_by"))), tuple(map(str, _as_list(spec.get("order_by")))))
            range_flag = plan[2] if plan[0].startswith("running") else None
            prev = out[-1] if out and isinstance(out[-1], dict) and out[-1].get("_batch") else None
            if prev is not None and prev["sig"] == sig and (range_flag is None or prev["range"] in (None, range_flag)):
                prev["steps"].append((t, plan))
                prev["range"] = prev["range"] if range_flag is None else range_flag
                continue
            out.append({"_batch": True, "sig": sig, "range": range_flag, "steps": [(t, plan)]})
        else:
            out.append(t)
    return out


def _run_window_batch(df: DataFrame, batch) -> DataFrame:
    first = batch["steps"][0][0]["window_spec"]
    ordering = [_sort_col(o) for o in _as_list(first["order_by"])]
    outputs = []
    for t, (kind, col, extra) in batch["steps"]:
        outputs.append((kind, t["column_name"], col, extra) if kind.startswith(("moving", "lag", "lead")) else (kind, t["column_name"], col))
    # a step's type must not depend on how it is run: that of the plain window
    plain = df.select(*[_expr(t["function"]).over(window_spec(t["window_spec"])).alias(t["column_name"])
                        for t, _ in batch["steps"]]).schema
    out = split_window(df, _as_list(first["partition_by"]), ordering, outputs, range_frame=bool(batch["range"]))
    return out.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in plain})


def apply_transformations(df: DataFrame, transformations: Sequence[Mapping[str, Any]],
                          join_dfs: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Fold ``transformations`` over ``df`` in list order (consecutive
    split windows over the same partition and order share one range split)."""
    def step(acc: DataFrame, t) -> DataFrame:
        if isinstance(t, dict) and t.get("_batch"):
            return _run_window_batch(acc, t)
        kind = t.get("type")
        if kind not in STEPS:
            raise ValueError(f"Unknown transformation type: {kind!r}")
        return STEPS[kind](acc, t, join_dfs=join_dfs)
    return reduce(step, _window_batches(transformations), df)

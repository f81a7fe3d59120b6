"""Per-group row numbers and lags that survive a hot group.

``Window.partitionBy(key).orderBy(...)`` puts every row of a key into one
task; if one customer holds a third of all orders that task sorts a third of
the data.  ``sequence_within_groups`` computes the same ``row_number`` and
``lag`` values while splitting hot groups:

1. range-partition on (key, order) — a large group spans several
   partitions, each of bounded size;
2. number rows and take lags inside (range partition, key) with an ordinary
   window (a hot group is now several window partitions);
3. fix the first group of each range partition, which may continue a group
   from earlier partitions: a per-partition summary (first key, last key,
   row count and last row of the last group) has one row per partition, so
   it is broadcast with a proven size bound; the offset of a partition's
   first group is the number of rows of that key in earlier partitions, and
   its first lag comes from the last row of the nearest earlier partition
   ending with that key.

The ordering must be total (include a unique tie-break).  The numbered
frame is written to the shared folder before the summary is taken:
range bounds come from sampling, and every re-execution of a range exchange
samples again, so all consumers must read one materialised copy.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.session import cut_lineage, written


# Supported per-row outputs of ``split_window`` (kind, output column, input column, k):
#   row_number, rank, dense_rank             — positions in the group
#   lag, lead                                — the value k rows before / after (k 1 when not given)
#   running_sum, running_count               — over the frame (rows or the default range frame)
#   moving_sum, moving_count                 — over rows between k preceding and the current row
SUPPORTED = ("row_number", "rank", "dense_rank", "lag", "lead", "running_sum", "running_count",
             "moving_sum", "moving_count")


def split_window(df: DataFrame, keys: Sequence[str], ordering: Sequence[Column], outputs,
                 range_frame: bool = False, partitions: int | None = None) -> DataFrame:
    """Window functions over (keys ordered by ``ordering``) computed on a
    range-split layout, so a hot key never sits in one task.

    Ties of the full ordering never straddle two range partitions (equal
    sort keys go to the same partition), so local ranks and range frames are
    exact inside a partition and only additive carries (rows, distinct order
    values, sums, counts) and one boundary row cross partitions.
    """
    outputs = [tuple(o) + (None,) * (4 - len(o)) for o in outputs]
    for kind, _, _, _ in outputs:
        if kind not in SUPPORTED:
            raise ValueError(f"unsupported split-window function {kind!r}")
    key_struct = F.struct(*[F.col(k) for k in keys])
    # Without an explicit count the range exchange is sized by AQE (initial
    # partition number, then coalesced to the advisory size); coalescing joins
    # neighbouring ranges, so partition ids stay in key order.
    sort_keys = [F.col(k).asc() for k in keys] + list(ordering)
    ranged = df.repartitionByRange(partitions, *sort_keys) if partitions else df.repartitionByRange(*sort_keys)
    s = ranged.withColumn("_pid", F.spark_partition_id())
    w = Window.partitionBy("_pid", *keys).orderBy(*ordering)
    wf = w.rangeBetween(Window.unboundedPreceding, Window.currentRow) if range_frame else \
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("_pid", *keys)
    kinds = {k for k, _, _, _ in outputs}

    def total_type(col):
        """The type that sum() gives for the column: carries are added and returned in it."""
        return df.select(F.sum(F.lit(1) if col in (None, "*") else F.col(col)).alias("s")).schema["s"].dataType

    local = {"_lrn": F.row_number().over(w), "_lcnt": F.count(F.lit(1)).over(whole)}
    if "rank" in kinds:
        local["_lrank"] = F.rank().over(w)
    local["_ldense"] = F.dense_rank().over(w) if "dense_rank" in kinds else F.lit(0)
    for i, (kind, _, col, k) in enumerate(outputs):
        if kind in ("moving_sum", "moving_count"):
            value = F.lit(1) if col in (None, "*") else F.col(col)
            if kind == "moving_sum":
                value = value.cast(total_type(col))
            frame = w.rowsBetween(-int(k), Window.currentRow)
            local[f"_o{i}"] = (F.sum(value) if kind == "moving_sum" else F.count(value)).over(frame)
        elif kind == "lag":
            local[f"_o{i}"] = F.lag(col, int(k or 1)).over(w)
        elif kind == "lead":
            local[f"_o{i}"] = F.lead(col, int(k or 1)).over(w)
        elif kind == "running_sum":
            local[f"_o{i}"] = F.sum(col).over(wf)
            local[f"_t{i}"] = F.sum(col).over(whole)
        elif kind == "running_count":
            c = F.lit(1) if col in (None, "*") else F.col(col)
            local[f"_o{i}"] = F.count(c).over(wf)
            local[f"_t{i}"] = F.count(c).over(whole)
    # one materialised copy: each re-run range exchange would sample new bounds.  Its summaries read key columns only
    s = written(s.withColumns(local), "split-window")

    # ---- per-partition summary: first and last group, carries of the last group
    far = {i for i, (kind, _, _, k) in enumerate(outputs) if kind in ("lag", "lead") and int(k or 1) > 1}
    vcols = sorted({col for i, (kind, _, col, _) in enumerate(outputs) if kind in ("lag", "lead") and i not in far})
    vals = F.struct(*[F.col(c).alias(c) for c in vcols]) if vcols else F.lit(None)
    tails = [F.max("_lcnt").alias("_c_cnt"), F.max("_ldense").alias("_c_dense"),
             F.max_by(vals, F.col("_lrn")).alias("_c_last")]
    tails += [F.max(f"_t{i}").alias(f"_c{i}") for i, (k, _, _, _) in enumerate(outputs) if k.startswith("running")]
    for i, (kind, _, col, k) in enumerate(outputs):
        if kind.startswith("moving") or (kind == "lag" and i in far):
            # the last k rows of the tail group (at most k per partition)
            value = F.lit(1) if col in (None, "*") else F.col(col)
            value = value.cast(total_type(col)) if kind == "moving_sum" else value
            last_k = F.collect_list(F.when(F.col("_lrn") > F.col("_lcnt") - int(k),
                                           F.struct(F.col("_lrn").alias("r"), value.alias("v"))))
            tails.append(F.transform(F.array_sort(last_k), lambda x: x["v"]).alias(f"_c{i}"))
    heads_far = []      # the first k rows of the head group
    for i in sorted(far):
        kind, _, col, k = outputs[i]
        if kind == "lead":
            first_k = F.collect_list(F.when(F.col("_lrn") <= int(k), F.struct(F.col("_lrn").alias("r"), F.col(col).alias("v"))))
            heads_far.append(F.transform(F.array_sort(first_k), lambda x: x["v"]).alias(f"_h{i}"))
    bounds = s.groupBy("_pid").agg(F.min(key_struct).alias("_first"), F.max(key_struct).alias("_last"))
    tail = (s.join(F.broadcast(bounds), "_pid").filter(key_struct.eqNullSafe(F.col("_last")))
            .groupBy("_pid").agg(*tails))
    head = (s.join(F.broadcast(bounds), "_pid").filter(key_struct.eqNullSafe(F.col("_first")))
            .groupBy("_pid").agg(F.min_by(vals, F.col("_lrn")).alias("_h_first"), *heads_far))
    # one row per range partition; read several times below, so written once
    summary = cut_lineage(bounds.join(tail, "_pid").join(head, "_pid"))
    # A partition's tail serves later partitions that start with its last key, its head serves earlier
    # ones that end with its first key.  Each partition gives one row and asks with another, per key in
    # partition order; a running window hands the carries on (no pairing of partitions).
    nothing = [F.lit(None).cast(summary.schema[c].dataType).alias(c) for c in summary.columns if c.startswith("_c")]
    given = [c for c in summary.columns if c.startswith("_c")]
    gives = summary.select("_pid", F.col("_last").alias("_key"), F.lit(True).alias("_gives"), *given)
    asks = summary.select("_pid", F.col("_first").alias("_key"), F.lit(False).alias("_gives"), *nothing)
    past = Window.partitionBy("_key").orderBy("_pid", "_gives").rowsBetween(Window.unboundedPreceding, -1)
    carries = [F.sum("_c_cnt").over(past).alias("_k_cnt"), F.sum("_c_dense").over(past).alias("_k_dense"),
               F.last("_c_last", ignorenulls=True).over(past).alias("_k_last")]
    for i, (kind, _, _, k) in enumerate(outputs):
        if kind.startswith("running"):
            carries.append(F.sum(f"_c{i}").over(past).alias(f"_k{i}"))
        elif kind.startswith("moving") or (kind == "lag" and i in far):
            # every tail holds a row at least, so the last k rows lie in the last k tails (every second row)
            near = Window.partitionBy("_key").orderBy("_pid", "_gives").rowsBetween(-2 * max(1, int(k)), -1)
            flat = F.flatten(F.collect_list(f"_c{i}").over(near))
            carries.append(F.slice(flat, F.greatest(F.size(flat) - int(k) + 1, F.lit(1)), int(k)).alias(f"_k{i}"))
    before = gives.union(asks).select("_pid", "_gives", *carries).filter(~F.col("_gives")).drop("_gives")
    ahead_cols = [c for c in summary.columns if c.startswith("_h")]
    no_head = [F.lit(None).cast(summary.schema[c].dataType).alias(c) for c in ahead_cols]
    heads = summary.select("_pid", F.col("_first").alias("_key"), F.lit(True).alias("_gives"), *ahead_cols).union(
        summary.select("_pid", F.col("_last").alias("_key"), F.lit(False).alias("_gives"), *no_head))
    ahead = Window.partitionBy("_key").orderBy(F.col("_pid").desc(), F.col("_gives").asc())
    nexts = [F.last("_h_first", ignorenulls=True).over(ahead.rowsBetween(Window.unboundedPreceding, -1)).alias("_k_next")]
    for i in sorted(far):
        if outputs[i][0] == "lead":
            # the window runs from the last partition to the first, so the nearest head comes last
            k = int(outputs[i][3])
            lists = F.reverse(F.collect_list(f"_h{i}").over(ahead.rowsBetween(-2 * k, -1)))
            nexts.append(F.slice(F.flatten(lists), 1, k).alias(f"_k{i}"))
    after = heads.select("_pid", "_gives", *nexts).filter(~F.col("_gives")).drop("_gives")
    fix = summary.select("_pid", "_first", "_last").join(before, "_pid", "left").join(after, "_pid", "left")

    # ---- apply: the first group may continue earlier partitions, the last one later ones
    out = s.join(F.broadcast(fix), "_pid", "left")
    cont_first = key_struct.eqNullSafe(F.col("_first")) & F.col("_k_cnt").isNotNull()
    cont_last = key_struct.eqNullSafe(F.col("_last")) & F.col("_k_next").isNotNull()
    carry = lambda c: F.when(cont_first, F.col(c)).otherwise(F.lit(0))
    cols = {}
    for i, (kind, name, col, k) in enumerate(outputs):
        if kind == "row_number":
            cols[name] = F.col("_lrn") + carry("_k_cnt")
        elif kind == "rank":
            cols[name] = F.col("_lrank") + carry("_k_cnt")
        elif kind == "dense_rank":
            cols[name] = F.col("_ldense") + carry("_k_dense")
        elif i in far and kind == "lag":
            back = F.size(f"_k{i}") - (int(k) - F.col("_lrn"))              # place among the carried rows, from 1
            cols[name] = F.when(cont_first & (F.col("_lrn") <= int(k)), F.get(f"_k{i}", back - 1)).otherwise(F.col(f"_o{i}"))
        elif i in far:
            on = F.col("_lrn") + int(k) - F.col("_lcnt")
            cols[name] = F.when(key_struct.eqNullSafe(F.col("_last")) & (on > 0), F.get(f"_k{i}", on - 1)).otherwise(F.col(f"_o{i}"))
        elif kind == "lag":
            cols[name] = F.when(cont_first & (F.col("_lrn") == 1), F.col("_k_last")[col]).otherwise(F.col(f"_o{i}"))
        elif kind == "lead":
            cols[name] = F.when(cont_last & (F.col("_lrn") == F.col("_lcnt")),
                                F.col("_k_next")[col]).otherwise(F.col(f"_o{i}"))
        elif kind.startswith("moving"):
            need = F.lit(int(k)) - F.col("_lrn") + 1            # carried rows still inside the frame
            carried = F.col(f"_k{i}")
            sl = F.when(cont_first & (need > 0),
                        F.slice(carried, F.greatest(F.size(carried) - need + 1, F.lit(1)), need))
            nn = F.coalesce(F.size(F.filter(sl, lambda x: x.isNotNull())), F.lit(0))
            if kind == "moving_count":
                cols[name] = F.col(f"_o{i}") + nn
            else:
                kind_of = total_type(col)
                zero = F.lit(0).cast(kind_of)
                part = F.coalesce(F.aggregate(sl, zero, lambda acc, x: (acc + F.coalesce(x, zero)).cast(kind_of)), zero)  # noqa: B023
                cols[name] = F.when(F.col(f"_o{i}").isNull() & (nn == 0), F.lit(None)).otherwise(
                    F.coalesce(F.col(f"_o{i}").cast(kind_of), zero) + part).cast(kind_of)
        else:
            kk = F.when(cont_first, F.col(f"_k{i}"))
            cols[name] = F.when(F.col(f"_o{i}").isNull() & kk.isNull(), F.lit(None)).otherwise(
                F.coalesce(F.col(f"_o{i}"), F.lit(0)) + F.coalesce(kk, F.lit(0))).cast(
                    total_type(col) if kind == "running_sum" else "bigint")
    out = out.withColumns(cols)
    keep = set(df.columns) | {name for _, name, _, _ in outputs}
    helper = [c for c in out.columns if c.startswith("_") and c not in keep]
    return out.drop(*helper)


def sequence_within_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                           rn_col: str = "row_number", lags: Mapping[str, str] | None = None,
                           desc_cols: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """Add ``rn_col`` (1-based position in the group by ``order``) and, for
    each ``{out: col}`` in ``lags``, the previous row's ``col`` in the group."""
    desc = set(desc_cols)
    ordering = [F.col(c).desc() if c in desc else F.col(c).asc() for c in order]
    outputs = [("row_number", rn_col)] + [("lag", out, c) for out, c in (lags or {}).items()]
    return split_window(df, keys, ordering, outputs, partitions=partitions)

"""Table history as DataFrame operations: upsert, as-of reads, change feeds,
retention.

A versioned table is kept as a *change log* — one row per (key, version)
with ``commit_ts``, ``op`` ('I' insert, 'U' update, 'D' delete) and the
payload columns.  Every operator below is a grouped aggregate or a join on
the key, so it partitions by key across the cluster; per-key "latest row"
picks use ``max_by`` (combined map-side) rather than a sort of each key's
history, which keeps a hot key from landing whole in one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _ts(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, dt.datetime):
        v = v.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(str(v)).cast("timestamp_ntz")


def merge_upsert(target: DataFrame, source: DataFrame, key: str | Sequence[str],
                 check_unique: bool = True) -> DataFrame:
    """MERGE: matched → source row, not matched → insert, target-only kept.

    ``target ⟕anti source ∪ source``: one shuffle join on the key.  A NULL
    key never matches, so such source rows are inserted.  The source keys are
    verified first (one aggregate job); ``check_unique=False`` is for sources
    known to be unique.
    """
    keys = _keys(key)
    if check_unique:
        if not source.dropna(subset=keys).groupBy(*keys).count().filter("count > 1").isEmpty():
            raise ValueError("merge source has duplicate keys")
    kept = target.join(source.select(*keys).filter(
        " and ".join(f"`{k}` is not null" for k in keys)), keys, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def latest_state(log: DataFrame, key: str | Sequence[str], version: int | None = None,
                 timestamp=None, version_col: str = "version", ts_col: str = "commit_ts",
                 op_col: str = "op") -> DataFrame:
    """Table state as of ``version`` (wins when both are given) or
    ``timestamp``; deleted keys are dropped.  Without either: latest state."""
    keys = _keys(key)
    if version is not None:
        log = log.filter(F.col(version_col) <= F.lit(int(version)))
    elif timestamp is not None:
        log = log.filter(F.col(ts_col) <= _ts(timestamp))
    payload = [c for c in log.columns if c not in keys]
    last = log.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in payload]), F.col(version_col)).alias("_r"))
    out = last.select(*keys, *[F.col("_r")[c].alias(c) for c in payload])
    return out.filter(F.col(op_col) != "D").drop(op_col, version_col, ts_col)


def retention(log: DataFrame, key: str | Sequence[str], horizon, dry_run: bool = False,
              version_col: str = "version", ts_col: str = "commit_ts") -> DataFrame:
    """Drop history older than ``horizon`` without changing any state at or
    after it: per key keep the newest row at or before the horizon and every
    later row.  ``dry_run=True`` returns the rows that would be removed."""
    keys = _keys(key)
    floor = (log.filter(F.col(ts_col) <= _ts(horizon)).groupBy(*keys)
             .agg(F.max(version_col).alias("_floor")))
    tagged = log.join(floor, keys, "left").withColumn(
        "_keep", F.col("_floor").isNull() | (F.col(version_col) >= F.col("_floor")))
    out = tagged.filter(~F.col("_keep") if dry_run else F.col("_keep"))
    return out.drop("_floor", "_keep")


def retention_hours(log: DataFrame, key, now, retention_hours: int = 168, dry_run: bool = False,
                    **kw) -> DataFrame:
    """``retention`` with the horizon given as ``now`` − hours (default 7 days)."""
    if isinstance(now, dt.datetime):
        horizon = now - dt.timedelta(hours=retention_hours)
    else:
        horizon = _ts(now) - F.make_dt_interval(F.lit(0), F.lit(retention_hours))
    return retention(log, key, horizon, dry_run=dry_run, **kw)


CHANGE_TYPES = ("insert", "delete", "update_preimage", "update_postimage")


def change_feed(old: DataFrame, new: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Row-level changes from snapshot ``old`` to snapshot ``new``.

    One full outer join on the key; a row counts as updated when any
    non-key column differs (NULL-safe).  Output: the columns of ``new`` plus
    ``_change_type``; an update gives a pre-image and a post-image row.
    """
    keys = _keys(key)
    cols = [c for c in new.columns if c not in keys]
    o = old.select(*keys, F.struct(*[F.col(c) for c in cols]).alias("_o"), F.lit(True).alias("_in_o"))
    n = new.select(*keys, F.struct(*[F.col(c) for c in cols]).alias("_n"), F.lit(True).alias("_in_n"))
    j = o.join(n, keys, "full")
    differs = F.lit(False)
    for c in cols:
        differs = differs | ~F.col(f"_o.{c}").eqNullSafe(F.col(f"_n.{c}"))
    images = (
        F.when(F.col("_in_o").isNull(), F.array(F.struct(F.lit("insert").alias("t"), F.col("_n").alias("v"))))
        .when(F.col("_in_n").isNull(), F.array(F.struct(F.lit("delete").alias("t"), F.col("_o").alias("v"))))
        .when(differs, F.array(F.struct(F.lit("update_preimage").alias("t"), F.col("_o").alias("v")),
                               F.struct(F.lit("update_postimage").alias("t"), F.col("_n").alias("v"))))
    )
    ex = j.select(*keys, F.explode(images).alias("_c"))
    return ex.select(*keys, *[F.col(f"_c.v.{c}").alias(c) for c in cols], F.col("_c.t").alias("_change_type"))


def apply_change_feed(old: DataFrame, feed: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Replay a change feed onto ``old`` (inverse of ``change_feed``)."""
    keys = _keys(key)
    touched = feed.filter(F.col("_change_type").isin("delete", "update_preimage")).select(*keys)
    kept = old.join(touched, keys, "left_anti")
    added = feed.filter(F.col("_change_type").isin("insert", "update_postimage")).drop("_change_type")
    return kept.unionByName(added)


def merge_into_log(spark, log_path: str, source: DataFrame, key: str | Sequence[str], commit_ts,
                   version_col: str = "version", ts_col: str = "commit_ts", op_col: str = "op") -> DataFrame:
    """MERGE into a stored, versioned table (a change log at ``log_path``).

    The source rows are appended as the next version: 'U' for keys present
    in the current state, 'I' for new ones (one join on the key against the
    latest state).  Earlier versions stay readable with ``latest_state``
    (time travel); the returned frame is the new latest state.  The append is
    one write job into the version's own partition directory.
    """
    keys = _keys(key)
    try:
        log = spark.read.parquet(log_path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        log = None
    if log is not None:
        current_version = log.agg(F.max(version_col)).collect()[0][0] or 0
        present = latest_state(log, keys, version_col=version_col, ts_col=ts_col, op_col=op_col) \
            .select(*keys).withColumn("_present", F.lit(True))
        tagged = source.join(present, keys, "left")
        op = F.when(F.col("_present"), F.lit("U")).otherwise(F.lit("I"))
    else:                                          # no table yet: everything is an insert
        current_version, tagged, op = 0, source.withColumn("_present", F.lit(None)), F.lit("I")
    rows = tagged.select(*keys, F.lit(current_version + 1).alias(version_col), _ts(commit_ts).alias(ts_col),
                         op.alias(op_col), *[c for c in source.columns if c not in keys])
    rows.write.mode("append").partitionBy(version_col).parquet(log_path)
    return latest_state(spark.read.parquet(log_path), keys, version_col=version_col, ts_col=ts_col, op_col=op_col)

"""Table readers: by path (latest), as of a version or time, with or without
schema merging; entity loads with a required-column check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tillpoint.functions.validators import require_columns
from tillpoint.operators.history import latest_state


def scan_table(spark: SparkSession, path: str, fmt: str = "parquet", schema_evolution: bool = True,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Lazy scan; projections and filters applied later reach the file scan
    (``PushedFilters`` / ``ReadSchema`` in the plan)."""
    reader = spark.read.format(fmt)
    if fmt == "parquet":
        reader = reader.option("mergeSchema", "true" if schema_evolution else "false")
    df = reader.load(path)
    return df.select(*columns) if columns else df


def read_as_of(spark: SparkSession, log_path: str, key, version: int | None = None, timestamp=None,
               fmt: str = "parquet") -> DataFrame:
    """State of a change-log table as of ``version`` (preferred) or
    ``timestamp`` (datetime or 'YYYY-MM-DD HH:MM:SS')."""
    return latest_state(spark.read.format(fmt).load(log_path), key, version=version, timestamp=timestamp)


def union_evolving(frames: Sequence[DataFrame]) -> DataFrame:
    """Union frames whose schemas grew over time (missing columns → NULL)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def load_entity(df: DataFrame, required: Sequence[str], what: str = "entity") -> DataFrame:
    return require_columns(df, required, what)

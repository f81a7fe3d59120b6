"""Helpers shared by the training-data operators."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of words: space and the five control characters from tab to carriage return (fixed values).
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Let at most ``rows`` rows go to a Python worker at once (for the session): texts may be long."""
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(conf)) <= rows:
        spark.conf.set(conf, str(rows))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Working-column names that no column of ``df`` has (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns whose name an operator's result column takes over."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def text_of(df: DataFrame, col: str) -> Column:
    """The column as text; a null is an empty text."""
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def unit_hash(*cols: Column, seed: int) -> Column:
    """A number in [0, 1) drawn by the hash of the columns and the seed (53 bits)."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11).cast("double") / F.lit(float(1 << 53))


def literal(value, ddl: str) -> Column:
    """A nested constant as one literal; for values of bounded size only."""
    return F.from_json(F.lit(json.dumps({"v": value})), f"v {ddl}")["v"]

"""Warehouse connector over JDBC (read a table or a query; write with batch
size and string length options).

Spark's JDBC source partitions reads by ``partitionColumn`` bounds and
pushes filters and projections into the database; writes run one
connection per task with ``batchsize``-row batches.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType

DEFAULT_WRITE_OPTIONS = {"batchsize": "100000"}


def string_column_types(df: DataFrame, max_len: int) -> str:
    """``createTableColumnTypes`` clause giving every string column VARCHAR(max_len)."""
    return ", ".join(f"{f.name} VARCHAR({int(max_len)})" for f in df.schema.fields
                     if isinstance(f.dataType, StringType))


def write_options(df: DataFrame, url: str, table: str, options: Mapping[str, str] | None = None) -> dict[str, str]:
    """Defaults, then caller options (caller wins); ``maxStrLength`` and
    ``batchSize`` spellings are mapped to Spark's option names."""
    opts = {"url": url, "dbtable": table, **DEFAULT_WRITE_OPTIONS}
    for k, v in (options or {}).items():
        if k.lower() == "maxstrlength":
            cols = string_column_types(df, int(v))
            if cols:
                opts["createTableColumnTypes"] = cols
        elif k.lower() == "batchsize":
            opts["batchsize"] = str(v)
        else:
            opts[k] = str(v)
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite",
               options: Mapping[str, str] | None = None) -> None:
    if mode not in ("overwrite", "append"):
        raise ValueError(f"write mode {mode!r} is not known")
    df.write.format("jdbc").options(**write_options(df, url, table, options)).mode(mode).save()


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              options: Mapping[str, str] | None = None) -> DataFrame:
    """Read a table, or the result of ``query`` (wrapped as a derived table,
    which every JDBC database accepts)."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    source = table if table is not None else f"({query}) q"
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", source)
    for k, v in (options or {}).items():
        reader = reader.option(k, str(v))
    return reader.load()

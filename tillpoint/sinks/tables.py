"""Table writers: overwrite / append / partitioned / dynamic partition
overwrite, compaction, catalog tables with properties, parquet export.

Paths are whatever the caller gives (a shared file system or object store on
a cluster).  Writes are plain DataFrame writer jobs: each task writes its own
files and Spark's commit protocol makes the job atomic per attempt, so a lost
executor only re-runs its tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType
from pyspark.sql.utils import AnalysisException

WRITE_MODES = ("overwrite", "append")


def _existing_schema(spark: SparkSession, path: str, fmt: str):
    try:
        return spark.read.format(fmt).load(path).schema
    except AnalysisException:
        return None


def read_if_any(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None where there is none yet."""
    schema = _existing_schema(spark, path, fmt)
    return None if schema is None else spark.read.format(fmt).schema(schema).load(path)


def _shape(schema, partition_by: Sequence[str] | None):
    """Data columns with their types, in order, and partition columns by name (their types are
    inferred from directory names when a table is read)."""
    keys = set(partition_by or [])
    return [(f.name, f.dataType) for f in schema.fields if f.name not in keys], sorted(
        f.name for f in schema.fields if f.name in keys)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] | None = None,
                fmt: str = "parquet", overwrite_schema: bool = False, dynamic_partitions: bool = False,
                compact_files: int | None = None, options: Mapping[str, str] | None = None) -> None:
    """Write ``df`` to ``path``.

    * ``mode`` — "overwrite" or "append";
    * ``partition_by`` — Hive-style directories (derive e.g. year/month first);
    * ``dynamic_partitions`` — overwrite only the partitions present in ``df``;
    * ``overwrite_schema`` — an overwrite may change the schema only when set
      (otherwise a differing schema raises, like a table format would);
    * ``compact_files`` — write about that many files per partition value
      (repartition by the partition columns; AQE sizes the rest).
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode {mode!r} is none of {sorted(WRITE_MODES)}")
    spark = df.sparkSession
    if mode == "overwrite" and not overwrite_schema:
        old = _existing_schema(spark, path, fmt)
        if old is not None and _shape(old, partition_by) != _shape(df.schema, partition_by):
            raise ValueError("schema differs from the existing table; pass overwrite_schema=True")
    if compact_files:
        cols = list(partition_by or [])
        # from the row itself, not at random: a repeated task must deal its rows alike
        plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
        salt = F.pmod(F.xxhash64(*plain), F.lit(compact_files))
        df = df.repartition(*(F.col(c) for c in cols), salt) if cols else df.repartition(compact_files)
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode == "overwrite":   # whatever the session says: a partition without rows in ``df`` must not survive
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic_partitions else "static")
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save(path)


def compact(spark: SparkSession, src: str, dst: str, files: int, partition_by: Sequence[str] | None = None,
            fmt: str = "parquet") -> None:
    """Rewrite the table at ``src`` into ``dst`` with fewer, larger files.

    (A path cannot be overwritten while it is being read; callers swap the
    locations afterwards.)
    """
    df = spark.read.format(fmt).load(src)
    write_table(df, dst, "overwrite", partition_by=partition_by, fmt=fmt, compact_files=files)


def small_file_bins(spark: SparkSession, path: str, target_bytes: int) -> list[list[tuple[str, str]]]:
    """Groups of small files to become one file each: files of one folder, first fit by falling size, at most
    ``target_bytes`` together; each file as its path and its URI.  Files of ``target_bytes`` or more and lone small files are left alone.

    Sizes come from the file listing; no file is opened.
    """
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
              .select("path", "length", F.col("_metadata.file_path").alias("uri")).filter(F.col("length") < target_bytes).collect())     # file names, as any listing holds
    folders: dict[str, list] = {}
    for f in listed:
        folders.setdefault(f["path"].rpartition("/")[0], []).append((f["length"], f["path"], f["uri"]))
    bins = []
    for _, files in sorted(folders.items()):
        own: list[list] = []
        for size, name, uri in sorted(files, key=lambda x: (-x[0], x[1])):
            room = next((b for b in own if b[0] + size <= target_bytes), None)
            if room is None:
                own.append([size, [(name, uri)]])
            else:
                room[0] += size
                room[1].append((name, uri))
        bins += [names for _, names in own if len(names) > 1]
    return bins


def rows_by_bin(spark: SparkSession, path: str, bins: list[list[tuple[str, str]]]) -> DataFrame:
    """The rows of the bins' files, those of bin k in partition k: its task writes them as they stream in, without a sort."""
    of_file = spark.createDataFrame([(uri, k) for k, names in enumerate(bins) for _, uri in names], "_file string, _bin int")
    rows = spark.read.option("basePath", path).parquet(*[n for names in bins for n, _ in names])
    schema = spark.read.parquet(bins[0][0][0]).columns
    # one row per listed file: the mapping is as small as the listing
    tagged = rows.select(*[F.col(f"`{c}`") for c in schema], F.col("_metadata.file_path").alias("_path")).join(
        F.broadcast(of_file), F.col("_path") == F.col("_file")).drop("_path", "_file")
    return tagged.repartitionById(len(bins), "_bin").drop("_bin")


def compact_small_files(spark: SparkSession, path: str, target_bytes: int = 128 << 20) -> dict[str, int]:
    """Pack the small files of the parquet table at ``path`` into files of about ``target_bytes``, in place.

    Only files that share a bin are rewritten; the others keep their names.  The new files are written whole into a folder
    that readers don't see, then moved beside the old ones, and only then are the old ones removed, so a failure loses no row;
    like any rewrite in place it must not run beside readers or writers.  Returns how many files were packed and made.
    """
    bins = small_file_bins(spark, path, target_bytes)
    if not bins:
        return {"packed": 0, "made": 0}
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(conf)
    staging = f"{path.rstrip('/')}/_compact-{uuid.uuid4().hex[:12]}"
    rows_by_bin(spark, path, bins).write.parquet(staging)        # a file's name begins with its task's number: the bin
    made = 0
    for f in fs.globStatus(at(f"{staging}/part-*")):
        folder = bins[int(f.getPath().getName().split("-")[1])][0][0].rpartition("/")[0]
        if not fs.rename(f.getPath(), at(f"{folder}/part-{uuid.uuid4().hex}.parquet")):
            raise OSError(f"{f.getPath()} could not be moved into {folder}")
        made += 1
    for names in bins:
        for name, _ in names:
            fs.delete(at(name), False)
    fs.delete(at(staging), True)
    return {"packed": sum(map(len, bins)), "made": made}


def export_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                   mode: str = "overwrite", compression: str = "snappy") -> None:
    writer = df.write.format("parquet").option("compression", compression).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def create_table(df: DataFrame, table: str, database: str = "default", path: str | None = None,
                 partition_by: Sequence[str] | None = None, properties: Mapping[str, str] | None = None,
                 comment: str | None = None, overwrite: bool = False, fmt: str = "parquet") -> str:
    """Create a catalog table from ``df``'s schema and insert ``df``.

    The column list is explicit (a partitioned table cannot be created
    without one); replacing drops the old definition first.  ``insertInto``
    is positional, so columns are reordered with partition columns last.
    Returns the qualified table name.
    """
    spark = df.sparkSession
    parts = list(partition_by or [])
    name = f"{_quote(database)}.{_quote(table)}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quote(database)}")
    if overwrite:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    data_cols = [f for f in df.schema.fields if f.name not in parts]
    part_cols = [df.schema[p] for p in parts]
    cols = ", ".join(f"{_quote(f.name)} {f.dataType.simpleString()}" for f in data_cols + part_cols)
    stmt = f"CREATE TABLE {'' if overwrite else 'IF NOT EXISTS '}{name} ({cols}) USING {fmt}"
    if parts:
        stmt += f" PARTITIONED BY ({', '.join(_quote(p) for p in parts)})"
    if path:
        stmt += f" LOCATION '{path}'"
    if comment:
        stmt += " COMMENT '" + comment.replace("'", "\\'") + "'"
    if properties:
        stmt += " TBLPROPERTIES (" + ", ".join(f"'{k}' = '{v}'" for k, v in properties.items()) + ")"
    spark.sql(stmt)
    ordered = df.select(*[F.col(f.name) for f in data_cols + part_cols])
    ordered.write.insertInto(f"{database}.{table}", overwrite=overwrite)
    return f"{database}.{table}"


def set_table_properties(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    if properties:
        props = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({props})")


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}

"""Session helpers.

The library never builds its own cluster configuration: callers hand in a
``SparkSession``.  ``local_session`` exists for tests, the benchmark and
notebooks on one machine; ``shared_dir`` resolves the folder in which jobs may
write intermediate tables (lineage cuts, round-trip tables).  On a cluster that
folder is whatever ``spark.checkpoint.dir`` names; a machine-local temporary
folder is only created when the setting is absent (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tillpoint",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local[N] session with the settings the library is tested under."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TILLPOINT_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, shared by all executors.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    on a local master (single-machine runs, tests) a private temporary folder
    is created and registered, so that later calls and
    ``DataFrame.checkpoint`` agree; on a cluster that raises.
    """
    d = spark.conf.get(CHECKPOINT_CONF, None)
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not d and jdir.isDefined():
        d = jdir.get()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tillpoint-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, d)
    if not jdir.isDefined():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: a lineage cut whose later reads take
    only the columns they need.  Rows of types that Parquet doesn't hold are checkpointed instead."""
    text = df.schema.simpleString()
    if any(kind in text for kind in ("void", "interval", "variant")) or len({c.lower() for c in df.columns}) < len(df.columns):
        return cut_lineage(df)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable lineage cut: materialise to the shared checkpoint folder.

    Used by iterative operators so that a lost executor recomputes one round,
    not the whole history.  (Never a local checkpoint: those die with the
    executor that holds them.)
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)

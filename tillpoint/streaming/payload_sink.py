"""A stream sink for JSON payloads with one commit per epoch.

Tasks write their rows as files of their own; the driver's commit of an epoch is
one small manifest that names them.  A reader takes only files that a manifest
names, so a failed attempt leaves nothing behind that counts, and an epoch that
runs again (after a restart between the sink's commit and the stream's own log)
finds its manifest and adds nothing.

Files are reached through ``pyarrow.fs`` by URI, so the folder may be any store that
all executors share.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "payload_log"


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


class PayloadWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One file a task: a payload per line (line ends inside a payload stand as JSON writes them)."""
        store, root = _open(self.path)
        name, rows, out = f"{uuid.uuid4().hex}.jsonl", 0, None
        for batch in iterator:
            values = [v for v in batch.column("value").to_pylist() if v is not None]
            if not values:
                continue
            if out is None:
                store.create_dir(f"{root}/data", recursive=True)
                out = store.open_output_stream(f"{root}/data/{name}")
            out.write("".join(v + "\n" for v in values).encode())
            rows += len(values)
        if out is not None:
            out.close()
        return Written(name if out is not None else None, rows)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        store, root = _open(self.path)
        manifest = f"{root}/epochs/{batchId:020d}.json"
        if store.get_file_info(manifest).type != pafs.FileType.NotFound:
            self.abort(messages, batchId)          # this epoch has been committed before
            return
        store.create_dir(f"{root}/epochs", recursive=True)
        files = {m.file: m.rows for m in messages if m is not None and m.file}
        draft = f"{root}/epochs/.{batchId}-{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as out:
            out.write(json.dumps({"epoch": batchId, "files": files}).encode())
        store.move(draft, manifest)                # a manifest is there whole or not at all

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        store, root = _open(self.path)
        for m in messages:
            if m is not None and m.file and store.get_file_info(f"{root}/data/{m.file}").type != pafs.FileType.NotFound:
                store.delete_file(f"{root}/data/{m.file}")


class PayloadLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def streamWriter(self, schema: StructType, overwrite: bool) -> PayloadWriter:
        if "value" not in schema.names:
            raise ValueError("the payload sink writes a column named value")
        if "path" not in self.options:
            raise ValueError("the payload sink needs a path")
        return PayloadWriter(self.options["path"])


def run_to_payload_log(payload: DataFrame, path: str, checkpoint: str, output_mode: str = "append") -> None:
    """Write a streaming frame's ``value`` column into the log at ``path``, over everything available now."""
    payload.sparkSession.dataSource.register(PayloadLog)
    q = (payload.writeStream.format(FORMAT).option("path", path).option("checkpointLocation", checkpoint)
         .outputMode(output_mode).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def committed_files(path: str) -> dict[str, int]:
    """Names and row counts of the files that manifests name."""
    store, root = _open(path.rstrip("/"))
    out: dict[str, int] = {}
    for info in store.get_file_info(pafs.FileSelector(f"{root}/epochs", allow_not_found=True)):
        if info.is_file and not info.base_name.startswith("."):
            with store.open_input_stream(info.path) as f:
                out |= json.loads(f.read())["files"]
    return out


def read_payload_log(spark: SparkSession, path: str) -> DataFrame:
    """The committed payloads (value string)."""
    files = [f"{path.rstrip('/')}/data/{name}" for name in sorted(committed_files(path))]
    return spark.read.text(files) if files else spark.createDataFrame([], "value string")

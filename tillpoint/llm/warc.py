"""WARC archives as a PySpark Python data source (format name ``warc``).

Reading: files are packed into partitions of about ``partitionBytes``.  Pushed
filters on header columns (record type, ids, target, date, digest, length) are
tested on a record's headers, which are parsed from the first inflated bytes; a
record that fails, or a read whose schema doesn't name ``payload``, never
inflates the rest.  Records are gzip members of their own; the ``sl``
(skip-lengths) extra field of the WARC format names a member's length, so the
reader seeks to the next member; without it the member is inflated and thrown
away.  Plain ``.warc`` files are skipped by Content-Length.

Writing: every task writes files of up to ``fileBytes`` under names of its own;
the commit lists the files of successful tasks in a manifest, and readers of a
folder with manifests see those files only: a lost or repeated task leaves no
record behind.

Files go through ``pyarrow.fs`` (local paths and file:, hdfs:, s3: and gs: URIs).
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tillpoint.llm.common import fresh, text_of
from tillpoint.session import scratch_path

SCHEMA = ("record_id string, type string, target_uri string, date string, content_type string, payload_digest string, "
          "payload_length long, refers_to string, headers map<string,string>, payload binary")
#: Header names of the columns (fixed values of the format; the payload length is a field of our own).
HEADERS = {"record_id": "WARC-Record-ID", "type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
           "content_type": "Content-Type", "payload_digest": "WARC-Payload-Digest", "payload_length": "X-Payload-Length",
           "refers_to": "WARC-Refers-To"}
VERSION = b"WARC/1.1\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
HEAD = 2048


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


# ---------------------------------------------------------------- one record

def record(row: dict) -> bytes:
    """A record's bytes, uncompressed: headers, block, two line ends."""
    kind, payload = row["type"], row.get("payload")
    clean = {k: str(v).replace("\r", "%0D").replace("\n", "%0A") for k, v in row.items() if k in HEADERS and v is not None}
    if kind == "response":
        payload = payload or b""
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
        clean["content_type"] = "application/http; msgtype=response"
    elif kind == "revisit":
        block = b"HTTP/1.1 200 OK\r\n\r\n"
        clean["content_type"] = "application/http; msgtype=response"
    else:
        block = payload or b""
    if "payload_digest" in clean:
        clean["payload_digest"] = "sha1:" + base64.b32encode(bytes.fromhex(clean["payload_digest"])).decode()
    lines = [f"{HEADERS[k]}: {v}" for k, v in clean.items()]
    if kind == "revisit":
        lines.append(f"WARC-Profile: {SAME_PAYLOAD}")
    lines.append(f"Content-Length: {len(block)}")
    return VERSION + "\r\n".join(lines).encode() + END + block + END


def member(data: bytes, level: int) -> bytes:
    """``data`` as a gzip member whose ``sl`` field holds the member's and the data's length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF if size < 1 << 32 else 0, len(data) & 0xFFFFFFFF)
    return (b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H", len(extra)) + extra + body
            + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


def _parse(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, sep, value = line.partition(":")
        if sep:
            out[name.strip().lower()] = value.strip()
    return out


def _row(headers: dict[str, str]) -> dict:
    out = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
    digest = out["payload_digest"]
    if digest and digest.lower().startswith("sha1:"):
        digest = digest[5:]
        out["payload_digest"] = digest.lower() if len(digest) == 40 else base64.b32decode(digest).hex()
    out["payload_length"] = int(out["payload_length"]) if (out["payload_length"] or "").isdigit() else None
    out["headers"] = headers
    return out


def _payload(block: bytes, headers: dict[str, str]) -> bytes:
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(END)[2]
    return block


# ---------------------------------------------------------------- one file

class _Gzip:
    """Walks the members of a gzip file; inflates a record's headers first and the rest on demand."""

    def __init__(self, f, size: int):
        self.f, self.size = f, size

    def __iter__(self) -> Iterator[tuple[dict[str, str], callable]]:
        at = 0
        while at < self.size:
            self.f.seek(at)
            raw = self.f.read(min(HEAD, self.size - at))
            start, length = self._front(raw)
            tool = zlib.decompressobj(-15)
            data, used = tool.decompress(raw[start:]), len(raw)
            end = data.find(END)
            while end < 0 and not tool.eof:
                more = self.f.read(HEAD)
                if not more:
                    raise ValueError("a record's headers don't end")
                used += len(more)
                data += tool.decompress(more)
                end = data.find(END)
            state = {"data": data, "tool": tool, "used": used}

            def rest(state=state, at=at) -> bytes:
                """All of the member's data; the state keeps where it ends."""
                self.f.seek(at + state["used"])
                parts = [state["data"]]
                while not state["tool"].eof:
                    more = self.f.read(1 << 20)
                    if not more:
                        raise ValueError("a member doesn't end")
                    state["used"] += len(more)
                    parts.append(state["tool"].decompress(more))
                state["data"] = b"".join(parts)
                return state["data"]

            headers = _parse(data[:end])
            body = end + len(END)
            yield headers, lambda rest=rest, body=body, n=int(headers.get("content-length", 0)): rest()[body:body + n]
            if length:
                at += length
            else:
                while not state["tool"].eof:   # no skip length: inflate and forget
                    self.f.seek(at + state["used"])
                    more = self.f.read(1 << 20)
                    state["used"] += len(more)
                    state["tool"].decompress(more)
                at += state["used"] - len(state["tool"].unused_data) + 8

    @staticmethod
    def _front(raw: bytes) -> tuple[int, int]:
        """Where the deflated data starts, and the member's length if its ``sl`` field tells."""
        if raw[:3] != b"\x1f\x8b\x08":
            raise ValueError("not a gzip member")
        flags, at, length = raw[3], 10, 0
        if flags & 4:
            n = struct.unpack_from("<H", raw, at)[0]
            extra, at = raw[at + 2:at + 2 + n], at + 2 + n
            while len(extra) >= 4:
                k = struct.unpack_from("<H", extra, 2)[0]
                if extra[:2] == b"sl" and k == 8:
                    length = struct.unpack_from("<I", extra, 4)[0]
                extra = extra[4 + k:]
        for bit in (8, 16):   # file name, comment
            if flags & bit:
                at = raw.index(b"\0", at) + 1
        return at + 2 * bool(flags & 2), length


class _Plain:
    def __init__(self, f, size: int):
        self.f, self.size = f, size

    def __iter__(self):
        at = 0
        while at < self.size:
            self.f.seek(at)
            data = self.f.read(HEAD)
            while data.find(END) < 0:
                more = self.f.read(HEAD)
                if not more:
                    raise ValueError("a record's headers don't end")
                data += more
            end = data.find(END)
            headers = _parse(data[:end])
            body, n = at + end + len(END), int(headers.get("content-length", 0))

            def block(body=body, n=n) -> bytes:
                self.f.seek(body)
                return self.f.read(n)

            yield headers, block
            at = body + n + len(END)


# ---------------------------------------------------------------- the source

@dataclass
class _Files(InputPartition):
    files: list[tuple[str, int]]

    def __init__(self, files):
        super().__init__(files)
        self.files = files


@dataclass
class _Written(WriterCommitMessage):
    files: list[str] = field(default_factory=list)


_TESTS = {
    EqualTo: lambda x, v: x is not None and x == v, EqualNullSafe: lambda x, v: x == v, GreaterThan: lambda x, v: x is not None and x > v,
    GreaterThanOrEqual: lambda x, v: x is not None and x >= v, LessThan: lambda x, v: x is not None and x < v,
    LessThanOrEqual: lambda x, v: x is not None and x <= v, In: lambda x, v: x is not None and x in v,
    StringStartsWith: lambda x, v: x is not None and x.startswith(v), StringEndsWith: lambda x, v: x is not None and x.endswith(v),
    IsNull: lambda x, v: x is None, IsNotNull: lambda x, v: x is not None,
}


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, options: dict):
        self.path, self.schema, self.tests = path, schema, []
        self.partition_bytes = int(options.get("partitionBytes", options.get("partitionbytes", 64 << 20)))

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            kind, turned = type(f), False
            inner = f
            if kind is Not:
                inner, turned = f.child, True
                kind = type(inner)
            if turned or kind not in _TESTS or len(inner.attribute) != 1 or inner.attribute[0] not in HEADERS:
                yield f   # Spark applies it
            else:
                self.tests.append((inner.attribute[0], kind.__name__, getattr(inner, "value", None)))

    def partitions(self):
        store, root = _open(self.path)
        info = store.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        if info.type == fs.FileType.File:
            found = [info]
        else:
            inside = [x for x in store.get_file_info(fs.FileSelector(root)) if x.type == fs.FileType.File]
            lists = [x for x in inside if x.base_name.startswith("_manifest-")]
            listed = set()
            for x in lists:
                with store.open_input_stream(x.path) as f:
                    listed |= set(json.loads(f.read()))
            found = [x for x in inside if x.base_name.endswith((".warc", ".warc.gz")) and (not lists or x.base_name in listed)]
        out, load = [], 0
        for x in sorted(found, key=lambda x: x.path):
            if not out or load + x.size > self.partition_bytes:
                out.append([])
                load = 0
            out[-1].append((x.path, x.size))
            load += x.size
        return [_Files(files) for files in out] or [_Files([])]

    def read(self, partition):
        store, _ = _open(self.path)
        by_name = {k.__name__: t for k, t in _TESTS.items()}
        tests = [(c, by_name[k], v) for c, k, v in self.tests]
        names = self.schema.names
        want = "payload" in names
        arrow = _arrow(self.schema)
        rows, load = [], 0
        for path, size in partition.files:
            with store.open_input_file(path) as f:
                for headers, block in (_Gzip if path.endswith(".gz") else _Plain)(f, size):
                    row = _row(headers)
                    if not all(t(row[c], v) for c, t, v in tests):
                        continue
                    if want:
                        row["payload"] = _payload(block(), headers)
                        load += len(row["payload"])
                    row["headers"] = list(headers.items()) if "headers" in names else None
                    rows.append([row[n] for n in names])
                    if len(rows) >= 5000 or load >= 16 << 20:
                        yield _batch(rows, arrow)
                        rows, load = [], 0
        if rows:
            yield _batch(rows, arrow)


def _arrow(schema: StructType) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "map<string,string>": pa.map_(pa.string(), pa.string())}
    known = dict(column.replace(" long", " bigint").split() for column in SCHEMA.split(", "))
    for f in schema:
        if known.get(f.name) != f.dataType.simpleString():
            raise ValueError(f"no column {f.name} {f.dataType.simpleString()}; the columns are {SCHEMA}")
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema])


def _batch(rows: list[list], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, options: dict):
        self.path = path
        self.level = int(options.get("level", 3))
        self.file_bytes = int(options.get("fileBytes", options.get("filebytes", 64 << 20)))

    def write(self, iterator):
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        made, out = [], None
        try:
            for batch in iterator:
                for k in range(batch.num_rows):
                    row = {n: batch.column(j)[k].as_py() for j, n in enumerate(batch.schema.names)}
                    if out is None or out.tell() >= self.file_bytes:
                        if out is not None:
                            out.close()
                        made.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out = store.open_output_stream(f"{root}/{made[-1]}", compression=None)
                    out.write(member(record(row), self.level))
        finally:
            if out is not None:
                out.close()
        return _Written(made)

    def commit(self, messages):
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        with store.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json") as f:
            f.write(json.dumps(files).encode())

    def abort(self, messages):
        store, root = _open(self.path)
        for name in [f for m in messages if m is not None for f in m.files]:
            store.delete_file(f"{root}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"], schema, self.options)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("write archives into a folder of their own, in append mode")
        return WarcWriter(self.options["path"], self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# ---------------------------------------------------------------- archiving pages

def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 1000,
            date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One WARC record per page: of equal payloads of ``min_bytes`` or more, that of the largest id is the
    response and the others revisit it; all smaller ones are responses.

    Defined results: a null payload is an empty one; a null URL gives a record without target; pages that
    share the largest id and the payload are all responses; a null id never is the largest: such a page is a
    revisit if an equal payload has an id, else a response; other columns aren't looked at.
    """
    p_id, p_url, p_html, digest, size = fresh(pages, "p_id", "p_url", "p_html", "p_digest", "p_size")
    body = F.encode(text_of(pages, html_col), "UTF-8")
    rows = pages.select(F.col(f"`{id_col}`").alias(p_id), F.col(f"`{url_col}`").alias(p_url), text_of(pages, html_col).alias(p_html),
                        F.sha1(body).alias(digest), F.octet_length(text_of(pages, html_col)).cast("long").alias(size))
    first = (rows.filter(F.col(size) >= min_bytes).groupBy(F.col(digest).alias("g_digest"), F.col(size).alias("g_size"))
             .agg(F.max(p_id).alias("g_id"), F.count("*").alias("g_n")).filter("g_n > 1 and g_id is not null"))
    both = rows.join(first, (F.col(digest) == F.col("g_digest")) & (F.col(size) == F.col("g_size")), "left")
    again = F.col("g_id").isNotNull() & ~F.col(p_id).eqNullSafe(F.col("g_id"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    return both.select(
        urn(F.col(p_id)).alias("record_id"), F.when(again, "revisit").otherwise("response").alias("type"),
        F.col(p_url).cast("string").alias("target_uri"), F.lit(date).alias("date"), F.col(digest).alias("payload_digest"),
        F.col(size).alias("payload_length"), F.when(again, urn(F.col("g_id"))).alias("refers_to"),
        F.when(~again, F.encode(F.col(p_html), "UTF-8")).alias("payload"))


def write_archive(rows: DataFrame, path: str, **options) -> str:
    register(rows.sparkSession)
    rows.write.format("warc").options(**options).mode("append").save(path)
    return path


def read_archive(spark: SparkSession, path: str, columns: str = SCHEMA) -> DataFrame:
    """The archive's records with the columns named (a DDL string); only naming payload makes it be decoded."""
    register(spark)
    return spark.read.format("warc").schema(columns).load(path)


def archive_pages(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``pages`` as WARC records and read them back: record_id, type, refers_to, payload_bytes, payload_digest.

    Responses are read with their payload, whose length and SHA-1 are measured anew;
    revisits by their headers alone.
    """
    spark = pages.sparkSession
    path = write_archive(records(pages, **options), path or scratch_path(spark, "warc"))
    head = "record_id string, type string, refers_to string, payload_digest string, payload_length long"
    whole = (read_archive(spark, path, "record_id string, type string, refers_to string, payload binary").filter("type = 'response'")
             .select("record_id", "type", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"),
                     F.sha1("payload").alias("payload_digest")))
    again = (read_archive(spark, path, head).filter("type = 'revisit'")
             .select("record_id", "type", "refers_to", F.col("payload_length").alias("payload_bytes"), "payload_digest"))
    return whole.union(again)

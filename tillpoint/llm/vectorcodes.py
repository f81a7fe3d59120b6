"""Vector code compression: product codes from integer codebooks, fitted exactly.

Components become integers, vectors are cut into parts, and every part position
learns a codebook by rounds of assigning parts to their nearest entry and moving
entries to the floor of their parts' mean.

The parts of one position are sorted along a Hilbert curve and cut into flat
blocks, written once.  A block holds its parts as one integer matrix, the box
around them (smallest and largest value per component) and their sums.  In a
round, a block compares its box with all entries first: an entry farther from the
nearest corner of the box than some entry is from its farthest corner can't win
for any part of the block.  What is left is the block's shortlist.  A shortlist
of one moves the block's sums at once, without looking at its parts; otherwise an
integer kernel compares the parts with the shortlist only.  Boxes never decide
between entries that may tie, so results equal those of comparing everything.

Codebooks and the sums of a round (entries times components) are all that the
driver holds.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.session import scratch_path

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
BLOCK = 256
#: Components beyond this can't be squared and summed in 64 bits for every length of vector.
LARGEST = 1 << 24
_AXES, _BITS = 16, 63


@dataclass(frozen=True)
class Coded:
    """rows: the kept columns, codes (array<int>, an entry per part) and error; codebooks: per part its entries."""

    rows: DataFrame
    codebooks: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, comma-joined."""
        flat = ",".join(str(x) for book in self.codebooks for x in book.reshape(-1).tolist())
        return hashlib.sha256(flat.encode()).hexdigest()


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places of integer points (below 2^bits) on the Hilbert curve through their axes (axes times bits below 64)."""
    x = points.astype(np.int64).T.copy()
    axes, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:
        for i in range(axes):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn, q = np.zeros(x.shape[1], np.int64), top
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            key = key << 1 | (x[i] >> b) & 1
    return key


def _curve(parts: np.ndarray, middle: float, spread: float) -> np.ndarray:
    """Hilbert keys of parts; many components are averaged to a few axes (the key only orders)."""
    axes = min(parts.shape[1], _AXES)
    bits = min(8, _BITS // axes)
    groups = np.array_split(np.arange(parts.shape[1]), axes)
    low = np.stack([parts[:, g].mean(1) for g in groups], 1)
    cells = (low - (middle - 2 * spread)) / (4 * spread) * (1 << bits)
    return hilbert_keys(np.clip(cells, 0, (1 << bits) - 1).astype(np.int64), bits)


def shortlist(lo: np.ndarray, hi: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Per box the entries that may be nearest to one of its points (boxes x entries, boolean)."""
    below, above = lo[:, None] - book, book - hi[:, None]
    near = (np.maximum(np.maximum(below, above), 0) ** 2).sum(2)
    far = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(2)
    return near <= far.min(1)[:, None]


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each part's nearest row of ``book`` (ties: the first) and the squared distance; exact in 64 bits."""
    parts, book = parts.astype(np.int64), book.astype(np.int64)
    most = max(int(np.abs(parts).max(initial=0)), int(np.abs(book).max(initial=0)))
    if 4 * parts.shape[1] * most * most < 1 << 53:   # every number below is an integer that a double holds
        cross = (parts.astype(np.float64) @ book.T.astype(np.float64)).astype(np.int64)
    else:
        cross = parts @ book.T
    apart = (book * book).sum(1) - 2 * cross
    at = apart.argmin(1)
    return at, apart[np.arange(len(parts)), at] + (parts * parts).sum(1)


def _matrix(blobs, width: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), kind).reshape(-1, width)


_BLOCKS = "part int, n int, rids binary, parts binary, lo binary, hi binary, sums binary"


def _to_blocks(width: int, size: int):
    """Sorted rows (part, rid, v) to blocks of ``size`` rows of one part."""

    def cut(batches):
        held, held_part = [], None

        def block(rids, rows):
            wide = rows.astype(np.int64)
            return {"part": held_part, "n": len(rows), "rids": rids.tobytes(), "parts": rows.tobytes(), "lo": rows.min(0).tobytes(),
                    "hi": rows.max(0).tobytes(), "sums": wide.sum(0).tobytes()}

        kinds = pa.schema([("part", pa.int32()), ("n", pa.int32()), *[(c, pa.binary()) for c in ("rids", "parts", "lo", "hi", "sums")]])

        def drain(all_rows):
            if not held:
                return []
            rids, rows = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            full = len(rows) if all_rows else len(rows) // size * size
            held[:] = [(rids[full:], rows[full:])] if full < len(rows) else []
            return [block(rids[i:i + size], rows[i:i + size]) for i in range(0, full, size)]

        for batch in batches:
            part = batch.column("part").to_numpy()
            rids = batch.column("rid").to_numpy()
            rows = _matrix(batch.column("v").to_pylist(), width, np.int32)
            out = []
            for p in np.unique(part):
                if p != held_part:
                    out += drain(True)
                    held_part = int(p)
                held.append((rids[part == p], rows[part == p]))
            out += drain(False)
            if out:
                yield pa.RecordBatch.from_pylist(out, kinds)
        if out := drain(True):
            yield pa.RecordBatch.from_pylist(out, kinds)

    return cut


def _boxes(batch: pa.RecordBatch, books: list[np.ndarray]):
    """(part, shortlist) of every block of the batch."""
    part = batch.column("part").to_numpy()
    width = books[0].shape[1]
    lo, hi = (_matrix(batch.column(c).to_pylist(), width, np.int32).astype(np.int64) for c in ("lo", "hi"))
    listed: list = [None] * len(part)
    for p in np.unique(part):
        at = np.flatnonzero(part == p)
        for i in range(0, len(at), 64):
            found = shortlist(lo[at[i:i + 64]], hi[at[i:i + 64]], books[p])
            for j, row in zip(at[i:i + 64].tolist(), found):
                listed[j] = np.flatnonzero(row)
    return part.tolist(), listed


def _round(books: list[np.ndarray]):
    """Blocks to one row per part, entry and position: the sum and count of what the entry won in this task."""
    width = books[0].shape[1]

    def assign(batches):
        sums = np.zeros((len(books), len(books[0]), width), np.int64)
        count = np.zeros(sums.shape[:2], np.int64)
        for batch in batches:
            part, listed = _boxes(batch, books)
            total = _matrix(batch.column("sums").to_pylist(), width, np.int64)
            n = batch.column("n").to_numpy()
            for i, (p, few) in enumerate(zip(part, listed)):
                if len(few) == 1:
                    sums[p, few[0]] += total[i]
                    count[p, few[0]] += n[i]
                    continue
                rows = np.frombuffer(batch.column("parts")[i].as_py(), np.int32).reshape(-1, width)
                at = few[nearest(rows, books[p][few])[0]]
                np.add.at(sums[p], at, rows)
                np.add.at(count[p], at, 1)
        p, e = np.nonzero(count)
        at = np.repeat(np.arange(len(p)), width)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(p[at].astype(np.int32)), "entry": pa.array(e[at].astype(np.int32)),
            "pos": pa.array(np.tile(np.arange(width, dtype=np.int32), len(p))), "s": pa.array(sums[p, e].reshape(-1)), "n": pa.array(count[p, e][at])})

    return assign


def _final(books: list[np.ndarray]):
    """Blocks to (rid, part, entry, error)."""
    width = books[0].shape[1]

    def code(batches):
        for batch in batches:
            part, listed = _boxes(batch, books)
            out = []
            for i, (p, few) in enumerate(zip(part, listed)):
                rows = np.frombuffer(batch.column("parts")[i].as_py(), np.int32).reshape(-1, width)
                at, error = nearest(rows, books[p][few])
                out.append((np.frombuffer(batch.column("rids")[i].as_py(), np.int64), np.full(len(rows), p, np.int32), few[at].astype(np.int32), error))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["rid", "part", "entry", "error"])

    return code


def encode(df: DataFrame, keep: dict[str, Column], id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS,
           entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, block: int = BLOCK) -> Coded:
    """Codes of every row of ``df`` whose vector is whole, with the columns ``keep`` ({name: column}).

    Components x become floor(scale * x); each of the ``parts`` codebooks starts with its part of the ``entries``
    smallest ids.  A round assigns all parts to their nearest entry (squared Euclidean
    distance, ties to the lower index) and replaces entries by the floor of the mean; entries without parts
    stay.  After ``rounds`` rounds parts are assigned once more: codes, and error, the sum of squared distances.

    Defined results: rows whose vector is null, empty or holds a null or non-finite component are dropped;
    null ids count as the largest; of rows of equal id the smaller vector comes first; repeated rows are coded
    each; fewer rows than entries give a codebook of that size; an empty table gives an empty table and
    no codebooks; other columns aren't looked at.  Vectors of several lengths, a length that ``parts`` doesn't divide,
    and components of 2^24 or more after scaling raise ValueError.  ``keep`` must not use the names rid, codes, error.
    """
    spark = df.sparkSession
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    broken = F.exists(vector, lambda x: F.coalesce(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    whole = df.filter(vector.isNotNull()).filter((F.size(vector) > 0) & ~broken)
    ints = F.transform(vector, lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
    path = scratch_path(spark, "vectors")
    whole.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("id"), ints.alias("q"),
                 *[c.alias(n) for n, c in keep.items()]).write.parquet(path)   # numbers are fixed once written
    rows = spark.read.parquet(path)
    total = lambda f: F.aggregate("q", F.lit(0.0), lambda acc, x: acc + f(x))
    shape = rows.agg(F.min(F.size("q")).alias("least"), F.max(F.size("q")).alias("length"), F.max(F.array_max(F.transform("q", F.abs))).alias("top"),
                     F.sum(total(lambda x: x)).alias("s"), F.sum(total(lambda x: x * x)).alias("ss"), F.sum(F.size("q")).alias("n")).first()
    if shape["length"] is None:
        empty = rows.select(*keep, F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error"))
        return Coded(empty, [])
    if shape["least"] != shape["length"] or shape["length"] % parts:
        raise ValueError(f"vectors must have one length that {parts} divides: {shape['least']} to {shape['length']}")
    if shape["top"] >= LARGEST:
        raise ValueError(f"a component of {shape['top']:g} is out of range")
    width = shape["length"] // parts
    middle = shape["s"] / shape["n"]
    spread = max(1.0, max(0.0, shape["ss"] / shape["n"] - middle * middle) ** 0.5)

    first = rows.orderBy(F.asc_nulls_last("id"), "q").limit(entries).select("q").collect()
    start = np.array([r["q"] for r in first], np.int64)
    books = [start[:, p * width:(p + 1) * width].copy() for p in range(parts)]

    def explode(batches):
        for batch in batches:
            flat = batch.column("q").flatten().to_numpy().astype(np.int32).reshape(-1, parts, width)
            rid = batch.column("rid").to_numpy()
            for p in range(parts):
                own = np.ascontiguousarray(flat[:, p])
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(np.full(len(rid), p, np.int32)), "key": pa.array(_curve(own, middle, spread)), "rid": pa.array(rid),
                    "v": pa.array([x.tobytes() for x in own], pa.binary())})

    # the row number ends the key: parts of one place on the curve, copies above all, spread over ranges
    sorted_parts = (rows.select("rid", "q").mapInArrow(explode, "part int, key long, rid long, v binary")
                    .repartitionByRange("part", "key", "rid").sortWithinPartitions("part", "key", "rid"))
    block_path = scratch_path(spark, "vector-blocks")
    sorted_parts.select("part", "rid", "v").mapInArrow(_to_blocks(width, block), _BLOCKS).write.parquet(block_path)
    blocks = spark.read.parquet(block_path)

    for _ in range(rounds):
        moved = blocks.drop("rids").mapInArrow(_round(books), "part int, entry int, pos int, s long, n long")
        won = moved.groupBy("part", "entry", "pos").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).toPandas()   # one row per component of an entry
        books = [b.copy() for b in books]
        for p in range(parts):
            own = won[won["part"] == p]
            books[p][own["entry"].to_numpy(), own["pos"].to_numpy()] = own["s"].to_numpy(np.int64) // own["n"].to_numpy(np.int64)

    coded = blocks.select("part", "n", "rids", "parts", "lo", "hi").mapInArrow(_final(books), "rid long, part int, entry int, error long")
    per_row = coded.groupBy("rid").agg(*[F.max(F.when(F.col("part") == p, F.col("entry"))).alias(f"c{p}") for p in range(parts)], F.sum("error").alias("error"))
    per_row = per_row.select(F.col("rid").alias("coded"), F.array(*[f"c{p}" for p in range(parts)]).alias("codes"), "error")
    return Coded(rows.join(per_row, F.col("rid") == F.col("coded")).select(*keep, "codes", "error"), books)


def error_by(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` with label_error: the errors of all rows of the same label summed (nulls together)."""
    sums = rows.groupBy(F.col(label).alias("of")).agg(F.sum("error").alias("label_error"))
    return rows.join(sums, F.col(label).eqNullSafe(F.col("of"))).drop("of")

"""Incremental line dedup: sharded cuckoo filters over exact reference counts.

A line's key is the line without outer white space, A-Z lower-cased; it travels
as two 64-bit hashes.  The exact table holds, per key, how many documents have
it.  Keys of ``min_docs`` or more documents are *common* and sit in the cuckoo
filter of their shard (a hash of the key).  Adding documents raises counts,
deleting them lowers counts; keys that cross ``min_docs`` are inserted into, or
deleted from, their shard's filter, so the state after any series of additions
and deletions equals the state built from what remains.

To drop lines, the (document, key) rows of a shard meet its filter: almost all
lines of one document only end there.  Hits are confirmed against the exact
table, so a filter's false positives never cost a line.  A shard with more rows
than ``rows_per_task`` is dealt over several tasks by a hash of the document,
each with a copy of the filter: a line that a third of all documents hold is
spread like any other.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import SPACES, UPPER, fresh, literal, text_batches, text_of, without
from tillpoint.session import cut_lineage

MIN_DOCS = 10
SHARD_KEYS = 50_000
_LOWER = str.maketrans(UPPER, UPPER.lower())


class CuckooFilter:
    """16-bit fingerprints in buckets of four, two buckets a key; inserts, deletes and bulk lookups."""

    SLOTS = 4
    KICKS = 500

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 64
        while buckets * cls.SLOTS * 0.85 < keys:
            buckets *= 2
        return cls(np.zeros((buckets, cls.SLOTS), np.uint16))

    @classmethod
    def loads(cls, blob: bytes) -> CuckooFilter:
        return cls(np.frombuffer(blob, np.uint16).reshape(-1, cls.SLOTS).copy())

    def dumps(self) -> bytes:
        return self.table.tobytes()

    def places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints and both buckets of keys given as two int64 hashes."""
        mask = np.uint64(len(self.table) - 1)
        fp = np.maximum(k2.view(np.uint64) & np.uint64(0xFFFF), np.uint64(1))
        one = k1.view(np.uint64) & mask
        return fp.astype(np.uint16), one.astype(np.int64), (one ^ (self._jump(fp) & mask)).astype(np.int64)

    @staticmethod
    def _jump(fp):
        return (fp * np.uint64(0x5BD1E995)) >> np.uint64(3)

    def holds(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        fp, one, two = self.places(k1, k2)
        return (self.table[one] == fp[:, None]).any(1) | (self.table[two] == fp[:, None]).any(1)

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> bool:
        """Insert all keys; False when no place is left (the caller rebuilds a larger filter)."""
        mask = len(self.table) - 1
        pick = np.random.default_rng(len(k1))
        for fp, one, two in zip(*(x.tolist() for x in self.places(k1, k2))):
            if self._put(one, fp) or self._put(two, fp):
                continue
            at = two
            for _ in range(self.KICKS):
                slot = int(pick.integers(self.SLOTS))
                fp, self.table[at, slot] = int(self.table[at, slot]), fp
                at ^= ((fp * 0x5BD1E995) >> 3) & mask
                if self._put(at, fp):
                    break
            else:
                return False
        return True

    def _put(self, bucket: int, fp: int) -> bool:
        row = self.table[bucket]
        for s in range(self.SLOTS):
            if not row[s]:
                row[s] = fp
                return True
        return False

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        for fp, one, two in zip(*(x.tolist() for x in self.places(k1, k2))):
            for bucket in (one, two):
                found = np.flatnonzero(self.table[bucket] == fp)
                if len(found):
                    self.table[bucket, found[0]] = 0
                    break
            else:
                raise ValueError("a deleted key isn't in its filter")


def line_key(line: str) -> str:
    return line.strip(SPACES).translate(_LOWER)


def line_hash(key: str) -> int:
    """The first hash of a key, as Spark's xxhash64 gives it."""
    h = xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"), 42)
    return h - (1 << 64) if h >> 63 else h


def _keys(text: Column) -> Column:
    lines = F.split(text, "\n", -1)
    return F.transform(lines, lambda x: F.translate(F.btrim(x, F.lit(SPACES)), UPPER, UPPER.lower()))


def line_rows(docs: DataFrame, row_key: Column, text_col: str, min_chars: int) -> DataFrame:
    """(rk, k1, k2): every distinct key of every row, once per row."""
    keys = F.filter(F.array_distinct(_keys(text_of(docs, text_col))), lambda k: F.char_length(k) >= min_chars)
    each = docs.select(row_key.alias("rk"), F.explode(keys).alias("k"))
    return each.select("rk", F.xxhash64("k").alias("k1"), F.xxhash64(F.lit(7), "k").alias("k2"))


@dataclass(frozen=True)
class LineState:
    """refs: (k1, k2, n), documents per key; filters: (shard, keys, blob), one row a shard."""

    refs: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int = MIN_DOCS
    min_chars: int = 1
    text_col: str = "text"

    def shard(self) -> Column:
        return F.pmod(F.shiftright(F.col("k2"), 20), F.lit(self.shards)).cast("int")

    def _changed(self, docs: DataFrame, sign: int) -> LineState:
        rows = line_rows(docs, F.lit(0), self.text_col, self.min_chars)
        delta = rows.groupBy("k1", "k2").agg((F.count("*") * sign).alias("d"))
        if self.refs is None:
            both = delta.select("k1", "k2", F.lit(0).cast("long").alias("old"), "d")
        else:
            both = self.refs.select("k1", "k2", F.col("n").alias("old"), F.lit(0).cast("long").alias("d")).union(
                delta.select("k1", "k2", F.lit(0).cast("long"), "d")).groupBy("k1", "k2").agg(F.sum("old").alias("old"), F.sum("d").alias("d"))
        now = cut_lineage(both.select("k1", "k2", "old", (F.col("old") + F.col("d")).alias("n")))
        if not now.filter("n < 0").isEmpty():
            raise ValueError("more documents deleted than added")
        state = replace(self, refs=now.filter("n > 0").select("k1", "k2", "n"))
        return state._refiltered(now)

    def _refiltered(self, now: DataFrame) -> LineState:
        """Move the keys that crossed ``min_docs`` into or out of their shards' filters."""
        low = self.min_docs
        common = now.filter(F.col("n") >= low).count()
        need = max(8, -(-common // SHARD_KEYS))
        if self.filters is None or need > 2 * self.shards:   # first build, or many more keys than planned: deal anew
            state = replace(self, shards=need)
            crossed = now.filter(F.col("n") >= low).withColumn("old", F.lit(0).cast("long"))
            filters = None
        else:
            state, filters = self, self.filters
            crossed = now.filter((F.col("n") >= low) != (F.col("old") >= low))
        # a shard that loses its room is rebuilt from its counts, so every changed shard brings all its common keys along
        keys = now.filter((F.col("n") >= low) | (F.col("old") >= low)) if filters is not None else crossed
        keys = keys.select(state.shard().alias("shard"), "k1", "k2", (F.col("n") >= low).alias("has"),
                           ((F.col("n") >= low) != (F.col("old") >= low) if filters is not None else F.lit(True)).alias("moved"))
        spark = now.sparkSession
        if filters is None:
            filters = spark.range(state.shards).select(F.col("id").cast("int").alias("shard"), F.lit(0).cast("long").alias("keys"),
                                                       F.lit(None).cast("binary").alias("blob"))

        def refit(rows: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
            shard = int(old["shard"].iloc[0])
            blob = old["blob"].iloc[0]
            has, moved = rows["has"].to_numpy(bool), rows["moved"].to_numpy(bool)
            k1, k2 = rows["k1"].to_numpy(np.int64), rows["k2"].to_numpy(np.int64)
            ok = blob is not None
            if ok:
                f = CuckooFilter.loads(blob)
                f.delete(k1[moved & ~has], k2[moved & ~has])
                ok = f.insert(k1[moved & has], k2[moved & has])
            size = int(has.sum())
            while not ok:
                f = CuckooFilter.sized(max(64, size))
                ok = f.insert(k1[has], k2[has])
                size = size * 2 + 1
            return pd.DataFrame({"shard": [shard], "keys": [int(has.sum())], "blob": [f.dumps()]})

        fitted = keys.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(refit, "shard int, keys long, blob binary")
        return replace(state, filters=cut_lineage(fitted))

    def add(self, docs: DataFrame) -> LineState:
        """The state with every row of ``docs`` added as one document."""
        return self._changed(docs, 1)

    def remove(self, docs: DataFrame) -> LineState:
        """The state with every row of ``docs`` (added before) taken out."""
        return self._changed(docs, -1)

    def common_lines(self, docs: DataFrame, row_key: Column, rows_per_task: int = 20_000) -> DataFrame:
        """(rk, common): per row key the first hashes of its keys that ``min_docs`` or more documents hold."""
        load = {r["shard"]: r for r in self.refs.groupBy(self.shard().alias("shard")).agg(F.sum("n").alias("n")).collect()}
        held = {r["shard"]: r["keys"] for r in self.filters.select("shard", "keys").collect()}   # one row a shard
        per_task = {s: max(rows_per_task, 4 * held.get(s, 0)) for s in range(self.shards)}
        deals = literal([max(1, -(-(load[s]["n"] if s in load else 0) // per_task[s])) for s in range(self.shards)], "array<bigint>")
        of_shard = F.element_at(deals, F.col("shard") + 1)
        rows = (line_rows(docs, row_key, self.text_col, self.min_chars).withColumn("shard", self.shard())
                .withColumn("deal", F.pmod(F.xxhash64("rk", F.lit(3)), of_shard)))
        filters = self.filters.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), of_shard - 1)).alias("deal"), "blob")

        def screen(lines: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
            if not len(lines):
                return lines[["rk", "k1", "k2"]]
            hit = CuckooFilter.loads(found["blob"].iloc[0]).holds(lines["k1"].to_numpy(np.int64), lines["k2"].to_numpy(np.int64))
            return lines.loc[hit, ["rk", "k1", "k2"]]

        hits = rows.groupBy("shard", "deal").cogroup(filters.groupBy("shard", "deal")).applyInPandas(screen, "rk long, k1 long, k2 long")
        exact = self.refs.filter(F.col("n") >= self.min_docs).select(F.col("k1").alias("c1"), F.col("k2").alias("c2"))
        sure = hits.join(exact, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")))
        return sure.groupBy("rk").agg(F.collect_set("k1").alias("common"))


def empty_state(min_docs: int = MIN_DOCS, min_chars: int = 1, text_col: str = "text") -> LineState:
    return LineState(None, None, 8, min_docs, min_chars, text_col)


def _rebuilt(text: pd.Series, common: pd.Series) -> pd.DataFrame:
    out = []
    for t, c in zip(text, common):
        lines = t.split("\n")
        if c is None or not len(c):
            out.append((len(lines), 0, t))
            continue
        gone = set(c.tolist())
        left = [x for x in lines if not (k := line_key(x)) or line_hash(k) not in gone]
        out.append((len(lines), len(lines) - len(left), "\n".join(left)))
    return pd.DataFrame(out, columns=["n_lines", "n_dropped", "kept"])


def drop_common_lines(docs: DataFrame, state: LineState, id_col: str = "doc_id") -> DataFrame:
    """All rows and columns of ``docs`` with the common lines gone from the text, plus n_lines (before) and n_dropped.

    Defined results: a null or empty text is one empty line and gives an empty text;
    keys shorter than ``min_chars`` stay; repeated rows are documents of their own
    and come back alike; an empty table gives an empty table; input columns named
    n_lines or n_dropped are replaced.  The row key is a hash of id and text: rows
    that share it only share the list of their common keys, which is a property of
    the corpus, so even a collision of hashes changes no result.
    """
    text_batches(docs.sparkSession)
    docs = without(docs, "n_lines", "n_dropped")
    rk, hit, made = fresh(docs, "rk", "rk_hit", "made")
    row_key = F.xxhash64(F.col(f"`{id_col}`"), text_of(docs, state.text_col))
    common = state.common_lines(docs, row_key).toDF(hit, "common")
    joined = docs.withColumn(rk, row_key).join(common, F.col(rk) == F.col(hit), "left")
    done = joined.withColumn(made, F.pandas_udf(_rebuilt, "n_lines long, n_dropped long, kept string")(text_of(docs, state.text_col), common["common"]))
    cols = [F.col(f"{made}.kept").alias(c) if c == state.text_col else docs[f"`{c}`"] for c in docs.columns]
    return done.select(*cols, F.col(f"{made}.n_lines").alias("n_lines"), F.col(f"{made}.n_dropped").alias("n_dropped"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Build the state over ``docs`` and drop its common lines: see ``drop_common_lines``."""
    return drop_common_lines(docs, empty_state(min_docs, min_chars, text_col).add(docs), id_col)

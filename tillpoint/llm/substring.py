"""Substring dedup by difference-cover anchors.

A passage is a repeat if ``window`` consecutive words of one document also stand
in a document with a smaller id.  Comparing every window of every document would
move a row per word; anchors move a fifth of that.  With a difference cover D
modulo v, every distance between two places is a difference of two members of D,
so two equal passages, wherever they begin, have a common offset below v at which
both stand at a cover position.  Only the runs of ``window - v + 1`` words that
begin at cover positions are hashed and compared; a common window always holds
such a run in both documents.

1. Anchors of all documents meet by hash.  Those of two or more documents are shared.
2. Shared anchors extend: every window that holds one is hashed (96 bits) in its
   document, meets its equals, and the smallest document id of each is found.
3. Words under a window that a smaller document has go.

Hashes travel packed: one row per chunk of texts and hash range holds arrays.
Passages that very many documents share would fill one range, so a bounded sample
names the commonest windows and anchors first.  A sampled anchor of two documents
is shared for certain and needs no meeting; the smallest document of a common
window is one grouped minimum with one row per chunk.  Neither enters a range.
The sample moves work only, never results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.llm.common import SPACES, text_batches, text_of, without
from tillpoint.llm.words import Words, byte_table, chunks, separators, text_bytes, window_hashes

WINDOW = 50
#: Perfect difference covers (fixed values): every distance modulo the key is a difference of two members.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
RANGE_HASHES = 2_000_000
SAMPLE_BYTES = 16 << 20
COMMON_KEYS = 65_536
NO_ID = (1 << 63) - 1
_SEP = separators(SPACES)
_TABLES = byte_table(101), byte_table(102)


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The largest known period that leaves anchors of two fifths of the window at least, and its cover."""
    fit = [v for v in COVERS if 5 * (window - v + 1) >= 2 * window]
    return (max(fit), COVERS[max(fit)]) if fit else (1, (0,))


def _anchors(w: Words, h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers, texts and hashes of a chunk's anchors (texts shorter than a window have none)."""
    period, cover = cover_for(window)
    text = w.text_of_word()
    at = np.arange(len(h))
    fits = (w.first[text + 1] - at >= window - period + 1) & (np.diff(w.first)[text] >= window)
    at = at[fits & np.isin((at - w.first[text]) % period, cover)]
    return at, text[at], window_hashes(h, at, window - period + 1)


def _windows(w: Words, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The 96-bit keys of the windows at the given word numbers."""
    one = window_hashes(w.hashes(_TABLES[0]), starts, window)
    two = window_hashes(w.hashes(_TABLES[1]), starts, window)
    return one.view(np.int64), (two >> np.uint64(33)).astype(np.int32)


def _longs(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def _packed(r: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row per range r, with the columns of its entries as arrays."""
    order = np.argsort(r, kind="stable")
    r = r[order]
    cuts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]]) if len(r) else np.zeros(0, np.int64)
    bounds = np.r_[cuts, len(r)]
    out = {"r": pa.array(r[cuts].astype(np.int32))} | {n: _lists(c[order], bounds) for n, c in columns.items()}
    return pa.RecordBatch.from_pydict(out)


def _flat(table: pa.Table, name: str) -> np.ndarray:
    return pc.list_flatten(table.column(name).combine_chunks()).to_numpy(zero_copy_only=False)


def _ranges(h: np.ndarray, n: int) -> np.ndarray:
    return (h.view(np.uint64) >> np.uint64(32)).astype(np.int64) * n >> 32


def _groups(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by keys (the last one is the document), the first entry of every group, each entry's group."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys[:-1]:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _common(rows: DataFrame, window: int, share: int) -> dict[str, np.ndarray]:
    """The commonest anchors and windows of a sample: those of two or more sampled documents (distinct ids)."""

    def emit(batches):
        for part, raw, offsets in chunks(batches, "text"):
            w = Words(raw, offsets, _SEP)
            doc = _longs(part.column("doc"))
            _, text, h = _anchors(w, w.hashes(_TABLES[0]), window)
            yield pa.RecordBatch.from_pydict({"kind": pa.array(np.zeros(len(h), np.int32)), "k1": pa.array(h.view(np.int64)),
                                              "k2": pa.array(np.zeros(len(h), np.int32)), "doc": pa.array(doc[text])})
            text = w.text_of_word()
            s = np.flatnonzero(w.first[text + 1] - np.arange(len(text)) >= window)
            k1, k2 = _windows(w, s, window)
            yield pa.RecordBatch.from_pydict({"kind": pa.array(np.ones(len(s), np.int32)), "k1": pa.array(k1), "k2": pa.array(k2),
                                              "doc": pa.array(doc[text[s]])})

    sample = rows.filter(F.pmod(F.xxhash64("rk", F.lit(5)), F.lit(share)) == 0) if share > 1 else rows
    seen = sample.select("doc", "text").mapInArrow(emit, "kind int, k1 long, k2 int, doc long").distinct()
    count = seen.groupBy("kind", "k1", "k2").agg(F.count("*").alias("n")).filter("n > 1")
    out = {}
    for kind, name in enumerate(("anchors", "windows")):
        top = count.filter(F.col("kind") == kind).orderBy(F.desc("n"), "k1").limit(COMMON_KEYS).select("k1", "k2").toPandas()
        out[name] = np.unique(top["k1"].to_numpy(np.int64))
        out[name + "2"] = top.set_index("k1")["k2"].to_dict() if kind else None
    return out


def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The place of every hash in the sorted ``known``; -1 where it isn't there."""
    if not len(known):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return np.where(known[at] == h, at, -1)


def _least_documents(rows: DataFrame, known: np.ndarray, second: np.ndarray, window: int) -> np.ndarray:
    """The smallest document id of every common window: one row per chunk and window, then a grouped minimum."""

    def emit(batches):
        for part, raw, offsets in chunks(batches, "text"):
            w = Words(raw, offsets, _SEP)
            text = w.text_of_word()
            s = np.flatnonzero(w.first[text + 1] - np.arange(len(text)) >= window)
            k1, k2 = _windows(w, s, window)
            at = _among(k1, known)
            hit = (at >= 0) & (second[at] == k2)
            least = np.full(len(known), NO_ID)
            np.minimum.at(least, at[hit], _longs(part.column("doc"))[text[s[hit]]])
            found = np.unique(at[hit])
            yield pa.RecordBatch.from_pydict({"at": pa.array(found.astype(np.int32)), "doc": pa.array(least[found])})

    least = np.full(len(known), NO_ID)
    if len(known):
        got = rows.select("doc", "text").mapInArrow(emit, "at int, doc long").groupBy("at").agg(F.min("doc").alias("doc")).toPandas()
        least[got["at"].to_numpy(np.int64)] = got["doc"].to_numpy(np.int64)
    return least


def _parts(spark: SparkSession, hashes: float) -> int:
    """Hash ranges: enough for all tasks, and for ranges of a bounded size.  Fewer ranges pack closer: a row's
    number then serves several of its hashes."""
    return int(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-hashes // RANGE_HASHES), 1))


def repeated_windows(whole: DataFrame, window: int = WINDOW) -> DataFrame:
    """(rk, doc, starts) for a frame with the columns rk long, doc long, text string (rk is a hash of the row):
    per row the first words of all windows whose words also begin somewhere in a row with a smaller doc.
    Rows without such a window are missing."""
    spark = whole.sparkSession
    rows = whole.select("rk", "doc", "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    period, cover = cover_for(window)
    common = _common(rows, window, max(1, -(-size // SAMPLE_BYTES)))
    sure, known = common["anchors"], common["windows"]
    second = np.array([common["windows2"][k] for k in known.tolist()], np.int32)
    least = _least_documents(rows, known, second, window)
    n = _parts(spark, size / 6 * len(cover) / period)
    shared_by_sample, frequent = spark.sparkContext.broadcast(sure), spark.sparkContext.broadcast((known, second, least))

    def anchors(batches):
        for part, raw, offsets in chunks(batches, "text"):
            w = Words(raw, offsets, _SEP)
            at, text, h = _anchors(w, w.hashes(_TABLES[0]), window)
            h, rk = h.view(np.int64), _longs(part.column("rk"))
            is_sure = _among(h, shared_by_sample.value) >= 0
            r = np.where(is_sure, _ranges(rk[text] * 31 + at, n), _ranges(h, n))   # sure ones lie anywhere: nobody looks for them
            yield _packed(r, {"h": h, "sure": is_sure, "rk": rk[text], "pos": (at - w.first[text]).astype(np.int32)})

    def shared(group: pa.Table) -> pa.Table:
        h, rk, is_sure = _flat(group, "h"), _flat(group, "rk"), _flat(group, "sure").astype(bool)
        order, first, of = _groups([h, rk])
        last = np.r_[first[1:] - 1, len(h) - 1]
        two = rk[order][first] != rk[order][last]
        take = np.sort(order[two[of] | is_sure[order]])
        return pa.table({"rk": rk[take], "pos": _flat(group, "pos")[take]})

    packed = rows.mapInArrow(anchors, "r int, h array<long>, sure array<boolean>, rk array<long>, pos array<int>")
    spots = packed.groupBy("r").applyInArrow(shared, "rk long, pos int").groupBy("rk").agg(F.collect_list("pos").alias("pos"))
    # all columns go along, so this join and the last one read the same exchange of the texts.  Rows that share
    # rk by chance get each other's places too: those are only looked at
    met = whole.join(spots.withColumnRenamed("rk", "rk_"), F.col("rk") == F.col("rk_"))

    def windows(batches):
        k_known, k_second, k_least = frequent.value
        for part, raw, offsets in chunks((b.select(["rk", "doc", "text", "pos"]) for b in batches), "text"):
            w = Words(raw, offsets, _SEP)
            pos = part.column("pos")
            text = np.repeat(np.arange(len(part)), pc.list_value_length(pos).to_numpy(zero_copy_only=False))
            at = np.minimum(w.first[text] + pc.list_flatten(pos).to_numpy(zero_copy_only=False), w.first[text + 1])
            lo = np.maximum(at - (period - 1), w.first[text])
            hi = np.maximum(np.minimum(at, w.first[text + 1] - window) + 1, lo)
            step = np.zeros(len(w.starts) + 1, np.int64)
            np.add.at(step, lo, 1)
            np.add.at(step, hi, -1)
            s = np.flatnonzero(np.cumsum(step) > 0)
            text = np.searchsorted(w.first, s, "right") - 1
            k1, k2 = _windows(w, s, window)
            doc, rk = _longs(part.column("doc"))[text], _longs(part.column("rk"))[text]
            place = _among(k1, k_known)
            is_common = (place >= 0) & (k_second[place] == k2) if len(k_known) else np.zeros(len(k1), bool)
            gone = is_common.copy()
            if len(k_known):
                gone &= k_least[place] < doc
            keep = ~is_common | gone
            k1, k2, gone, doc, rk, s, text = (x[keep] for x in (k1, k2, gone, doc, rk, s, text))
            r = np.where(gone, _ranges(rk * 31 + s, n), _ranges(k1, n))
            yield _packed(r, {"k1": k1, "k2": k2, "gone": gone, "doc": doc, "rk": rk, "pos": (s - w.first[text]).astype(np.int32)})

    def repeated(group: pa.Table) -> pa.Table:
        doc, gone = _flat(group, "doc"), _flat(group, "gone").astype(bool)
        order, first, of = _groups([_flat(group, "k1"), _flat(group, "k2"), doc])
        take = np.sort(order[(doc[order][first][of] < doc[order]) & ~gone[order] | gone[order]])
        return pa.table({"rk": _flat(group, "rk")[take], "doc": doc[take], "pos": _flat(group, "pos")[take]})

    packed = met.mapInArrow(windows, "r int, k1 array<long>, k2 array<int>, gone array<boolean>, doc array<long>, rk array<long>, pos array<int>")
    found = packed.groupBy("r").applyInArrow(repeated, "rk long, doc long, pos int")
    return found.groupBy("rk", "doc").agg(F.collect_list("pos").alias("starts"))


def _kept(window: int):
    kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    @F.arrow_udf("n_words long, n_removed long, kept string")
    def keep(text: pa.Array, starts: pa.Array) -> pa.Array:
        raw, offsets = text_bytes(text)
        w = Words(raw, offsets, _SEP)
        of = np.repeat(np.arange(len(text)), pc.fill_null(pc.list_value_length(starts), 0).to_numpy(zero_copy_only=False))
        at = w.first[of] + pc.list_flatten(starts).to_numpy(zero_copy_only=False)
        step = np.zeros(len(w.starts) + 1, np.int64)
        np.add.at(step, at, 1)
        np.add.at(step, at + window, -1)
        left = np.flatnonzero(np.cumsum(step)[:-1] == 0)
        inner = np.searchsorted(left, w.first)
        words = w.strings(left)
        lists = pa.LargeListArray.from_arrays(pa.array(inner), words.cast(pa.large_string()))
        kept = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
        total = np.diff(w.first)
        return pa.StructArray.from_arrays([pa.array(total), pa.array(total - np.diff(inner)), kept], fields=list(kind))

    return keep


def dedup_substrings(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, the text without repeated passages (kept words joined by one space),
    plus n_words (before) and n_removed.

    Defined results: a null or empty text has no words and becomes an empty text; texts
    shorter than a window keep all words; rows of one id take nothing from each other, so
    repeated rows come back alike; a null id counts as the largest long, so it never takes words from
    another row and loses those that any row with an id has; an empty table gives an empty
    table; input columns named n_words or n_removed are replaced, other names may clash freely.
    Ids must be integers.  Very long texts are one chunk of their own.
    """
    text_batches(docs.sparkSession)
    docs = without(docs, "n_words", "n_removed")
    own = {c: f"in{i}" for i, c in enumerate(docs.columns)}
    text = text_of(docs, text_col)
    # working columns first, the document's own under plain names
    whole = docs.select(F.xxhash64(F.col(f"`{id_col}`"), text).alias("rk"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("doc"),
                        text.alias("text"), *[F.col(f"`{c}`").alias(n) for c, n in own.items() if c != text_col])
    found = repeated_windows(whole, window).toDF("hit", "hit_doc", "starts")
    # the bounds instead of an equality keep the exchange on rk alone
    joined = whole.join(found, (F.col("rk") == F.col("hit")) & F.col("doc").between(F.col("hit_doc"), F.col("hit_doc")), "left")
    none = F.array().cast("array<int>")
    done = joined.withColumn("made", _kept(window)("text", F.coalesce("starts", none)))
    cols = [F.col("made.kept" if c == text_col else n).alias(c) for c, n in own.items()]
    return done.select(*cols, "made.n_words", "made.n_removed")

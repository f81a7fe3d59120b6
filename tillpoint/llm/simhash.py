"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has 64 bits; two fingerprints link at ``radius`` or fewer
differing bits.  Bit i gets a vector m(i) of radius+1 bits, and table v (each
non-zero vector of radius+1 bits) keeps exactly the bits with <m(i), v> = 1.
The vectors of at most ``radius`` differing bits can't span all radius+1
dimensions, so some v is orthogonal to all of them: in that table none of the
differing bits is kept and the pair collides.  No pair within the radius is
missed, by construction, with 2^(radius+1) - 1 tables of 36 to 37 kept bits (radius 2).

Only distinct fingerprints are hashed.  A bucket of up to ``small_bucket`` of
them compares its pairs.  A larger one (a group of near copies) never forms
pairs: two fingerprints within distance 2 share a midpoint within distance 1,
so each puts itself and its one-bit changes of the dropped bits into the
bucket's midpoints, and each midpoint links its members to the smallest.  A
midpoint has at most as many members as dropped bits plus one, and the links
connect exactly the pairs within the radius.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import fresh, text_batches, text_of
from tillpoint.llm.components import connected_components
from tillpoint.session import cut_lineage

BITS = 64
RADIUS = 2
SHINGLE = 3
SMALL_BUCKET = 12
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = 42) -> int:
    """Signed 64-bit SimHash of the word shingles (A-Z lower-cased); no words: zero."""
    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[min(shingle, len(words)) - 1:].tolist()
    first = [0, *(ends[:n - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[i:j], seed) for i, j in zip(first, last)), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):   # a slice at a time: bounded memory for a text of any length
        counts += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprint_udf(shingle: int = SHINGLE):
    @F.pandas_udf("long")
    def simhash(text: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in text], dtype="int64")

    return simhash


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The kept bits of every table, as signed 64-bit masks."""
    n = (1 << (radius + 1)) - 1
    vectors = [i % n + 1 for i in range(bits)]
    masks = [sum(1 << i for i in range(bits) if bin(vectors[i] & v).count("1") % 2) for v in range(1, n + 1)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(prints: DataFrame, radius: int = RADIUS, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """(a, b): edges between distinct fingerprints (column fp) with the components of all pairs within the radius.

    Every edge's ends differ in at most ``radius`` bits.  Buckets larger than ``small_bucket`` take
    the midpoint way, which needs a radius of 2.
    """
    if radius != 2:
        raise ValueError("midpoints need a radius of 2")
    masks = covering_masks(radius)
    tables = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)]))
    signed = prints.select("fp", tables.alias("s")).select("s.t", "s.key", "fp")
    sizes = signed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1").toDF("st", "sk", "n")
    shared = cut_lineage(signed.join(sizes, (F.col("t") == F.col("st")) & (F.col("key") == F.col("sk"))).select("t", "key", "fp", "n"))

    few = shared.filter(F.col("n") <= small_bucket).groupBy("t", "key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    one = few.select("fps", F.posexplode("fps").alias("i", "a")).select("a", F.explode(F.slice("fps", F.col("i") + 2, small_bucket)).alias("b"))
    close = one.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)

    dropped = [[1 << i if i < 63 else -(1 << 63) for i in range(BITS) if not (m >> i) & 1] for m in masks]
    flips = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(b) for b in d]) for d in dropped])
    mids = F.transform(F.element_at(flips, F.col("t") + 1), lambda b: b.bitwiseXOR(F.col("fp")))
    many = shared.filter(F.col("n") > small_bucket).select("t", "fp", F.explode(mids).alias("mid"))
    mid = many.groupBy("t", "mid").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    stars = mid.select("a", F.explode("fps").alias("b"))
    return close.union(stars).filter("a <> b").distinct()


def _labelled(docs: DataFrame, keep: dict, id_col: str, text_col: str, radius: int, shingle: int) -> DataFrame:
    """Per row: the columns ``keep``, fp, label (a fingerprint of the component) and component_id."""
    text_batches(docs.sparkSession)
    fp_col = fingerprint_udf(shingle)(text_of(docs, text_col))
    rows = cut_lineage(docs.select(*[c.alias(n) for n, c in keep.items()], F.col(f"`{id_col}`").alias("id"), fp_col.alias("fp")))
    reps = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("id")))
    parts = connected_components(links(reps.select("fp"), radius))
    labelled = reps.join(parts, F.col("fp") == F.col("node"), "left").select("fp", "id", F.coalesce("label", "fp").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("id").alias("component_id")).withColumnRenamed("label", "l2")
    of_fp = labelled.join(smallest, F.col("label") == F.col("l2")).select(F.col("fp").alias("fp2"), "label", "component_id")
    return rows.join(of_fp, F.col("fp") == F.col("fp2")).select(*keep, "fp", "label", "component_id")


def near_duplicates(docs: DataFrame, keep: dict, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS,
                    shingle: int = SHINGLE) -> DataFrame:
    """Per row of ``docs``: the columns ``keep`` ({name: column}), fingerprint (16 hex digits) and
    component_id (smallest id among all rows reachable by links, itself included).

    Defined results: null, empty and wordless texts have fingerprint zero and link like any other;
    repeated rows come back as often as given; a component whose ids are all null has a null
    component_id; an empty table gives an empty table; other columns aren't looked at.  ``keep`` must
    not use the names fp, fp2, id, fingerprint, component_id, node, label.
    """
    found = _labelled(docs, keep, id_col, text_col, radius, shingle)
    return found.select(*keep, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS,
             shingle: int = SHINGLE) -> DataFrame:
    """One row of ``docs`` per component, all columns: its smallest id's (null ids last; among rows of
    equal id the smallest text hash; among rows equal in both, any one)."""
    key = {"k_id": F.col(f"`{id_col}`"), "k_text": F.xxhash64(text_of(docs, text_col))}
    found = _labelled(docs, key, id_col, text_col, radius, shingle)
    keys = found.groupBy("label", "k_id", "k_text").agg(F.count("*").alias("rows"))
    first = F.min(F.struct(F.col("k_id").isNull().alias("none"), "k_id", "k_text", "rows")).alias("f")
    best = cut_lineage(keys.groupBy("label").agg(first).select("f.k_id", "f.k_text", "f.rows"))
    names = fresh(docs, "k_id", "k_text")
    repeated = not best.filter("rows > 1").isEmpty()
    best = best.drop("rows").toDF(*names)
    kept = docs.join(best, key["k_id"].eqNullSafe(F.col(names[0])) & (key["k_text"] == F.col(names[1])))
    if repeated:   # rows equal in id and text
        kept = kept.dropDuplicates(names)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])

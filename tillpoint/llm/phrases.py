"""Phrase collocation mining over sorted count streams.

Every place of a text starts one gram: its word and up to three words that
follow in the same piece, so all orders from one to four are prefixes of grams
and one count stream holds them all.

1. Places are counted per chunk of texts and cut by sampled splitters into
   ranges of gram order; a range merges its chunks' sorted runs.  In that order
   the counts of all prefixes are sums over neighbours, so one pass gives the
   frequent phrases of every order; a prefix that two ranges share is added up
   afterwards.  A common gram is one entry per chunk, wherever it stands.
2. Frequent phrases are kept in prefix order and in suffix order (words
   reversed).  In prefix order a phrase comes after all its own prefixes, so one
   pass with the last phrase seen of every order hands each phrase its left
   counts; in suffix order the same pass hands it its right counts.  A stream is
   cut into ranges anywhere: the few open prefixes at a cut are looked up.
3. The two streams merge by phrase; every cut of every phrase is scored with
   exact decimals.  A phrase that one longer phrase covers is marked by that
   phrase's row, which knows the count of what it extends.

Counts are kept with words as strings; nothing is hashed to stand for a phrase.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import UPPER, text_batches, text_of
from tillpoint.llm.words import Words, separators, text_bytes
from tillpoint.session import scratch_path

ORDER = 4
MIN_COUNT = 30
TOP = 2000
COVERED = (80, 100)
#: A word ends at a blank or tab; a piece ends at these (fixed values).
BLANKS, BREAKS = " \t", ".,;:!?\n\x0b\x0c\r"
NO_LANG = "und"
CHUNK_BYTES = 2 << 20
PENDING_BYTES = 12 << 20
RANGE_PLACES = 1_000_000
SAMPLE_PLACES = 200_000
END = "\n"   # closes each word of a key; no word holds it

_SEP, _BREAK = separators(BLANKS + BREAKS), separators(BREAKS)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[list(UPPER.encode())] = list(UPPER.lower().encode())


def _ranked(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words in byte order, and each word's place among them, from 1."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order) + 1, np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    return coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy(zero_copy_only=False)]


def _places(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """The words of the texts, and how many words of its piece each word has from itself on."""
    raw, offsets = text_bytes(texts)
    raw = _LOWER[raw]
    w = Words(raw, offsets, _SEP)
    n = len(w.starts)
    breaks = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(_BREAK[raw], out=breaks[1:])
    last = np.ones(n, bool)
    last[:-1] = breaks[w.starts[1:]] > breaks[w.ends[:-1]]
    last[w.first[1:][w.first[1:] > 0] - 1] = True
    ends = np.flatnonzero(last)
    return w, ends[np.searchsorted(ends, np.arange(n))] + 1 - np.arange(n)


def _grams(codes: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per place its four word codes (0: none) as two numbers that compare like the gram."""
    wide = np.zeros(len(codes) + ORDER, np.int64)
    wide[:len(codes)] = codes
    c = [np.where(left > k, wide[k:k + len(codes)], 0) for k in range(ORDER)]
    return c[0] << 32 | c[1], c[2] << 32 | c[3]


def _summed(one: np.ndarray, two: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams in order, with their counts."""
    if not len(one):
        return one, two, n
    order = np.lexsort((two, one))
    one, two, n = one[order], two[order], n[order]
    new = np.flatnonzero(np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
    return one[new], two[new], np.add.reduceat(n, new)


def _by_language(batches):
    """(language, texts): texts of one language at a time, some megabytes together."""
    held: dict[str, list[pa.Array]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            texts = batch.column("text").filter(pc.equal(langs.indices, code)).cast(pa.large_string())
            held.setdefault(lang, []).append(texts)
            size[lang] = size.get(lang, 0) + texts.nbytes
        spill = sum(size.values()) > PENDING_BYTES
        for lang in [x for x in held if spill or size[x] >= CHUNK_BYTES]:
            yield lang, pa.concat_arrays(held.pop(lang))
            del size[lang]
    for lang, texts in held.items():
        yield lang, pa.concat_arrays(texts)


def _cuts(one: np.ndarray, two: np.ndarray, at_one: np.ndarray, at_two: np.ndarray) -> np.ndarray:
    """How many of the ordered grams come before each of the ordered splitters."""
    lo, hi = np.searchsorted(one, at_one, "left"), np.searchsorted(one, at_one, "right")
    out = lo.copy()
    for i in np.flatnonzero(hi > lo):
        out[i] += np.searchsorted(two[lo[i]:hi[i]], at_two[i], "left")
    return out


def _runs(splitters: dict[str, list[tuple[bytes, ...]]]):
    """Chunks to sorted runs: one row per chunk and range with the range's words and packed grams."""

    def runs(batches):
        for lang, texts in _by_language(batches):
            w, left = _places(texts)
            if not len(left):
                continue
            cuts = splitters.get(lang, [])
            marks = pa.array([x for cut in cuts for x in cut], pa.large_binary())
            vocabulary, codes = _ranked(pa.concat_arrays([w.strings(np.arange(len(left))), marks]))
            one, two, n = _summed(*_grams(codes[:len(left)], left), np.ones(len(left), np.int64))
            m = np.zeros((len(cuts), ORDER), np.int64)
            at = len(left)
            for i, cut in enumerate(cuts):
                m[i, :len(cut)] = codes[at:at + len(cut)]
                at += len(cut)
            bounds = np.r_[0, _cuts(one, two, m[:, 0] << 32 | m[:, 1], m[:, 2] << 32 | m[:, 3]), len(one)]
            rows = {"r": [], "words": [], "one": [], "two": [], "n": []}
            for r in np.flatnonzero(np.diff(bounds)).tolist():
                part = slice(bounds[r], bounds[r + 1])
                c = np.stack([one[part] >> 32, one[part] & 0xFFFFFFFF, two[part] >> 32, two[part] & 0xFFFFFFFF])
                used, local = np.unique(c, return_inverse=True)
                local = local.reshape(c.shape) + (0 if used[0] == 0 else 1)
                used = used[used > 0]
                rows["r"].append(r)
                rows["words"].append(b"\n".join(vocabulary.take(pa.array(used - 1)).to_pylist()))
                rows["one"].append(local[0] << 32 | local[1])
                rows["two"].append(local[2] << 32 | local[3])
                rows["n"].append(n[part].astype(np.int32))
            kinds = {"r": pa.int32(), "words": pa.binary(), "one": pa.list_(pa.int64()), "two": pa.list_(pa.int64()), "n": pa.list_(pa.int32())}
            out = {"lang": pa.array([lang] * len(rows["r"]), pa.string())} | {k: pa.array(v, kinds[k]) for k, v in rows.items()}
            yield pa.RecordBatch.from_pydict(out)

    return runs


def _prefixes(min_count: int):
    """A range's runs to its prefix counts: those of ``min_count``, and whatever may go on in a neighbouring range."""

    def merge(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        lists = pc.split_pattern(group.column("words").combine_chunks().cast(pa.large_binary()), END.encode())
        vocabulary, codes = _ranked(lists.flatten())
        starts = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]
        ones, twos, ns = [], [], []
        for i in range(len(lists)):
            to = np.r_[0, codes[starts[i]:starts[i + 1]]]
            one, two = (group.column(c)[i].values.to_numpy() for c in ("one", "two"))
            ones.append(to[one >> 32] << 32 | to[one & 0xFFFFFFFF])
            twos.append(to[two >> 32] << 32 | to[two & 0xFFFFFFFF])
            ns.append(group.column("n")[i].values.to_numpy().astype(np.int64))
        del lists, codes
        one, two, n = _summed(np.concatenate(ones), np.concatenate(twos), np.concatenate(ns))
        c = [one >> 32, one & 0xFFFFFFFF, two >> 32, two & 0xFFFFFFFF]
        keys, orders, counts = [""], [0], [int(n.sum())]
        strings = vocabulary.cast(pa.large_string())
        for m in range(1, ORDER + 1):
            have = np.flatnonzero(c[m - 1])
            if not len(have):
                continue
            own = [x[have] for x in c[:m]]
            new = np.zeros(len(have), bool)
            new[0] = True
            for x in own:
                new[1:] |= x[1:] != x[:-1]
            first = np.flatnonzero(new)
            f = np.add.reduceat(n[have], first)
            take = f >= min_count
            take[[0, -1]] = True
            words = [strings.take(pa.array(x[first[take]] - 1)) for x in own]
            joined = pc.binary_join_element_wise(*words, pa.scalar("", pa.large_string()), pa.scalar(END, pa.large_string()))
            keys += joined.to_pylist()
            orders += [m] * len(joined)
            counts += f[take].tolist()
        return pa.table({"lang": pa.array([key[0].as_py()] * len(keys), pa.string()), "key": pa.array(keys, pa.string()),
                         "m": pa.array(orders, pa.int32()), "f": pa.array(counts, pa.int64())})

    return merge


def _splitters(rows: DataFrame, ranges: int, places: float) -> dict[str, list[tuple[bytes, ...]]]:
    """Per language the grams that cut a sample of places into about ``ranges`` equal parts; they only deal out the work."""
    want = max(SAMPLE_PLACES, 20 * ranges)
    share = max(1, int(places / (8 * want)))
    stride = max(1, int(places / share / want))

    def emit(batches):
        for lang, texts in _by_language(batches):
            w, left = _places(texts)
            at = np.arange(len(texts) % stride, len(left), stride)
            own = zip(*[w.strings(np.minimum(at + k, len(left) - 1)).cast(pa.large_string()).to_pylist() for k in range(ORDER)])
            keys = ["".join(x + END for x in gram[:n]) for gram, n in zip(own, left[at].tolist())]
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()), "key": pa.array(keys, pa.string())})

    sample = rows.filter(F.pmod(F.xxhash64("text", F.lit(9)), F.lit(share)) == 0) if share > 1 else rows
    got = sample.mapInArrow(emit, "lang string, key string").toPandas()
    grams = sorted((lang, tuple(key.encode().split(b"\n")[:-1])) for lang, key in zip(got["lang"], got["key"]))   # word by word, as codes compare
    out: dict[str, list[tuple[bytes, ...]]] = {}
    for lang, gram in sorted({grams[i * len(grams) // ranges] for i in range(1, ranges)} if grams else ()):
        out.setdefault(lang, []).append(gram)
    return out


def frequent_phrases(rows: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, key, m, f) for ``rows`` (lang, text): the count of every phrase of 1 to 4 words with ``min_count``
    or more occurrences in its language, its words each closed by a line feed; and, with m = 0, all words' count."""
    spark = rows.sparkSession
    places = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / 6
    ranges = int(max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-places // RANGE_PLACES)))
    runs = rows.mapInArrow(_runs(_splitters(rows, ranges, places)), "lang string, r int, words binary, one array<long>, two array<long>, n array<int>")
    merged = runs.groupBy("lang", "r").applyInArrow(_prefixes(min_count), "lang string, key string, m int, f long")
    return merged.groupBy("lang", "key", "m").agg(F.sum("f").alias("f")).filter((F.col("m") == 0) | (F.col("f") >= min_count))


def _last_seen(batches):
    """In stream order: each phrase with the count of its first k words (k below its order), from the last phrase of order k."""
    pid = TaskContext.get().partitionId()
    carry = [0] * ORDER
    for batch in batches:
        m, f = batch.column("m").to_numpy(), batch.column("f").to_numpy()
        out = {c: batch.column(c) for c in ("lang", "key", "m", "f", "stream")} | {"pid": pa.array(np.full(len(m), pid, np.int32))}
        for k in range(1, ORDER):
            seen = np.r_[carry[k], np.where(m == k, f, 0)]
            at = np.maximum.accumulate(np.where(np.r_[0, m] == k, np.arange(len(seen)), 0))
            out[f"c{k}"] = pa.array(np.where(m > k, seen[at][1:], 0))
            carry[k] = int(seen[at][-1])
        yield pa.RecordBatch.from_pydict(out)


def _with_ancestors(counts: DataFrame, stream: str) -> DataFrame:
    """``counts`` in the order of the column ``stream``, with c1..c3: the count of the first k words in that order."""
    spark = counts.sparkSession
    ordered = counts.filter("m > 0").repartitionByRange("lang", "stream").sortWithinPartitions("lang", "stream")
    kind = "lang string, key string, m int, f long, stream string, pid int, c1 long, c2 long, c3 long"
    path = scratch_path(spark, f"phrases-{stream}")
    ordered.mapInArrow(_last_seen, kind).write.parquet(path)
    passed = spark.read.parquet(path)
    # what is open where a range begins: at most three phrases a range
    heads = passed.groupBy("pid").agg(F.min(F.struct("lang", "stream")).alias("h"))
    opened = heads.select("pid", "h.lang", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.concat(
        F.substring_index("h.stream", END, k), F.lit(END)).alias("s")) for k in range(1, ORDER)])).alias("o")).select("pid", "lang", "o.k", "o.s")
    known = counts.select(F.col("lang").alias("kl"), F.col("stream").alias("ks"), F.col("m").alias("km"), F.col("f").alias("kf"))
    found = opened.join(known, (F.col("lang") == F.col("kl")) & (F.col("s") == F.col("ks")) & (F.col("k") == F.col("km")))
    carried = found.groupBy(F.col("pid").alias("p2")).agg(*[F.max(F.when(F.col("k") == k, F.col("kf"))).alias(f"o{k}") for k in range(1, ORDER)])
    joined = passed.join(F.broadcast(carried), F.col("pid") == F.col("p2"), "left")
    filled = [F.when((F.col(f"c{k}") == 0) & (F.col("m") > k), F.col(f"o{k}")).otherwise(F.col(f"c{k}")).alias(f"c{k}") for k in range(1, ORDER)]
    return joined.select("lang", "key", "m", "f", *filled)


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT, top: int | None = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to 4 words (None: all) by
    score descending, a descending, phrase.

    Texts are lower-cased (A-Z) and split into pieces and words; a phrase lies within a
    piece.  a, l and r are the occurrences of the phrase and of the two parts at its lowest-scoring cut
    (ties: the earliest), n all words of the language, score floor(2000000 a / (l + r)).  Phrases inside a longer
    one with four fifths of their count or more are dropped.

    Defined results: null and empty texts have no words; a null language is "und", together with rows that say
    so; repeated rows count as often as they are given; an empty table, or one without a phrase of
    ``min_count``, gives an empty table; other columns aren't looked at.  A text, however long, is
    counted whole, with all texts of its chunk.
    """
    spark = docs.sparkSession
    text_batches(spark)
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANG)).alias("lang"), text_of(docs, text_col).alias("text"))
    path = scratch_path(spark, "phrases")
    frequent_phrases(rows, min_count).write.parquet(path)
    counts = spark.read.parquet(path)
    words = F.split(F.regexp_replace("key", "\n$", ""), END)
    back = F.concat(F.array_join(F.reverse(words), END), F.lit(END))
    left = _with_ancestors(counts.withColumn("stream", F.col("key")), "prefix")
    right = _with_ancestors(counts.withColumn("stream", back), "suffix")

    per, whole = COVERED
    covers = lambda c: (F.col("m") > 2) & (F.col("f") * whole >= F.element_at(F.array("c1", "c2", "c3"), F.col("m") - 1) * per)
    part = lambda lo, n: F.concat(F.array_join(F.slice(words, lo, n), END), F.lit(END))
    marks = left.filter(covers("c")).select("lang", part(1, F.col("m") - 1).alias("key")).union(
        right.filter(covers("c")).select("lang", part(2, F.col("m") - 1).alias("key"))).distinct()

    after = right.filter("m > 1").select(F.col("lang").alias("l2"), F.col("key").alias("k2"), *[F.col(f"c{k}").alias(f"s{k}") for k in range(1, ORDER)])
    both = left.filter("m > 1").join(after.hint("merge"), (F.col("lang") == F.col("l2")) & (F.col("key") == F.col("k2")))
    cut = lambda k: F.when(F.col("m") > k, F.struct(
        F.expr(f"(cast(2000000 as decimal(7,0)) * cast(f as decimal(20,0))) div (c{k} + element_at(array(s1, s2, s3), m - {k}))").cast("long").alias("score"),
        F.lit(k).alias("k"), F.col(f"c{k}").alias("l"), F.element_at(F.array("s1", "s2", "s3"), F.col("m") - k).alias("r")))
    scored = both.select("lang", "key", "f", F.array_min(F.array(*[cut(k) for k in range(1, ORDER)])).alias("x"))
    kept = scored.join(marks, ["lang", "key"], "left_anti").select(
        "lang", F.array_join(words, " ").alias("phrase"), F.col("f").alias("a"), "x.l", "x.r", "x.score")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:   # a language's phrases are first ranked in parts, so no task ranks them all
        for deals in (64, 8):
            deal = F.pmod(F.xxhash64("phrase"), F.lit(deals))
            kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", deal).orderBy(*best))).filter(F.col("rank") <= top)
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).filter(F.col("rank") <= top)
    else:
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)))
    total = counts.filter("m = 0").select(F.col("lang").alias("l3"), F.col("f").alias("n"))
    return kept.join(total, F.col("lang") == F.col("l3")).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

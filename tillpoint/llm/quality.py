"""Quality rules with thresholds learnt per language and source.

Word, symbol, line and repetition counts come from one pass over whole texts.
Three ratios of them are sketched per (lang, source) with a log-bucket quantile
sketch: a value's bucket is ``ceil(log_gamma(value))``, a sketch is the count per
bucket, and sketches merge by adding counts (relative error of a quantile at
most (gamma-1)/(gamma+1)).  Adding counts gives the same sketch in any order, so
a task that runs twice changes nothing.  Each ratio's fence is the group's
median plus or minus ``spread`` times the distance from the median to the
quartile on the clean side, so up to half of a group may be junk before its
fence moves far.  A group's quantiles are drawn towards those of its language's
merged sketch, and these towards the merged sketch of all documents, as if
``prior`` documents of the wider kind belonged to it: every group's own sketch
counts, by its own size, and nothing jumps at a number.  A document
stays if it passes the base rules and every fence of its group, which are joined
to it on (lang, source).
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import fresh, text_batches, text_of
from tillpoint.session import cut_lineage

GAMMA = 1.02
PRIOR = 100
WINDOW = 5
#: ratio -> (least distance to the quartile, spread below the median or None, spread above the median)
FENCES = {"symbols_per_word": (0.02, None, 5.0), "dup_line_share": (0.08, None, 5.0), "mean_word_chars": (0.25, 10.0, 10.0)}
TINY = -1_000_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def repeat_words(words: list[str], width: int = WINDOW) -> int:
    """How many words lie in a window of ``width`` words that the text holds twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(width):
        key = key * np.uint64(0x9E3779B97F4A7C15) + ids[k:k + n]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    flag = np.zeros(n, bool)
    flag[order[1:][same]] = True
    flag[order[:-1][same]] = True
    starts = np.flatnonzero(flag)
    # equal hashes are only candidates: count the words themselves
    seen = Counter(tuple(words[i:i + width]) for i in starts)
    edge = np.zeros(len(words) + 1, np.int64)
    for i in starts:
        if seen[tuple(words[i:i + width])] > 1:
            edge[i] += 1
            edge[i + width] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure_text(text: str) -> tuple[int, int, int, int, int, int]:
    words = _WORD.findall(text)
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    return (len(words), sum(map(len, words)), len(_SYMBOL.findall(text)), len(lines) - len(set(lines)),
            repeat_words(words), len(lines))


def _measure_texts(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure_text(t) for t in text],
                        columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"])


def measure(docs: DataFrame, keep: dict, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` ({name: column}), the counts of ``MEASURES`` and base_failed, per row."""
    text_batches(docs.sparkSession)
    m, = fresh(docs, "m")
    rows = docs.withColumn(m, F.pandas_udf(_measure_texts, MEASURES)(text_of(docs, text_col))).select(*[c.alias(n) for n, c in keep.items()], f"{m}.*")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def ratios(rows: DataFrame) -> DataFrame:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return rows.withColumns({"symbols_per_word": F.col("n_symbols") / words,
                             "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
                             "mean_word_chars": F.col("word_chars") / words})


def sketch(rows: DataFrame, by: list[str], metrics: list[str], gamma: float = GAMMA) -> DataFrame:
    """(by..., metric, bucket, n): one log-bucket sketch per group and metric; merge by summing n."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("x")) for m in metrics]))
    long = rows.select(*by, each.alias("e")).select(*by, "e.metric", "e.x")
    bucket = F.when(F.col("x") <= 1e-9, F.lit(TINY)).otherwise(F.ceil(F.log("x") / F.lit(float(np.log(gamma))))).cast("int")
    return long.groupBy(*by, "metric", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def sketch_quantiles(sk: DataFrame, by: list[str], probs: dict[str, float], gamma: float = GAMMA) -> DataFrame:
    """(by..., metric, total, one column per prob): the sketch's value at rank ceil(p * total)."""
    merged = sk.groupBy(*by, "metric", "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*by, "metric")   # a group has as many rows as buckets, however many documents
    run = merged.withColumns({"cum": F.sum("n").over(w.orderBy("bucket")), "total": F.sum("n").over(w)})
    value = F.when(F.col("bucket") == TINY, 0.0).otherwise(
        F.lit(2.0 / (gamma + 1.0)) * F.pow(F.lit(gamma), F.col("bucket").cast("double")))
    at = {name: F.min(F.when(F.col("cum") >= F.ceil(F.lit(p) * F.col("total")), value)).alias(name) for name, p in probs.items()}
    return run.groupBy(*by, "metric").agg(F.max("total").alias("total"), *at.values())


def fences(rows: DataFrame, prior: int = PRIOR) -> DataFrame:
    """(lang, source, lo_<ratio>, hi_<ratio>): one row for every pair of ``rows`` (ratios over rows that pass the base)."""
    probs = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    sk = cut_lineage(sketch(rows.filter("not base_failed"), ["lang", "source"], list(FENCES)))
    levels = [sketch_quantiles(sk, by, probs) for by in (["lang", "source"], ["lang"], [])]
    out = rows.select("lang", "source").distinct()

    def wide(level: DataFrame, by: list[str], tag: str) -> DataFrame:
        cols = [F.max(F.when(F.col("metric") == m, F.struct("total", *probs))).alias(f"{tag}_{m}") for m in FENCES]
        return level.groupBy(*[F.col(c).alias(f"{tag}_{c}") for c in by]).agg(*cols)

    pair, lang, every = wide(levels[0], ["lang", "source"], "p"), wide(levels[1], ["lang"], "l"), wide(levels[2], [], "a")
    out = out.join(pair, out["lang"].eqNullSafe(pair["p_lang"]) & out["source"].eqNullSafe(pair["p_source"]), "left")
    out = out.join(lang, out["lang"].eqNullSafe(lang["l_lang"]), "left")
    # the merged sketch of all documents is one row: constants for the plan, not a join
    top = every.first()
    cols = {}
    for m, (least, below, above) in FENCES.items():
        t = top[f"a_{m}"] if top is not None else None
        if t is None:   # no row passes the base rules: nothing to fence
            cols |= {f"lo_{m}": F.lit(None).cast("double"), f"hi_{m}": F.lit(None).cast("double")}
            continue

        def drawn(own: str, wider: dict, m=m) -> dict:
            n, zero = F.coalesce(F.col(f"{own}_{m}.total"), F.lit(0)), F.lit(0.0)
            return {q: (n * F.coalesce(F.col(f"{own}_{m}.{q}"), zero) + prior * wider[q]) / (n + prior) for q in probs}

        q = drawn("p", drawn("l", {p: F.lit(float(t[p])) for p in probs}))
        up = F.greatest(q["q50"] - q["q25"], F.lit(least)) * F.lit(above)
        cols[f"hi_{m}"] = q["q50"] + up
        cols[f"lo_{m}"] = F.lit(None).cast("double") if below is None else q["q50"] - F.greatest(q["q75"] - q["q50"], F.lit(least)) * F.lit(below)
    return out.select("lang", "source", *[c.alias(n) for n, c in cols.items()])


def judge(docs: DataFrame, keep: dict, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          prior: int = PRIOR) -> DataFrame:
    """Per row of ``docs``: the columns ``keep``, all counts, base_failed and kept.

    Defined results: a null text has no words, so it fails the base rules; a null
    language or source is a group of its own; an empty table gives an empty
    table; repeated rows are judged alike.  Other columns aren't looked at.
    ``keep`` must not use the names of the counts, lang or source.
    """
    cols = keep | {"lang": F.col(f"`{lang_col}`"), "source": F.col(f"`{source_col}`")}
    rows = cut_lineage(measure(docs, cols, text_col))
    rated = ratios(rows)
    limits = cut_lineage(fences(rated, prior).withColumnsRenamed({"lang": "f_lang", "source": "f_source"}))
    ok = F.lit(True)
    for m in FENCES:
        ok = ok & F.coalesce(F.col(m) <= F.col(f"hi_{m}"), F.lit(True)) & F.coalesce(F.col(m) >= F.col(f"lo_{m}"), F.lit(True))
    joined = rated.join(limits, rated["lang"].eqNullSafe(limits["f_lang"]) & rated["source"].eqNullSafe(limits["f_source"]))
    return joined.withColumn("kept", ~F.col("base_failed") & ok).select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, all columns.

    Counts travel without the texts; rejected (id, text hash, group) keys then go by
    anti join.
    """
    lang_col, source_col = options.get("lang_col", "lang"), options.get("source_col", "source")
    key = {"k_id": F.col(f"`{id_col}`"), "k_text": F.xxhash64(text_of(docs, text_col)),
           "k_lang": F.col(f"`{lang_col}`"), "k_source": F.col(f"`{source_col}`")}
    names = fresh(docs, *key)
    gone = judge(docs, key, text_col, **options).filter("not kept").select(*key).distinct().toDF(*names)
    same = F.lit(True)
    for name, column in zip(names, key.values()):
        same = same & column.eqNullSafe(F.col(name))
    return docs.join(gone, same, "left_anti")

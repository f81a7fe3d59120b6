"""Mixing sources to target weights by Poisson replication (DataFrame functions).

A source with share s of the bytes and target weight w gets the mean repetition
rate ``w * total / bytes``.  Each document's number of copies is a Poisson draw
of that mean: a uniform number from a hash of (seed, id, text) is inverted
through the distribution function, so a repeated task draws the same copies.
Means above ``MEAN`` are the sum of several draws of a smaller mean (a sum of
Poisson numbers is one), so any rate is exact.  Copies are exploded and dealt to
partitions by a hash of (seed, id, text, copy), sorted by it inside: a global
shuffle that leaves no order of source or of copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import fresh, text_of, without
from tillpoint.session import cut_lineage

MEAN = 16.0
SMALL_TABLE = 10_000


def uniform(text: Column, seed: int, part: Column) -> Column:
    """52 bits of md5(seed, part, text) as a number in [0, 1)."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), part.cast("string"), text).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def distribution(mean: Column, tail: int = 80) -> Column:
    """P(X <= k) for k = 0, 1, ..., tail: the running sum of p(k) = p(k-1) * mean / k."""
    first = F.exp(-mean)
    step = F.aggregate(
        F.sequence(F.lit(1), F.lit(tail)),
        F.struct(first.alias("p"), F.array(first).alias("c")),
        lambda a, k: F.struct((a["p"] * mean / k).alias("p"),
                              F.concat(a["c"], F.array(F.element_at(a["c"], -1) + a["p"] * mean / k)).alias("c")))
    return step["c"]


def rates(docs: DataFrame, source_col: str = "source", text_col: str = "text", weights: dict | None = None, alpha: float = 0.5,
          scale: float = 1.0) -> DataFrame:
    """(mix_source, rate, draws, cdf): one row per source.

    Sizes are UTF-8 bytes plus one per row.  ``weights`` maps sources to target
    weights (others get none); without it a source's weight is its size to the
    power ``alpha``.  The mix has ``scale`` times the input's size in the mean.
    """
    size = (F.octet_length(text_of(docs, text_col)) + 1).cast("long")
    per = docs.groupBy(F.col(f"`{source_col}`").cast("string").alias("mix_source")).agg(F.sum(size).alias("size"))
    if weights is None:
        weight = F.sqrt(F.col("size").cast("double")) if alpha == 0.5 else F.pow(F.col("size").cast("double"), F.lit(alpha))
    else:
        spark = docs.sparkSession
        given = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "g_source string, weight double")
        per = per.join(given, F.col("mix_source").eqNullSafe(F.col("g_source")), "left").drop("g_source")
        weight = F.coalesce("weight", F.lit(0.0))
    per = cut_lineage(per.withColumn("weight", weight))
    whole = per.agg(F.sum("size"), F.sum("weight")).first()
    if not whole[1]:
        return per.select("mix_source", F.lit(0.0).alias("rate"), F.lit(1).alias("draws"), F.array(F.lit(1.0)).alias("cdf"))
    rate = F.round(F.col("weight") / F.lit(whole[1]) * F.lit(float(whole[0]) * scale) / F.col("size"), 6)
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(MEAN))).cast("int")
    return cut_lineage(per.withColumn("rate", rate).withColumn("draws", draws)
                       .withColumn("cdf", distribution(F.col("rate") / F.col("draws"))).select("mix_source", "rate", "draws", "cdf"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: dict | None = None,
        alpha: float = 0.5, scale: float = 1.0, seed: int = 11) -> DataFrame:
    """The mixed rows: all columns of ``docs`` plus copy (from 1), n_copies, rate and shuffle_key, in shuffled order.

    Defined results: a null source is a source of its own; null texts and ids draw as empty ones; rows
    equal in id and text draw the same number; a source of weight 0 goes; no rows give no rows; input
    columns of the four result names are replaced.
    """
    docs = without(docs, "copy", "n_copies", "rate", "shuffle_key")
    per = rates(docs, source_col, text_col, weights, alpha, scale)
    small = per.count() <= SMALL_TABLE   # one row of 81 numbers a source: at most 7 MB to every executor, else a plain join
    names = fresh(docs, "mix_source", "rate", "draws", "cdf")
    per = per.toDF(*names)
    src, rate, draws, cdf = (F.col(n) for n in names)
    joined = docs.join(F.broadcast(per) if small else per, F.col(f"`{source_col}`").cast("string").eqNullSafe(src))
    who = F.concat_ws(":", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.md5(text_of(docs, text_col).cast("binary")))
    draw = F.transform(F.sequence(F.lit(1), draws), lambda part: uniform(who, seed, part))
    copies = F.aggregate(draw, F.lit(0), lambda n, u: n + F.size(F.filter(cdf, lambda c: c <= u)))
    d_n, d_who = fresh(docs, "n", "who")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    drawn = joined.withColumn(d_who, who).withColumn(d_n, copies)
    made = drawn.filter(F.col(d_n) > 0).select(*cols, F.col(d_who), rate.alias("rate"), F.col(d_n).alias("n_copies"),
                                               F.explode(F.sequence(F.lit(1), F.col(d_n))).alias("copy"))
    keyed = made.withColumn("shuffle_key", F.xxhash64(F.lit(seed), F.col(d_who), F.col("copy")))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key").select(*cols, "copy", "n_copies", "rate", "shuffle_key")

"""Joins on overlapping ranges without comparing every pair.

Both sides give a range (a point is a range of length zero).  Ranges are cut
into bands and meet by band, so the join is an equality join:

* A range of length at most 2^L touches at most two bands of width 2^L; L is its
  *level*.  Ranges of very different lengths don't share a width: a pair meets at
  the level of its longer range, where the shorter one also touches two bands at most.
  Each side therefore appears at its own level and at those levels of the other
  side that are higher.  There are at most ``LEVELS`` levels; with ranges of one
  length there is one.
* Where one side has points only, bands are ``2^FINER`` times narrower: a range then
  touches a few more, but meets fewer points outside it.
* A pair that shares several bands is taken in the first of them, and the exact
  condition is applied there, so every pair is looked at once and given once.
* A band with more than ``rows_per_task`` rows on a side is split: that side's rows
  are dealt into parts, the other side's rows visit each part.  With both sides
  heavy this is a grid of parts, and no task holds the band.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, MapType, TimestampNTZType, TimestampType, VariantType

from tillpoint.session import cut_lineage

LEVELS = 31
FINER = 2
ROWS_PER_TASK = 1_000_000
KINDS = ("inner", "left", "left_semi", "left_anti")
_ALIKE = {"left_outer": "left", "leftouter": "left", "semi": "left_semi", "leftsemi": "left_semi", "anti": "left_anti", "leftanti": "left_anti"}


def _bound(c: str | Column) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def _number(df: DataFrame, c: Column) -> Column:
    """A bound as a double; the order of values is kept (near values may become equal)."""
    kind = df.select(c.alias("b")).schema["b"].dataType
    return c.cast("timestamp").cast("double") if isinstance(kind, (DateType, TimestampType, TimestampNTZType)) else c.cast("double")


def _ranged(df: DataFrame, bounds) -> DataFrame:
    """df with its range: _bj_from, _bj_to in their own types, _bj_lo, _bj_hi as doubles; rows without one are left out."""
    lo, hi = map(_bound, bounds if isinstance(bounds, (list, tuple)) else (bounds, bounds))
    out = df.withColumns({"_bj_from": lo, "_bj_to": hi, "_bj_lo": _number(df, lo), "_bj_hi": _number(df, hi)})
    return out.filter("_bj_from <= _bj_to and _bj_lo <= _bj_hi and not isnan(_bj_lo) and not isnan(_bj_hi)")


def _shape(df: DataFrame) -> tuple[float | None, float | None, set[int]]:
    """Smallest and largest finite bound, and the binary exponents of the ranges' lengths (2^e reaches the length)."""
    finite = lambda c: F.when(F.abs(c) < float("inf"), F.col(c))
    length = F.col("_bj_hi") - F.col("_bj_lo")
    row = df.agg(F.min(F.least(finite("_bj_lo"), finite("_bj_hi"))), F.max(F.greatest(finite("_bj_lo"), finite("_bj_hi"))),
                 F.collect_set(F.when(length > 0, F.when(length < float("inf"), F.ceil(F.log2(length)).cast("int")).otherwise(1 << 20)))).first()
    return row[0], row[1], set(row[2])


def _banded(df: DataFrame, base: float, low: int, high: int, others: Sequence[int], finer: int = 0) -> DataFrame:
    """One row per level and band (_bj_at, _bj_band): at the row's own level _bj_lev and at the higher ones of ``others``.

    _bj_first is the row's first band there, so that meeting rows compare whole numbers only.
    """
    # a range without an end reaches as far as anything does
    rows = df.withColumns({"_bj_lo": F.greatest("_bj_lo", F.lit(base)), "_bj_hi": F.least("_bj_hi", F.lit(base + 2.0 ** high))}).filter("_bj_lo <= _bj_hi")
    length = F.col("_bj_hi") - F.col("_bj_lo")
    rows = rows.withColumn("_bj_lev", F.when(length <= 2.0 ** low, low).otherwise(F.least(F.ceil(F.log2(length)).cast("int"), F.lit(high))))
    levels = F.array_compact(F.array_distinct(F.array(F.col("_bj_lev"), *[F.when(F.lit(x) > F.col("_bj_lev"), F.lit(x)) for x in others])))
    rows = rows.withColumn("_bj_at", F.explode(levels))
    place = lambda x: F.floor((F.col(x) - base) / F.pow(F.lit(2.0), F.col("_bj_at") - finer))
    return rows.withColumn("_bj_first", place("_bj_lo")).withColumn("_bj_band", F.explode(F.sequence("_bj_first", place("_bj_hi"))))


def _dealt(df: DataFrame) -> Column:
    """A number that spreads the rows of a band; taken from the row itself, so a repeated task deals alike."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    return F.xxhash64(*plain) if plain else F.lit(0).cast("long")


def _split_heavy(a: DataFrame, b: DataFrame, left: DataFrame, right: DataFrame, rows_per_task: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with _bj_i and _bj_j, the part of the left and of the right side of the band that a row belongs to or visits."""
    keys = ["_bj_at", "_bj_band"]
    none = F.lit(0).cast("long")
    sizes = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), none.alias("m")).union(b.groupBy(*keys).agg(none.alias("n"), F.count(F.lit(1)).alias("m")))
    heavy = sizes.filter((F.col("n") > rows_per_task) | (F.col("m") > rows_per_task))
    parts = lambda c: F.greatest(F.ceil(F.sum(c) / rows_per_task), F.lit(1)).cast("long")
    heavy = cut_lineage(heavy.groupBy(*keys).agg(parts("n").alias("_bj_n"), parts("m").alias("_bj_m")))
    if heavy.isEmpty():
        return tuple(x.withColumns({"_bj_i": none, "_bj_j": none}) for x in (a, b))

    def deal(x: DataFrame, frame: DataFrame, own: str, visits: str, n: str, m: str) -> DataFrame:
        one = F.lit(1).cast("long")
        # the heavy bands are at most the rows over rows_per_task, so they may be broadcast
        x = x.withColumn("_bj_deal", _dealt(frame)).join(F.broadcast(heavy), keys, "left")
        return x.withColumns({own: F.pmod("_bj_deal", F.coalesce(n, one)), visits: F.explode(F.sequence(none, F.coalesce(m, one) - 1))}).drop(
            "_bj_deal", "_bj_n", "_bj_m")

    return deal(a, left, "_bj_i", "_bj_j", "_bj_n", "_bj_m"), deal(b, right, "_bj_j", "_bj_i", "_bj_m", "_bj_n")


def band_join(left: DataFrame, right: DataFrame, left_range, right_range, condition: str | Column | None = None, how: str = "inner",
              rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rows of ``left`` and ``right`` whose closed ranges overlap and that meet ``condition``.

    ``left_range`` and ``right_range`` are one expression (a point) or a pair (low, high) over the side's own
    columns: numbers, dates or timestamps.  ``condition`` may narrow the pairs further (SQL text or a
    Column; the sides are ``l`` and ``r``), for instance to leave an end out.  ``how``: inner, left, left_semi
    or left_anti.  Gives the columns of both sides, as a join does (left_semi and left_anti: of the left one).

    Defined results: a null or NaN bound, or a range whose low end is above its high end, overlaps nothing; infinite bounds
    reach everything; equal rows are rows of their own.  Column names that begin with _bj_ are the operator's own.
    """
    how = _ALIKE.get(how.lower(), how.lower())
    if how not in KINDS:
        raise ValueError(f"a band join can be {', '.join(KINDS)}, not {how!r}; swap the sides for a right join")
    mine, other = left.columns, right.columns
    if how != "inner":
        left = cut_lineage(left.withColumn("_bj_row", F.monotonically_increasing_id()))   # numbers hold once the rows are written
    a, b = _ranged(left, left_range), _ranged(right, right_range)
    shapes = _shape(a), _shape(b)
    ends = [x for s in shapes for x in s[:2] if x is not None]
    base, span = (min(ends), max(ends) - min(ends)) if ends else (0.0, 0.0)
    high = math.ceil(math.log2(span)) if span > 0 else 0
    # the levels in use: points and the shortest ranges share the lowest
    levels = [{min(max(e, high - LEVELS + 1), high) for e in s[2]} for s in shapes]
    low = min(levels[0] | levels[1], default=high - LEVELS + 1)
    finer = FINER if bool(levels[0]) != bool(levels[1]) else 0
    a = _banded(a, base, low, high, sorted(levels[1]), finer)
    b = _banded(b, base, low, high, sorted(levels[0]), finer)
    a, b = _split_heavy(a, b, left, right, rows_per_task)
    a, b = a.alias("l"), b.alias("r")
    keys = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in ("_bj_at", "_bj_band", "_bj_i", "_bj_j")]
    longer = F.col("l._bj_at") == F.greatest("l._bj_lev", "r._bj_lev")
    first = F.col("l._bj_band") == F.greatest("l._bj_first", "r._bj_first")
    overlap = (F.col("l._bj_from") <= F.col("r._bj_to")) & (F.col("r._bj_from") <= F.col("l._bj_to"))
    met = a.join(b, on=reduce(and_, [*keys, overlap, first, longer]))
    if condition is not None:
        met = met.filter(_bound(condition))
    left_cols, right_cols = [F.col(f"l.`{c}`") for c in mine], [F.col(f"r.`{c}`") for c in other]
    if how == "inner":
        return met.select(*left_cols, *right_cols)
    if how in ("left_semi", "left_anti"):
        return left.join(met.select(F.col("l._bj_row").alias("_bj_met")).distinct(), F.col("_bj_row") == F.col("_bj_met"), how).drop("_bj_row")
    got = met.select(F.col("l._bj_row").alias("_bj_met"), *right_cols)
    return left.alias("l").join(got.alias("r"), F.col("l._bj_row") == F.col("r._bj_met"), "left").select(*left_cols, *right_cols)

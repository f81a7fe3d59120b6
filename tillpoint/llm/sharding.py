"""Byte-balanced sharding by sampled splitters (DataFrame functions only).

Rows are put in one global order by (hash of the text, id), so equal texts lie
next to each other.  The order is never sorted as a whole:

1. draw a key sample with probability proportional to a row's size;
2. cut it at weighted quantiles: the splitters of ``ranges`` key ranges;
3. measure every range exactly; a range of more than 1.5 times its share gets
   further splitters from a denser sample of its own (``_subdivide``);
4. move each record to its range and, inside the range, sum sizes in key order.

A record's first byte position in the global order then names its shard, so
shards differ by less than two records' sizes whatever the sample was.  The
result doesn't depend on the sample: it only decides how the work is cut.

On the driver: at most ``max_ranges`` splitters and their totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import fresh, literal, unit_hash, without
from tillpoint.session import cut_lineage

RANGE_BYTES = 64 << 20


def record_size(text: Column) -> Column:
    """UTF-8 bytes plus one; a null counts as an empty text."""
    return F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).cast("long") + F.lit(1).cast("long")


class Splitters:
    """Sorted (hash, id) keys; ``range_of`` numbers the range (lower, upper] that a key falls into."""

    FAN = 64

    def __init__(self, keys: list[tuple], id_type: str):
        self.keys, self.id_type, self.ddl = keys, id_type, f"struct<h:bigint,id:{id_type}>"

    def range_of(self, h: Column, ident: Column) -> Column:
        """Two levels of comparisons, so the cost of a row follows the root of the number of splitters."""
        if not self.keys:
            return F.lit(0)
        as_json = [{"h": h_, "id": i} for h_, i in self.keys]
        fan = max(self.FAN, int(len(as_json) ** 0.5))
        groups = [as_json[i:i + fan] for i in range(0, len(as_json), fan)]
        key = F.struct(h.alias("h"), ident.alias("id"))
        coarse = F.size(F.filter(literal([g[-1] for g in groups[:-1]], f"array<{self.ddl}>"), lambda b: b < key))
        fine = F.element_at(literal(groups, f"array<array<{self.ddl}>>"), coarse + 1)
        return coarse * F.lit(fan) + F.size(F.filter(fine, lambda b: b < key))


def _quantiles(sample: DataFrame, parts: Column, group: list[str]) -> list[tuple]:
    """The last key of each weighted part but the final one; ``sample``: h, id, w and the group columns."""
    by = Window.partitionBy(*group)
    run = by.orderBy("h", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (sample.withColumn("run", F.sum("w").over(run)).withColumn("of", F.sum("w").over(by))
           .withColumn("part", F.floor((F.col("run") - F.col("w")) * parts / F.col("of"))))
    last = cut.groupBy(*group, "part").agg(F.max(F.struct("h", "id")).alias("k")).select("k.h", "k.id")
    return [(r["h"], r["id"]) for r in last.collect()]


def _in_order(keys) -> list[tuple]:
    # an id sorts before another as Spark does it: null first
    return sorted(set(keys), key=lambda k: (k[0], k[1] is not None, k[1] if k[1] is not None else 0))


def _sample(narrow: DataFrame, step: float, seed: int) -> DataFrame:
    """Size-weighted draw: a row of size s is taken with probability s/step, and then weighs max(s, step)."""
    drawn = unit_hash(F.col("h"), F.col("id"), seed=seed) * F.lit(step) < F.col("size")
    return narrow.filter(drawn).withColumn("w", F.greatest(F.col("size").cast("double"), F.lit(step)))


def shard(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", shards: int = 8, ranges: int = 128,
          max_ranges: int = 65_536, oversample: int = 32, seed: int = 17) -> DataFrame:
    """All rows and columns of ``df`` plus size, shard (0..shards-1) and slot (gapless from 0 in each shard).

    Defined results: a null text has size 1; an empty text too; rows with equal
    text and id are one sort key and stay in one range (any of them may get any
    of their slots); an empty table gives an empty table; input columns named
    size, shard or slot are replaced; fewer rows than shards leave shards empty.
    """
    df = without(df, "size", "shard", "slot")
    names = fresh(df, "h", "id", "rid", "run", "at")
    c_h, c_id, c_rid, c_run, c_at = names
    id_type = df.schema[id_col].dataType.simpleString()
    text, ident = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    keyed = df.withColumns({"size": record_size(text), c_h: F.xxhash64(text.cast("string")), c_id: ident})
    narrow = cut_lineage(keyed.select(F.col(c_h).alias("h"), F.col(c_id).alias("id"), "size"))
    n_rows, total = narrow.agg(F.count("*"), F.sum("size")).first()
    if not n_rows:
        return (keyed.withColumns({"shard": F.lit(None).cast("int"), "slot": F.lit(None).cast("long")})
                .select(*df.columns, "size", "shard", "slot"))
    ranges = min(max_ranges, max(ranges, -(-total // RANGE_BYTES)))
    share = total / ranges
    drawn = _sample(narrow, share / oversample, seed).withColumn("all", F.lit(1))
    splitters = Splitters(_in_order(_quantiles(drawn, F.lit(float(ranges)), ["all"]))[:-1], id_type)
    totals = _measure(narrow, splitters)
    splitters, totals = _subdivide(narrow, splitters, totals, share, oversample, seed, max_ranges * 2)

    before_bytes, before_rows, b, r = [], [], 0, 0
    for i in range(len(splitters.keys) + 1):
        size, count = totals.get(i, (0, 0))
        before_bytes.append(b)
        before_rows.append(r)
        b, r = b + size, r + count

    def placed(frame: DataFrame, h: str, ident: str, rid: str, run: str, at: str) -> DataFrame:
        by = Window.partitionBy(rid).orderBy(h, ident).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        first = F.element_at(literal(before_bytes, "array<bigint>"), F.col(rid) + 1) + F.col(run) - F.col("size")
        return (frame.withColumn(rid, splitters.range_of(F.col(h), F.col(ident)))
                .withColumns({run: F.sum("size").over(by), at: F.row_number().over(by)})
                .withColumns({"shard": F.floor(first.cast("decimal(38,0)") * shards / F.lit(total).cast("decimal(38,0)")).cast("int"),
                              at: F.element_at(literal(before_rows, "array<bigint>"), F.col(rid) + 1) + F.col(at) - 1}))

    starts = {row["shard"]: row["at"] for row in
              placed(narrow, "h", "id", "rid", "run", "at").groupBy("shard").agg(F.min("at").alias("at")).collect()}
    first_at = literal([starts.get(s, 0) for s in range(shards)], "array<bigint>")
    out = placed(keyed, *names).withColumn("slot", F.col(c_at) - F.element_at(first_at, F.col("shard") + 1))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], "size", "shard", "slot")


def _measure(narrow: DataFrame, splitters: Splitters) -> dict[int, tuple[int, int]]:
    got = (narrow.groupBy(splitters.range_of(F.col("h"), F.col("id")).alias("rid"))
           .agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect())
    return {r["rid"]: (r["size"], r["n"]) for r in got}


def _subdivide(narrow: DataFrame, splitters: Splitters, totals: dict, share: float, oversample: int, seed: int,
               most: int, rounds: int = 4) -> tuple[Splitters, dict]:
    """Give overfull ranges splitters of their own until none can be cut further.

    A round's sample holds about ``oversample`` rows per part.  What stays
    overfull is one record, or equal keys, larger than the share.
    """
    for turn in range(1, rounds + 1):
        over = {i: -(-size // int(max(1, share))) for i, (size, n) in totals.items() if size > 1.5 * share and n > 1}
        if not over or len(splitters.keys) + sum(over.values()) > most:
            break
        rid = splitters.range_of(F.col("h"), F.col("id"))
        full = narrow.withColumn("rid", rid).filter(F.array_contains(literal(sorted(over), "array<int>"), F.col("rid")))
        parts = F.element_at(literal([float(over.get(i, 0)) for i in range(len(splitters.keys) + 1)], "array<double>"),
                             F.col("rid") + 1)
        more = _quantiles(_sample(full, share / oversample / (1 << turn), seed + turn).withColumn("parts", parts),
                          F.col("parts"), ["rid"])
        keys = _in_order([*splitters.keys, *more])
        if len(keys) == len(splitters.keys):
            break
        splitters = Splitters(keys, splitters.id_type)
        totals = _measure(narrow, splitters)
    return splitters, totals


def write_shards(df: DataFrame, path: str, **options) -> None:
    """Write each shard of ``shard``'s result as its own folder ``shard=N`` of Parquet files."""
    shard(df, **options).write.partitionBy("shard").parquet(path)

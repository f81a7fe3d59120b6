"""Data-quality checks returning result rows (one DataFrame, no driver dicts).

Every check yields rows of one schema::

    check_name, check_type, column_name, violations, total, percentage,
    threshold, passed

* completeness — NULL count per column; passes when nulls/total <= threshold
  (threshold is a fraction, e.g. 0.1);
* uniqueness — rows that sit in key groups of size > 1; passes when their
  percentage <= threshold (threshold is a percentage, e.g. 5.0);
* consistency — rows where a SQL predicate is false or NULL; threshold is a
  fraction (default 0);
* referential — non-NULL keys without a match in a reference frame (anti
  join); threshold is a fraction (default 0).

An empty input passes every check with 0 %.  All completeness and consistency
rules of a run share one scan (``check_rows``); uniqueness is one grouped
aggregate per rule, whose totals come from the same groups.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ["check_name", "check_type", "column_name", "violations", "total",
                  "percentage", "threshold", "passed"]


def _finish(df: DataFrame, name, kind, threshold, fraction: bool) -> DataFrame:
    pct = F.coalesce(F.try_divide(F.col("violations") * 100.0, F.col("total")), F.lit(0.0))
    ratio = F.coalesce(F.try_divide(F.col("violations").cast("double"), F.col("total")), F.lit(0.0))
    passed = (ratio <= threshold) if fraction else (pct <= threshold)
    return df.select(
        F.lit(name).alias("check_name"), F.lit(kind).alias("check_type"),
        F.col("column_name").cast("string"),
        F.col("violations").cast("long"), F.col("total").cast("long"),
        pct.alias("percentage"), (threshold if isinstance(threshold, Column) else F.lit(float(threshold))).alias("threshold"), passed.alias("passed"))


def check_completeness(df: DataFrame, name: str, columns, threshold: float) -> DataFrame:
    agg = df.agg(F.count(F.lit(1)).alias("total"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)])
    stack = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(columns))
    long = agg.selectExpr("total", f"stack({len(columns)}, {stack}) as (column_name, violations)")
    return _finish(long, name, "completeness", threshold, fraction=True)


def check_uniqueness(df: DataFrame, name: str, columns, threshold: float) -> DataFrame:
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    agg = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
                     F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("violations"))
    return _finish(agg.withColumn("column_name", F.lit(",".join(columns))), name, "uniqueness",
                   threshold, fraction=False)


def check_consistency(df: DataFrame, name: str, condition: str, threshold: float = 0.0) -> DataFrame:
    ok = F.coalesce(F.expr(condition), F.lit(False))
    agg = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(~ok).alias("violations"))
    return _finish(agg.withColumn("column_name", F.lit(None)), name, "consistency", threshold, fraction=True)


def check_referential(df: DataFrame, name: str, column: str, ref: DataFrame, ref_column: str,
                      threshold: float = 0.0) -> DataFrame:
    keys = ref.select(F.col(ref_column).alias("_ref")).distinct()
    total = df.agg(F.count(F.lit(1)).alias("total"))
    orphans = (df.filter(F.col(column).isNotNull())
               .join(keys, F.col(column) == F.col("_ref"), "left_anti")
               .agg(F.count(F.lit(1)).alias("violations")))
    # both sides are single-row aggregates; the scalar subquery keeps it join-free
    agg = total.withColumn("violations", orphans.scalar())
    return _finish(agg.withColumn("column_name", F.lit(column)), name, "referential", threshold, fraction=True)


ROW_WISE = ("completeness", "consistency")


def check_rows(df: DataFrame, rules: Mapping[str, Mapping]) -> DataFrame:
    """All completeness and consistency rules from one scan: one aggregate counts every rule's violations."""
    found = []
    for name, rule in rules.items():
        if rule["type"] == "completeness":
            found += [(name, rule, c, F.col(c).isNull()) for c in rule["columns"]]
        elif rule["type"] == "consistency":
            found.append((name, rule, None, ~F.coalesce(F.expr(rule["condition"]), F.lit(False))))
    counts = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(bad).alias(f"_v{i}") for i, (*_, bad) in enumerate(found)])
    each = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"_v{i}").alias("violations"), F.lit(c).cast("string").alias("column_name"),
                              F.lit(name).alias("name"), F.lit(rule["type"]).alias("kind"),
                              F.lit(float(rule.get("threshold", 0.0))).alias("limit")) for i, (name, rule, c, _) in enumerate(found)])
    long = counts.select("total", F.explode(each).alias("e")).select("total", "e.*")
    return _finish(long, F.col("name"), F.col("kind"), F.col("limit"), fraction=True)


def run_checks(df: DataFrame, rules: Mapping[str, Mapping]) -> DataFrame:
    """All rules as one result frame (union of the per-check rows)."""
    parts = [check_rows(df, rules)] if any(r["type"] in ROW_WISE for r in rules.values()) else []
    for name, rule in rules.items():
        kind = rule["type"]
        if kind in ROW_WISE:
            continue
        if kind == "uniqueness":
            parts.append(check_uniqueness(df, name, rule["columns"], rule["threshold"]))
        elif kind == "referential":
            parts.append(check_referential(df, name, rule["column"], rule["ref_df"], rule["ref_column"],
                                           rule.get("threshold", 0.0)))
        else:
            raise ValueError(f"unknown check type {kind!r}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def summarize(results: DataFrame) -> DataFrame:
    """passed_checks / failed_checks / total_checks (a check passes when all
    its rows pass)."""
    per_check = results.groupBy("check_name").agg(F.bool_and("passed").alias("passed"))
    return per_check.agg(
        F.count_if("passed").alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        F.count(F.lit(1)).alias("total_checks"),
    )

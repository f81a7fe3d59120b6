"""A/B experiment statistics: contingency table and chi-square test.

The raw rows are reduced to one row per variant by a grouped aggregate; all
later arithmetic runs on that small frame (one row per arm), inside Spark,
with the survival function written as a Column expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.functions.stats import chi2_sf, safe_div


def contingency(df: DataFrame, variant_col: str = "variant", success_col: str = "converted") -> DataFrame:
    return (df.groupBy(F.col(variant_col).alias("variant")).agg(
        F.count_if(F.coalesce(F.col(success_col), F.lit(False))).alias("success"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn("conversion_rate", F.col("success") / F.col("total"))
        .orderBy("variant"))


def chi_square_test(df: DataFrame, variant_col: str = "variant", success_col: str = "converted",
                    alpha: float = 0.05, correction: bool = True) -> DataFrame:
    """Pearson chi-square on the (variant × {success, failure}) table.

    With one degree of freedom the Yates continuity correction is applied
    (|O−E| reduced by min(0.5, |O−E|)), the usual default for 2×2 tables.
    The grand totals enter as one scalar subquery over the per-variant
    table, so no window and no join is needed.  One output row:
    chi_square, dof, n_variants, p_value, is_significant.
    """
    t = contingency(df, variant_col, success_col).select("variant", "success", "total")
    tot = t.agg(F.struct(F.sum("success").alias("s"), F.sum("total").alias("n"),
                         F.count(F.lit(1)).alias("k")).alias("tot")).scalar()
    t = t.withColumn("_tot", tot)
    n, s_all, k = F.col("_tot.n"), F.col("_tot.s"), F.col("_tot.k")
    dof = k - 1

    def term(observed, expected):
        diff = F.abs(observed - expected)
        shift = F.when(dof == 1, F.least(F.lit(0.5), diff)).otherwise(F.lit(0.0)) if correction else F.lit(0.0)
        return safe_div(F.pow(diff - shift, 2), expected)

    cells = t.select(
        dof.alias("dof"), k.alias("k"),
        (term(F.col("success"), F.col("total") * s_all / n)
         + term(F.col("total") - F.col("success"), F.col("total") * (n - s_all) / n)).alias("term"))
    stat = cells.groupBy().agg(
        # no successes, or no failures: an expected count of zero and no statistic
        F.when(F.count("term") == F.count(F.lit(1)), F.sum("term")).alias("chi_square"),
        F.max("dof").cast("int").alias("dof"),
        F.max("k").cast("int").alias("n_variants"),
    )
    return stat.withColumn("p_value", chi2_sf(F.col("chi_square"), F.col("dof"))).withColumn(
        "is_significant", F.col("p_value") < alpha)

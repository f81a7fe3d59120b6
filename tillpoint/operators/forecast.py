"""Per-series ARIMA(1,1,1) forecasts as grouped Spark computations.

Instead of one driver-side maximum-likelihood fit per product, every series
is estimated at once with the Hannan–Rissanen two-stage least squares method
(no constant):

1. first differences d_t = y_t − y_{t−1};
2. stage 1: AR(1) on d without intercept, a = Σ d_t d_{t−1} / Σ d_{t−1}², and
   residuals e_t = d_t − a·d_{t−1};
3. stage 2: least squares of d_t on (d_{t−1}, e_{t−1}) through the 2×2 normal
   equations gives φ (AR) and θ (MA), clipped to ±0.99; residuals
   u_t = d_t − φ·d_{t−1} − θ·e_{t−1};
4. forecast h steps: y_T + d̂·(1−φ^h)/(1−φ) with d̂ = φ·d_T + θ·u_T;
   AIC = n·ln(SSE/n) + n·(1 + ln 2π) + 2·3.

These estimates differ from exact maximum likelihood (they are its usual
starting values).  Series with fewer than ``min_points`` points get NULL.
Lagged values come from the split window; each stage is a grouped sum combined
map-side.  No step holds a whole series in one task, so one very long series
does not serialise the job.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.operators.sequencing import split_window
from tillpoint.session import cut_lineage

CLIP = 0.99


def _clip(c):
    return F.when(c.isNotNull(), F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), c)))     # greatest and least pass over nulls


def _lagged(series: DataFrame, key: str, time_col: str, value_col: str) -> DataFrame:
    """(key, t, y0, d, d1, d2): the exact position in the series, the value, its difference and the two before it.

    Positions and lags come from the split window, so a long series is spread over many tasks.
    """
    rows = series.select(key, time_col, F.col(value_col).cast("double").alias("y0"))
    lags = [("lag", f"y{i}", "y0", i) for i in (1, 2, 3)]
    seq = split_window(rows, [key], [F.col(time_col).asc()], [("row_number", "t"), *lags])
    return seq.select(key, "t", "y0", *[(F.col(f"y{i}") - F.col(f"y{i + 1}")).alias(d) for i, d in enumerate(("d", "d1", "d2"))])


def arima111_params(series: DataFrame, key: str = "product_id", time_col: str = "date",
                    value_col: str = "sales", min_points: int = 8) -> DataFrame:
    # read once per stage: each stage sums residuals of the one before row by row.  (Sums of raw products would do
    # in one pass, but their differences lose all digits when a series grows steadily.)
    lg = cut_lineage(_lagged(series, key, time_col, value_col))

    def with_estimates(estimates: DataFrame) -> DataFrame:
        return lg.join(estimates.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key"))).drop("_key")

    def products(x, y):
        return F.sum(F.col(x) * F.col(y))

    first = lg.groupBy(key).agg(F.try_divide(products("d", "d1"), products("d1", "d1")).alias("a"))     # NULL for a constant series
    e1 = F.col("d1") - F.col("a") * F.col("d2")                    # the lagged residual of that fit
    ok = F.col("d2").isNotNull()
    second = with_estimates(first).filter(ok).withColumn("e1", e1).groupBy(key).agg(
        F.first("a").alias("a"), products("d1", "d1").alias("sxx"), products("e1", "e1").alias("see"), products("d1", "e1").alias("sxe"),
        products("d1", "d").alias("sxd"), products("e1", "d").alias("sed"))
    det = F.col("sxx") * F.col("see") - F.col("sxe") * F.col("sxe")
    second = second.select(
        key, "a", _clip(F.try_divide(F.col("sxd") * F.col("see") - F.col("sed") * F.col("sxe"), det)).alias("phi"),
        _clip(F.try_divide(F.col("sed") * F.col("sxx") - F.col("sxd") * F.col("sxe"), det)).alias("theta"))
    estimates = lg.select(key).distinct().withColumnRenamed(key, "_k").join(second, F.col("_k").eqNullSafe(F.col(key)), "left").select(
        F.col("_k").alias(key), "a", "phi", "theta")
    resid = F.col("d") - F.col("phi") * F.col("d1") - F.col("theta") * e1
    g = with_estimates(estimates).withColumn("u", F.when(ok, resid)).groupBy(key).agg(
        F.count(F.lit(1)).alias("n_points"), F.first("phi").alias("phi"), F.first("theta").alias("theta"), F.sum(F.col("u") * F.col("u")).alias("sse"),
        F.count(F.when(ok, F.lit(1))).alias("n_resid"), F.max_by(F.struct("y0", "d", "u"), "t").alias("end"))
    g = g.withColumns({"last_value": F.col("end.y0"), "last_diff": F.col("end.d"), "last_resid": F.col("end.u")})
    n = F.col("n_resid")
    sigma2 = F.try_divide(F.col("sse"), n)             # NULL for a constant or too short series
    aic = n * F.log(sigma2) + n * F.lit(1.0 + math.log(2 * math.pi)) + F.lit(6.0)
    enough = F.col("n_points") >= min_points
    return g.select(
        key, "n_points",
        F.when(enough, F.col("phi")).alias("phi"),
        F.when(enough, F.col("theta")).alias("theta"),
        F.when(enough, sigma2).alias("sigma2"),
        F.when(enough, aic).alias("aic"),
        "last_value", "last_diff", "last_resid",
    )


def arima111_forecast(series: DataFrame, steps: int = 7, key: str = "product_id", time_col: str = "date",
                      value_col: str = "sales", min_points: int = 8) -> DataFrame:
    p = arima111_params(series, key, time_col, value_col, min_points)
    dhat = F.col("phi") * F.col("last_diff") + F.col("theta") * F.col("last_resid")
    h = F.col("step")
    level = F.col("last_value") + dhat * (F.lit(1.0) - F.pow(F.col("phi"), h)) / (F.lit(1.0) - F.col("phi"))
    return (p.select(key, "phi", "theta", "last_value", "last_diff", "last_resid",
                     F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
            .select(key, "step", level.alias("forecast")))

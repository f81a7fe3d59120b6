"""Statistical functions as Spark Column expressions.

Spark has no ``erf``, normal CDF or chi-square tail; these are written as
plain arithmetic Columns so they stay inside whole-stage codegen (no Python
round trip).  The same formulas are spelled in the oracle SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abramowitz & Stegun 7.1.26 rational approximation of erf,
# |error| <= 1.5e-7 for x >= 0.
AS_P = 0.3275911
AS_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def erf(x) -> Column:
    x = _c(x)
    ax = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(AS_P) * ax)
    poly = F.lit(0.0)
    for a in reversed(AS_A):              # Horner: t*(a1 + t*(a2 + ...))
        poly = (poly + F.lit(a)) * t
    y = F.lit(1.0) - poly * F.exp(-ax * ax)
    return F.signum(x) * y


#: Where erfc goes over from the series to the continued fraction, and the steps that each needs there (fixed values).
ERFC_SPLIT, ERFC_TERMS, ERFC_STEPS = 2.0, 60, 150


def erfc(z) -> Column:
    """The complementary error function for z >= 0, to about 14 digits of its own value however small.

    Below the split 1 - erf, with erf(z) = 2/sqrt(pi) exp(-z^2) sum_n 2^n z^(2n+1) / (2n+1)!! (positive terms only); above,
    exp(-z^2) / (z sqrt(pi)) over the continued fraction 1 + q/(1 + 2q/(1 + 3q/...)), q = 1/(2 z^2).
    """
    z = _c(z)
    small = F.least(z, F.lit(ERFC_SPLIT))
    series = F.aggregate(
        F.sequence(F.lit(0), F.lit(ERFC_TERMS)), F.struct(F.lit(0.0).alias("s"), small.alias("term")),
        lambda acc, n: F.struct((acc["s"] + acc["term"]).alias("s"), (acc["term"] * 2.0 * small * small / (2 * n + 3)).alias("term")), lambda acc: acc["s"])
    large = F.greatest(z, F.lit(ERFC_SPLIT))
    q = F.lit(0.5) / (large * large)
    fraction = F.aggregate(F.sequence(F.lit(ERFC_STEPS), F.lit(1), F.lit(-1)), F.lit(0.0), lambda acc, n: n * q / (F.lit(1.0) + acc))
    root = F.lit(math.sqrt(math.pi))
    near = F.lit(1.0) - F.lit(2.0) / root * F.exp(-small * small) * series
    return F.when(z < ERFC_SPLIT, near).when(z.isNotNull(), F.exp(-large * large) / (large * root * (F.lit(1.0) + fraction)))


def normal_cdf(x, mean, sd) -> Column:
    """P(X <= x) for X ~ N(mean, sd); NULL when sd is NULL or not positive."""
    x, mean, sd = _c(x), _c(mean), _c(sd)
    z = (x - mean) / (sd * F.lit(math.sqrt(2.0)))
    return F.when(sd > 0, F.lit(0.5) * (F.lit(1.0) + erf(z)))


def chi2_sf(stat, dof) -> Column:
    """Upper tail P(X >= stat) of a chi-square with integer ``dof`` >= 1.

    Even dof:  exp(-x/2) * sum_{i<k/2} (x/2)^i / i!
    Odd dof:   erfc(sqrt(x/2)) + exp(-x/2) * sum_{i=1}^{(k-1)/2} (x/2)^(i-1/2) / Gamma(i+1/2)
    All terms are positive, so small tails keep their digits.  The finite sums run as ``aggregate`` over ``sequence`` (JVM side).
    """
    x = _c(stat).cast("double")
    k = _c(dof).cast("int")
    h = x / 2
    even_sum = F.aggregate(
        F.sequence(F.lit(0), (k / 2).cast("int") - 1),
        F.struct(F.lit(0.0).alias("s"), F.lit(1.0).alias("term")),
        lambda acc, i: F.struct(
            (acc["s"] + acc["term"]).alias("s"),
            (acc["term"] * h / (i + 1)).alias("term")),
        lambda acc: acc["s"],
    )
    # term_i = h^(i-1/2)/Gamma(i+1/2); term_1 = sqrt(h)/Gamma(3/2) = 2 sqrt(h/pi)
    odd_sum = F.when(k >= 3, F.aggregate(
        F.sequence(F.lit(1), ((k - 1) / 2).cast("int")),
        F.struct(F.lit(0.0).alias("s"), (F.sqrt(h) * 2 / F.lit(math.sqrt(math.pi))).alias("term")),
        lambda acc, i: F.struct(
            (acc["s"] + acc["term"]).alias("s"),
            (acc["term"] * h / (i + F.lit(0.5))).alias("term")),
        lambda acc: acc["s"],
    )).otherwise(F.lit(0.0))
    even = F.exp(-h) * even_sum
    odd = erfc(F.sqrt(h)) + F.exp(-h) * odd_sum
    return F.when(k % 2 == 0, even).otherwise(odd)


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode would raise)."""
    return F.try_divide(_c(num), _c(den))

"""Helpers shared by the catalog queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def round_cols(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    """Round aggregated doubles so engines that sum in another order agree."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


def exact_means(df: DataFrame, pairs: dict[str, str], digits: int = 6) -> DataFrame:
    """Re-express means of short decimals as round(mean * n) / n.

    Money columns carry at most five decimals, so the rounded total is exact
    in any engine and the division then gives bit-identical doubles (a plain
    rounded mean would hit decimal ties such as ...2175 at the 7th digit).
    """
    return df.withColumns({m: F.round(F.col(m) * F.col(n), digits) / F.col(n) for m, n in pairs.items()})

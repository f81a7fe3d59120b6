"""Set operations.

Split operators (valid/invalid, normal/anomalous) are written as one tagged
pass with two filters instead of ``A EXCEPT B``: the same rows when the key
is unique, one scan instead of two, and it works with map columns (which set
operations reject).  ``except_distinct`` is kept for plain columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that do not occur in ``right`` (SQL EXCEPT);
    Spark plans it as a hash aggregate over a left-anti join on all columns."""
    return left.subtract(right.select(*left.columns))

"""Contact validation predicates (Column expressions, NULL-safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted e-mail and phone shapes.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE_PATTERN = r"^\+?[0-9]{7,15}$"
PHONE_SEPARATORS = r"[ ()-]"


def valid_email(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.rlike(EMAIL_PATTERN), F.lit(False))


def valid_phone(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.regexp_replace(c, PHONE_SEPARATORS, "").rlike(PHONE_PATTERN), F.lit(False))


def missing_columns(df, required) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def require_columns(df, required, what: str = "frame"):
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"Missing required columns in {what}: {missing}")
    return df

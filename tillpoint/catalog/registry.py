"""Registry of named queries: Spark callables plus their DuckDB oracle SQL.

``register(key, oracle)`` decorates a ``(spark, sf_dir) -> DataFrame``
function.  ``oracle`` is an independent SQL formulation (DuckDB dialect, over
the benchmark tables) or ``None`` for operators that SQL cannot express
(model fits, sketches) — those get a row-count check only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every catalog module so that their queries register."""
    import importlib
    import pkgutil

    import tillpoint.catalog as pkg

    for mod in sorted(m.name for m in pkgutil.iter_modules(pkg.__path__)):
        if mod.startswith("q_"):
            importlib.import_module(f"tillpoint.catalog.{mod}")

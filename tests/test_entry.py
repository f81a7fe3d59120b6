"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_contract(spark):
    m = _entry_module()
    df = m.entry(spark)
    assert df.count() > 0 and "clv_segment" in df.columns
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 100
    assert all(callable(f) for f in q.values()) and all(isinstance(s, str) for s in o.values())
    dealt = [k for k in q if k.startswith("op") and k[2:3].isdigit()]
    assert bool(dealt) == ("pipeline" in q) == os.path.isdir(os.path.join(ROOT, "tillpoint", "llm"))

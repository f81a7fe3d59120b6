"""Every query with an oracle: Spark result == DuckDB result at sf0.001."""

import pytest

from tillpoint.catalog.registry import ORACLES, QUERIES, load_all
from tools.oracle_check import rows_key

from .conftest import SF_SMALL

load_all()


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    cols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLES[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(cols)
    s2 = [tuple(r[cols.index(c)] for c in order) for r in srows]
    o2 = [tuple(r[ocols.index(c)] for c in order) for r in orows]
    assert len(s2) == len(o2)
    assert rows_key(s2, True) == rows_key(o2, True)


def test_every_query_has_a_unique_key():
    assert len(QUERIES) >= 100
    assert set(ORACLES) <= set(QUERIES)

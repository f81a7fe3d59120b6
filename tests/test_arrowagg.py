"""Mergeable Arrow aggregates: equality with built-in ones, hot groups, nulls, flushes, empty tables."""

import pytest
from pyspark.sql import functions as F

from tillpoint.catalog.q_transforms import Variance
from tillpoint.operators import arrowagg as A
from tillpoint.operators.transforms import apply_transformations


class Longest:
    """Several input columns and a text state: the longest tag, and the largest x that came with it."""

    state = "tag string, x double"

    def init(self):
        return None, None

    def update(self, tags, xs):
        return self.merge(list(zip(tags.to_pylist(), xs.to_pylist())))

    def merge(self, states):
        return max((s for s in states if s[0] is not None), key=lambda s: (len(s[0]), s[0], -1e300 if s[1] is None else s[1]), default=(None, None))

    def finish(self, state):
        assert len(state) == 2
        return state[0] and f"{state[0]}:{state[1]}"


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, None if i % 17 == 0 else ("hot" if i % 2 else f"k{i % 40}"), float("nan") if i % 50 == 0 else float(i % 3), None if i % 9 == 0 else i * 0.5, "t" * (i % 6)) for i in range(3000)]
    return spark.createDataFrame(data, "id long, k string, g double, x double, tag string").repartition(6).cache()


def agg(df, keys, cols, fn, kind="double"):
    return {tuple(r)[:-1]: r[-1] for r in A.arrow_aggregate(df, keys, cols, fn, "out", kind).collect()}


@pytest.mark.parametrize("held,merge", [(50_000, 32), (3, 2)])
def test_variance_equals_var_pop(spark, rows, monkeypatch, held, merge):
    monkeypatch.setattr(A, "MAX_HELD", held)
    monkeypatch.setattr(A, "MERGE_AT", merge)
    for keys in (["k"], ["k", "tag"], ["id"], []):
        got = agg(rows, keys, ["x"], Variance())
        want = {tuple(r)[:-1]: r[-1] for r in rows.groupBy(*keys).agg(F.var_pop("x")).collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == want[k] or abs(got[k] - want[k]) < 1e-9 * max(1, abs(want[k])) for k in got)


def test_text_states_nan_keys_and_several_columns(spark, rows):
    got = {repr(k): v for k, v in agg(rows, ["g"], ["tag", "x"], Longest(), "string").items()}
    best = rows.groupBy("g").agg(F.max(F.struct(F.length("tag").alias("n"), "tag", F.coalesce("x", F.lit(-1e300)).alias("x"))).alias("b")).collect()
    assert got == {repr((r["g"],)): f"{r['b']['tag']}:{r['b']['x']}" for r in best}


def test_a_hot_group_is_never_one_series(spark):
    class Largest:
        state = "n long, most long"

        def init(self):
            return 0, 0

        def update(self, x):
            return len(x), len(x)

        def merge(self, states):
            return sum(s[0] for s in states), max(s[1] for s in states)

        def finish(self, state):
            return [state[0], state[1]]

    df = spark.range(40_000).select(F.lit("hot").alias("k"), "id").repartition(8)
    ((_, out),) = agg(df, ["k"], ["id"], Largest(), "array<long>").items()
    assert out[0] == 40_000 and out[1] <= 10_000        # one Arrow batch at most


def test_empty_tables_and_the_declared_step(spark, rows):
    none = rows.limit(0)
    assert agg(none, ["k"], ["x"], Variance()) == {} and agg(none, [], ["x"], Variance()) == {(): None}
    step = {"type": "pandas_udf", "pandas_udf_name": "v", "function": Variance(), "function_type": "mergeable", "group_by": "k", "input_cols": "x",
            "output_col": "v", "return_type": "double"}
    assert apply_transformations(rows, [step]).count() == rows.select("k").distinct().count()
    with pytest.raises(ValueError):
        apply_transformations(rows, [dict(step, function_type="nonsense")])

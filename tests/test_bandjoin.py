"""Band joins against all pairs: levels, ends, skew, join kinds; the gate of the declarative join."""

import datetime as dt
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillpoint.operators.bandjoin import band_join
from tillpoint.operators.transforms import apply_transformations

NUM = "id long, lo double, hi double, tag string"


def pairs(left, right, extra=lambda a, b: True):
    ok = lambda r: r[1] is not None and r[2] is not None and not math.isnan(r[1]) and not math.isnan(r[2]) and r[1] <= r[2]
    return Counter((a[0], b[0]) for a in left for b in right if ok(a) and ok(b) and a[1] <= b[2] and b[1] <= a[2] and extra(a, b))


def run(spark, left, right, how="inner", condition=None, **more):
    a, b = spark.createDataFrame(left, NUM), spark.createDataFrame(right, NUM)
    got = band_join(a, b, ("lo", "hi"), ("lo", "hi"), condition, how, **more)
    assert got.columns == (NUMS * 2 if how in ("inner", "left") else NUMS)
    return got


NUMS = ["id", "lo", "hi", "tag"]


@pytest.fixture(scope="module")
def sides():
    pick = random.Random(5)

    def side(n):
        out = []
        for i in range(n):
            lo = round(pick.uniform(-50, 50), 1)
            out.append((i, lo, lo + pick.choice([0.0, 0.1, 0.1, 0.7, 3.0, 40.0]), pick.choice("ab")))
        return out

    odd = [(900, None, 1.0, "a"), (901, 1.0, None, "a"), (902, 3.0, 2.0, "a"), (903, float("nan"), 2.0, "a"), (904, 0.0, float("nan"), "a"),
           (905, float("-inf"), 0.0, "a"), (906, 0.0, float("inf"), "b"), (907, float("-inf"), float("inf"), "a"), (908, 5.0, 5.0, None), (908, 5.0, 5.0, None)]
    return side(120) + odd, side(90) + odd


def test_equals_all_pairs(spark, sides):
    left, right = sides
    got = run(spark, left, right).collect()
    assert Counter((r[0], r[4]) for r in got) == pairs(left, right)
    got = run(spark, left, right, condition="l.tag = r.tag and l.id < r.id").collect()
    assert Counter((r[0], r[4]) for r in got) == pairs(left, right, lambda a, b: a[3] is not None and a[3] == b[3] and a[0] < b[0])


@pytest.mark.parametrize("rows_per_task", [1, 7, 40])
def test_split_bands_give_the_same_pairs(spark, sides, rows_per_task):
    left, right = sides
    got = run(spark, left, right, rows_per_task=rows_per_task).collect()
    assert Counter((r[0], r[4]) for r in got) == pairs(left, right)


def test_a_hot_band_is_split_into_parts(spark):
    left = [(i, 10.0, 10.0, "h") for i in range(400)] + [(1000 + i, float(i), float(i), "c") for i in range(40)]
    right = [(i, 9.5, 10.5, "h") for i in range(30)]
    got = run(spark, left, right, rows_per_task=50)
    assert got.count() == 30 * 401
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # the hot band's rows carry several parts, so no join key has more than a few times rows_per_task rows
    a = spark.createDataFrame(left, NUM)
    from tillpoint.operators import bandjoin as B
    ranged, other = B._ranged(a, "lo"), B._ranged(spark.createDataFrame(right, NUM), ("lo", "hi"))
    x, y = B._split_heavy(B._banded(ranged, 0.0, 0, 10, [0]), B._banded(other, 0.0, 0, 10, []), a, a, 50)
    assert x.groupBy("_bj_at", "_bj_band", "_bj_i", "_bj_j").count().agg(F.max("count")).first()[0] <= 150


def test_kinds(spark, sides):
    left, right = sides
    want = pairs(left, right)
    met = {a for a, _ in want}
    ids = Counter(r[0] for r in left)
    semi, anti = (Counter(r["id"] for r in run(spark, left, right, k).collect()) for k in ("left_semi", "anti"))
    assert semi + anti == ids and set(semi) == met
    outer = run(spark, left, right, "left").collect()
    assert Counter((r[0], r[4]) for r in outer if r[4] is not None) == want
    assert Counter(r[0] for r in outer if r[4] is None) == anti
    with pytest.raises(ValueError):
        run(spark, left, right, "full")


def test_points_dates_longs_and_empty_sides(spark, sides):
    left, _ = sides
    pts = [(i, x, x, "p") for i, x in enumerate([1.0, 1.0, 2.5, -7.25])]
    assert Counter((r[0], r[4]) for r in run(spark, pts, pts).collect()) == pairs(pts, pts)
    assert run(spark, left, []).count() == 0 and run(spark, [], left).count() == 0 and run(spark, left, [], "left").count() == len(left)
    day = dt.date(2024, 1, 1)
    a = spark.createDataFrame([(i, day + dt.timedelta(days=i), dt.datetime(2024, 1, 1, 12) + dt.timedelta(hours=i)) for i in range(60)], "i long, d date, t timestamp")
    got = band_join(a, a.select(F.col("i").alias("j"), F.col("d").alias("e")), "d", ("e", "date_add(e, 2)"))
    assert got.count() == 60 + 59 + 58
    got = band_join(a, a.select(F.col("i").alias("j"), F.col("t").alias("u")), "t", ("u", "u + interval 1 hour"), "l.t < r.u + interval 1 hour")
    assert got.count() == 60
    big = (1 << 60)
    c = spark.createDataFrame([(big + i,) for i in range(10)], "x long")
    assert band_join(c, c.withColumnRenamed("x", "y"), "x", "y").count() == 10      # doubles alone can't tell these apart


def test_the_join_step_is_gated_by_the_plan(spark):
    a = spark.range(50).selectExpr("id as a", "id as x")
    b = spark.range(50).selectExpr("id as a", "id as y")
    step = lambda c, **more: apply_transformations(a, [{"type": "join", "join_with": "b", "condition": c, **more}], join_dfs={"b": b})
    for refused in ("l.a = r.a or l.x < r.y", "l.x < r.y", "l.a = l.x", "r.a = 3", None):
        with pytest.raises(ValueError):
            step(refused)
    assert step("l.a + 0 = r.a").count() == 50 and step("l.a <=> r.a and l.x <= r.y").count() == 50
    assert step("l.x < r.y", allow_cross=True).count() == 1225
    assert step("l.x < r.y", band={"left": "x", "right": ["y - 3", "y"]}).count() == 49 + 48 + 47


def test_meeting_rows_compare_whole_numbers_in_narrow_bands(spark):
    """Before, every meeting computed a power, and a range met points from bands up to twice its length."""
    left = spark.range(500).select("id", (F.col("id") / 10).alias("x"))
    right = spark.range(500).select(F.col("id").alias("rid"), (F.col("id") / 7).alias("y"))
    got = band_join(left, right, ["x - 0.3", "x + 0.3"], "y")
    plan = got._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any("POWER" in line for line in joins)
    want = left.join(right, (F.col("y") >= F.expr("x - 0.3")) & (F.col("y") <= F.expr("x + 0.3")))
    assert want.count() > 500 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()

"""ML operators: fixed seeds, ranges and structural properties (sf0.001)."""

import glob

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tillpoint.catalog.registry import QUERIES, load_all
from tillpoint.operators import ml as ML
from tillpoint.operators import recommend as R
from tillpoint.session import shared_dir
from tillpoint.sources import fixtures as fx

from .conftest import SF_SMALL

load_all()


def test_churn_probabilities_are_probabilities(spark):
    out = QUERIES["churn_risk"](spark, SF_SMALL)
    stats = out.agg(F.min("churn_risk").alias("lo"), F.max("churn_risk").alias("hi"), F.count("*").alias("n")).collect()[0]
    assert 0.0 <= stats.lo <= stats.hi <= 1.0
    assert stats.n == fx.table(spark, SF_SMALL, "customer").count()


def test_recommendations_at_most_n_per_user(spark):
    out = QUERIES["recommend_als"](spark, SF_SMALL)
    per_user = out.groupBy("customer_id").count().agg(F.max("count")).collect()[0][0]
    assert per_user <= 5
    assert out.filter(F.col("rating") < 0).count() == 0          # nonnegative factors


def test_segments_sit_at_nearest_centre(spark):
    out = QUERIES["segment_customers"](spark, SF_SMALL)
    assert out.filter(~F.col("at_nearest_centre")).count() == 0
    assert out.select("segment").distinct().count() <= 5


def test_fp_growth_single_item_rules_match_pair_rules(spark):
    lines = fx.baskets(spark, SF_SMALL)
    fp = R.association_rules(lines, 0.01, 0.5).filter((F.size("antecedent") == 1) & (F.size("consequent") == 1))
    fp_rows = {(r.antecedent[0], r.consequent[0]): round(r.confidence, 9) for r in fp.collect()}
    pairs = {(r.antecedent, r.consequent): round(r.confidence, 9) for r in R.pair_rules(lines, 0.01, 0.5).collect()}
    assert fp_rows == pairs


def test_als_cross_validation_small_grid(spark):
    ratings = fx.sales_dated(spark, SF_SMALL).select("customer_id", "product_id", "rating")
    model, metrics = ML.train_als_cv(ratings, {"ranks": [4], "max_iters": [3], "reg_params": [0.1, 1.0]}, folds=2)
    rows = metrics.collect()
    assert len(rows) == 2 and all(r.rmse > 0 for r in rows)
    assert model.rank == 4


def test_demand_forecast_one_prediction_per_line(spark):
    out = QUERIES["demand_forecast"](spark, SF_SMALL)
    assert out.count() == fx.table(spark, SF_SMALL, "lineitem").count()
    assert out.filter(F.col("prediction").isNull()).count() == 0


def _sold(spark, copies=1):
    """1,200 rows by copies: three features, a quantity that two of them tell."""
    rows = [(i, float(i % 29), i % 5, 1.0 * (i % 2), float(3 * (i % 5) + (i % 29 > 12) * 20 + i % 4))
            for i in range(1200)] * copies
    return spark.createDataFrame(rows, "id long, price double, rating int, line double, quantity double")


def test_demand_forecast_draws_bags_by_rows_not_partitions(spark):
    """Before, a bag depended on the partitions of the input and the rows' order."""
    sales = _sold(spark)
    one = ML.forecast_demand(sales.coalesce(1), ["price", "rating", "line"], num_trees=4)
    seven = ML.forecast_demand(sales.repartition(7, "rating"), ["price", "rating", "line"], num_trees=4)
    assert one.columns == [*sales.columns, "prediction"]
    found = [{r.id: r.prediction for r in df.collect()} for df in (one, seven)]
    assert found[0].keys() == found[1].keys() == set(range(1200))
    assert all(abs(found[0][i] - found[1][i]) < 1e-9 for i in found[0])


def test_demand_forecast_draws_no_more_for_more_equal_rows(spark, monkeypatch):
    """Before, every row was kept with its count in each of the trees' bags; now rows are counted first."""
    seen, draw = [], ML.bag_sums
    monkeypatch.setattr(ML, "bag_sums", lambda groups, *a: draw(seen.append(groups) or groups, *a))
    for copies in (1, 5):
        out = ML.forecast_demand(_sold(spark, copies), ["price", "rating", "line"], num_trees=2)
        assert out.count() == 1200 * copies and out.filter("prediction is null").count() == 0
    small, large = [g.agg(F.count("*").alias("groups"), F.sum("n").alias("rows")).first() for g in seen]
    assert (small.rows, large.rows) == (1200, 6000) and small.groups == large.groups < 1200


def test_bag_sums_are_those_of_bags_of_rows(spark):
    """A group of n rows is Poisson(n) times in a bag (mean n, variance n), bags differ, and totals are label times weight."""
    groups = spark.createDataFrame([(0, 2.0, 400), (0, 5.0, 100), (1, 3.0, 1)], "c int, label double, n long")
    sums = {(r.c, r.tree): (r.weight, r.total) for r in ML.bag_sums(groups, ["c"], 500, 7).collect()}
    heavy = np.array([sums[0, t][0] for t in range(500)])
    assert abs(heavy.mean() - 500) < 5 and 0.75 < heavy.var() / 500 < 1.25
    assert all(total == 3.0 * weight for (c, _), (weight, total) in sums.items() if c == 1)
    assert abs(np.mean([sums[0, t][1] for t in range(500)]) - (2 * 400 + 5 * 100)) < 15
    assert 0.2 < np.mean([sums[1, t][0] == 0 for t in range(500)]) < 0.55     # a row is absent from 37 % of the bags


def test_demand_forecast_is_as_near_as_mllibs_forest(spark):
    sales, features = _sold(spark), ["price", "rating", "line"]
    forest = RandomForestRegressor(labelCol="quantity", numTrees=20, maxDepth=5, seed=42)
    data = VectorAssembler(inputCols=features, outputCol="features").transform(sales)
    theirs = forest.fit(data).transform(data)
    ours = ML.forecast_demand(sales, features, num_trees=20)
    a, b = [df.agg(F.sqrt(F.avg((F.col("prediction") - F.col("quantity")) ** 2))).first()[0] for df in (theirs, ours)]
    assert b < 1.15 * a
    both = theirs.select("id", F.col("prediction").alias("p")).join(ours, "id")
    assert both.agg(F.corr("p", "prediction")).first()[0] > 0.95


def test_demand_forecast_refuses_missing_values(spark):
    """As MLlib's forest does: neither labels nor features may be missing."""
    sales = _sold(spark)
    for c in ("price", "rating", "quantity"):
        with pytest.raises(Exception, match="must not be NULL, NaN or infinite"):
            ML.forecast_demand(sales.withColumn(c, F.when(F.col("id") != 7, F.col(c))), ["price", "rating"], num_trees=2)


def test_cross_validation_leaves_one_fit_on_disk(spark):
    """Before, every fit of the grid left its checkpoint, and its shuffle files until the driver's next full collection."""
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(12) for i in range(u % 3, 15, 2)]
    ratings = spark.createDataFrame(rows, "customer_id long, product_id long, rating double")
    sc = spark.sparkContext
    shared_dir(spark)
    home = sc._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    before = set(glob.glob(f"{home}/rdd-*"))
    model, metrics = ML.train_als_cv(ratings, {"ranks": [2, 3], "max_iters": [2], "reg_params": [0.1]}, folds=2)
    assert len(set(glob.glob(f"{home}/rdd-*")) - before) == 1          # the winner's
    assert metrics.count() == 2 and model.itemFactors.count() == 15 and model.userFactors.count() == 12

"""Trees grown side by side: the library's, tree for tree, whatever the parts, zeros, copies and the number of rows."""

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tallyspark.operators import indicators as I
from tallyspark.operators import shared_trees as S

COLUMNS = ["a", "b", "c"]


def rows_of(spark, n, parts):
    u = [F.rand(i) for i in range(4)]
    return spark.range(n, numPartitions=parts).select(
        F.floor(u[0] * 4).cast("double").alias("a"), (u[1] * 100).alias("b"), F.when(u[2] < 0.7, 0.0).otherwise(u[2] * 9 - 7).alias("c"), (u[3] < 0.2).alias("held"),
        (F.floor(u[0] * 4) * u[1] * 30 + F.when(u[2] < 0.7, 5.0).otherwise(u[2] * 40)).alias("y"),
    )


def test_draws_are_those_of_rand(spark):
    rows = spark.range(600, numPartitions=3).select(F.spark_partition_id().alias("part"), F.rand(77).alias("u")).collect()
    for part in range(3):
        u = np.array([r["u"] for r in rows if r["part"] == part])
        assert (S.uniforms(77 + part, len(u)) == u).all()
        assert (S.drawn([5, 77 + part], [0.1, 0.6], 90, 80)[1] == (u[90:170] < 0.6)).all()
    assert S.drawn([3], [1.0], 0, 130).all()


@pytest.mark.parametrize("n,block", [(900, 64), (14000, 1 << 15), (30000, 1000)])
def test_trees_are_those_of_the_library(spark, monkeypatch, n, block):
    monkeypatch.setattr(S, "BLOCK", block)
    data = I._learning_rows(rows_of(spark, n, 3), COLUMNS, "y", F.col("held")).persist()
    settings = [{**s, "subsamplingRate": r} for s, r in zip(I.tree_trials(3), (1.0, 0.55, 0.9))]
    shared = S.SharedTrees(data, settings, 42, len(COLUMNS))
    shared.grow([0, 1, 2], 2)
    shared.grow([1, 2], 4)
    found = shared.errors([1, 2]) | {0: shared.errors([0])[0]}
    evaluator = RegressionEvaluator(labelCol="label", predictionCol="prediction")
    for t, trees in ((0, 2), (1, 4), (2, 4)):
        model = GBTRegressor(featuresCol="features", labelCol="label", seed=42 + t, maxIter=trees, **settings[t]).fit(data.where("NOT _held_out"))
        assert found[t] == pytest.approx(evaluator.evaluate(model.transform(data.where("_held_out"))), rel=1e-9)
    shared.close()
    data.unpersist()


def test_rows_without_a_label_are_an_error(spark):
    rows = rows_of(spark, 50, 2).withColumn("y", F.when(F.col("b") > 20, F.col("y")))
    with pytest.raises(Exception, match="labels must not be null"):
        S.SharedTrees(I._learning_rows(rows, COLUMNS, "y", F.col("held")), I.tree_trials(2), 42, len(COLUMNS))


def test_only_the_last_trials_are_fitted_alone(spark, monkeypatch):
    fits, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, *a: fits.append(1) or fit(self, *a))
    _, table = I.search_trees(rows_of(spark, 400, 2), COLUMNS, "y", F.col("held"), trials=6, first=1, keep=3, last=2)
    assert len(fits) == 2 and table.count() == 8

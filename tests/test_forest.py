"""Forests whose lower levels are grown from the rows of a leaf."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array

from eventmill.ml import forest, models
from eventmill.plans import models as plans


def frame(spark, values, labels):
    rows = [(i, [float(x) for x in v], float(c)) for i, (v, c) in enumerate(zip(values, labels))]
    df = spark.createDataFrame(rows, "id long, a array<double>, label double")
    return df.withColumn("features", array_to_vector("a"))


def small_forest(**settings):
    return models.Forest(numTrees=8, maxDepth=30, maxBins=40, seed=42,
                         featureSubsetStrategy="sqrt").setParams(**settings)


def scored(spark, estimator, train, test, whole):
    out = forest.fit_predict(estimator, train, test, whole)
    return {r.id: r for r in out.select("*", vector_to_array("probability").alias("p")).collect()}


def test_deep_levels_are_not_left_to_spark(spark, monkeypatch):
    """Spark's histograms are dense for every node: only the top levels are its work."""
    draw = np.random.default_rng(3)
    rows = frame(spark, draw.normal(size=(1500, 9)), draw.integers(0, 4, 1500))
    depths = []

    class Seen(models.Forest):
        def _create_model(self, java_model):
            model = super()._create_model(java_model)
            depths.append(max(t.depth for t in model.trees))
            return model

    estimator = Seen(numTrees=4, maxDepth=30, maxBins=40, seed=1, featureSubsetStrategy="sqrt")
    monkeypatch.setattr(plans, "vectors", lambda *_: (rows, rows.withColumnRenamed("id", "vec_id")))
    monkeypatch.setitem(models.CLASSIFIERS, "random_forest", lambda: estimator)
    monkeypatch.setattr(forest.fit_predict, "__defaults__", (100,))
    got = plans.clf_probability(spark, "").collect()
    assert len(got) == 1500 and len(depths) == 4 and max(depths) <= 2
    # Grown down to single rows: noise that was trained on is mostly known by heart.
    assert np.mean([r.label == r.prediction for r in got]) > 0.8


def test_forest_is_as_right_as_sparks(spark):
    draw = np.random.default_rng(5)
    values = draw.normal(size=(2400, 9))
    labels = (values[:, 0] > 0) + 2 * (values[:, 1] + values[:, 2] > 0)
    train, test = frame(spark, values[:2000], labels[:2000]), frame(spark, values[2000:], labels[2000:])
    mine = scored(spark, small_forest(), train, test, 0)
    theirs = scored(spark, small_forest(), train, test, 10_000)
    assert set(mine) == set(theirs) == set(range(400))
    right = [np.mean([r.prediction == r.label for r in x.values()]) for x in (mine, theirs)]
    assert right[0] > 0.8 and abs(right[0] - right[1]) < 0.05
    for r in mine.values():
        assert abs(sum(r.p) - 1) < 1e-9 and r.prediction == r.p.index(max(r.p))
        assert list(r.rawPrediction) == pytest.approx([8 * x for x in r.p])


def test_copies_are_kept_and_share_a_prediction(spark):
    """Equal vectors of several labels cannot be split: their leaf has the labels' shares."""
    values = [[0.0, 0.0, 0.0, 0.0]] * 900 + [[1.0, 1.0, 1.0, 1.0]] * 900
    labels = [0.0] * 600 + [1.0] * 300 + [2.0] * 900
    rows = frame(spark, values, labels)
    got = scored(spark, small_forest(), rows, rows, 0)
    assert len(got) == 1800
    assert len({tuple(r.p) for r in got.values()}) == 2
    assert got[0].p[0] == pytest.approx(2 / 3, abs=0.05) and got[0].p[2] == 0
    assert got[1799].p == [0.0, 0.0, 1.0]


def test_depth_is_counted_from_the_root(spark):
    draw = np.random.default_rng(7)
    rows = frame(spark, draw.normal(size=(1500, 4)), draw.integers(0, 2, 1500))
    for depth in (1, 2, 4):
        got = scored(spark, small_forest(maxDepth=depth, numTrees=1), rows, rows, 0)
        assert len({tuple(r.p) for r in got.values()}) <= 2**depth
    model = models.Forest(numTrees=1, maxDepth=3, seed=1).fit(rows)
    depths = forest._leaf_depths(model)
    assert max(depths) == model.trees[0].depth and sum(2.0**-d for d in depths) == 1


def test_small_tables_keep_sparks_forest(spark, sf_dir):
    train, test = plans.vectors(spark, sf_dir)
    got = plans.scored_by_forest(spark, sf_dir).select("vec_id", "probability").collect()
    want = models.fit_predict(models.CLASSIFIERS["random_forest"](), train, test)
    assert sorted(got) == sorted(want.select("vec_id", "probability").collect())


def test_vectors_to_train_on_are_finite(spark):
    rows = frame(spark, [[float("nan"), 1.0]] * 50, [0.0, 1.0] * 25)
    with pytest.raises(Exception, match="finite"):
        forest.fit_predict(small_forest(), rows, rows, 0)

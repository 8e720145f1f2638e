"""The shared k-means passes against Spark's own fits, one at a time."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.linalg import Vectors

from retentia.operators import clustering


def vectors(spark, x):
    return spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(x)], ["id", "features"]).persist()


def test_all_fits_are_those_of_spark(spark):
    rng = np.random.default_rng(5)
    data = vectors(spark, np.vstack([rng.normal(size=(150, 3)) + c for c in ([0, 0, 0], [4, 0, 1], [0, 5, 0])]))
    got = clustering.sweep(data, [2, 4], 2, 7)
    for k in (2, 4):
        fits = [KMeans(k=k, seed=7 + i, featuresCol="features", predictionCol="cluster").fit(data) for i in range(2)]
        want = min(fits, key=lambda m: m.summary.trainingCost)
        model, cost, score = got[k]
        assert np.allclose(model.clusterCenters(), want.clusterCenters(), atol=1e-9) and cost == pytest.approx(want.summary.trainingCost)
        evaluator = ClusteringEvaluator(predictionCol="cluster", featuresCol="features")
        assert score == pytest.approx(evaluator.evaluate(want.transform(data)))
        both = model.transform(data).select("id", "cluster").collect()
        assert sorted(both) == sorted(want.transform(data).select("id", "cluster").collect())


def test_a_step_of_all_fits_is_one_pass(spark, monkeypatch):
    """Passes over the rows are bounded by the steps of the longest fit, not by the number of fits."""
    data, passes, summed = vectors(spark, np.random.default_rng(6).normal(size=(120, 2))), [], clustering._summed

    def counted(blocks, parts, outcome):
        passes.append(len(parts))
        return summed(blocks, parts, outcome)

    monkeypatch.setattr(clustering, "_summed", counted)
    assert set(clustering.sweep(data, [2, 3], 3)) == {2, 3}
    assert passes[0] == 6 and len(passes) <= 20 + 2


def test_one_cluster_has_no_silhouette(spark):
    blocks = clustering._packed(vectors(spark, np.zeros((5, 2))))
    with pytest.raises(ValueError):
        clustering.silhouettes(blocks, [np.array([[0.0, 0.0], [9.0, 9.0]])])

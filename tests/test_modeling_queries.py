"""Modelling queries run the whole job: the operators' defaults, not smaller ones."""

import inspect
from unittest.mock import Mock

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors

from retentia.operators.models import PipelineSpec
from retentia.operators.reduction import fit_kpca, kernel_matrix
from retentia.plans import training
from retentia.queries import load, modeling

SF = "/root/testdata/sf0.001"


class Stop(Exception):
    pass


@pytest.fixture
def calls(monkeypatch):
    """Arguments, defaults filled in, of the training function that a query calls."""

    def run(name):
        monkeypatch.setattr(modeling, "features", lambda spark, sf: None)
        monkeypatch.setattr(modeling, "scratch", lambda spark, label: label)
        for f in ("holdout_evaluation", "cross_validate", "search", "compare_reducers", "fit_pipeline"):
            signature = inspect.signature(getattr(training, f))

            def stop(*args, signature=signature, **options):
                bound = signature.bind(*args, **options)
                bound.apply_defaults()
                raise Stop(bound.arguments)

            monkeypatch.setattr(modeling.t, f, stop)
        with pytest.raises(Stop) as error:
            load()[0][name](Mock(), SF)
        return error.value.args[0]

    return run


@pytest.mark.parametrize(
    "name",
    [
        "model_random_forest", "model_boosting_depth", "model_boosting_leaf", "model_logistic_regression", "cross_validation", "search_trials",
        "reducer_comparison", "feature_importance", "coefficient_importance", "permutation_importance", "run_log", "pipeline_round_trip",
    ],
)
def test_queries_run_the_whole_fit(calls, name):
    got = calls(name)
    assert got["spec"].oversample and got["spec"].params == PipelineSpec("", ()).params == {}
    assert got.get("k", 5) == 5
    if name == "search_trials":
        assert got["trials"] == 30 and got["methods"] == ("none", "rfe", "pca", "kpca")


@pytest.mark.parametrize("name", ["cluster_elbow", "cluster_profile"])
def test_clusters_are_searched_whole(monkeypatch, name):
    signature = inspect.signature(modeling.clustering.segment)

    def stop(*args, **options):
        bound = signature.bind(*args, **options)
        bound.apply_defaults()
        raise Stop(bound.arguments)

    monkeypatch.setattr(modeling, "churn_base", lambda spark, sf: None)
    monkeypatch.setattr(modeling.clustering, "segment", stop)
    with pytest.raises(Stop) as error:
        load()[0][name](None, SF)
    assert list(error.value.args[0]["ks"]) == list(range(2, 11)) and error.value.args[0]["n_init"] == 10


@pytest.mark.parametrize("kernel", ["rbf", "poly", "cosine"])
def test_kernel_pca_of_all_rows(spark, kernel):
    """More rows than one batch of landmarks, with a rare far group; equal to the eigenvectors of the whole kernel matrix."""
    x = np.random.default_rng(3).normal(size=(900, 5))
    x[:8] = x[:8] * 0.1 + 6
    df = spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(x)], ["id", "features"])
    out = fit_kpca(df, "features", 3, kernel, key="id").transform(df)
    got = np.array([r.z for r in out.select("id", vector_to_array("reduced").alias("z")).orderBy("id").collect()])
    k = kernel_matrix(x, x, kernel, 0.2, 3, 1.0)
    k = k - k.mean(0) - k.mean(1)[:, None] + k.mean()
    values, vectors = np.linalg.eigh(k)
    for j in range(3):
        want = vectors[:, -1 - j] * np.sqrt(values[-1 - j])
        assert min(np.abs(got[:, j] - want).max(), np.abs(got[:, j] + want).max()) < 1e-3 * np.abs(want).max()

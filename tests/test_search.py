"""Search and shared folds: the sampler on known functions, group fits, and folds that equal fits of each fold alone."""

from math import log

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from retentia.operators import folds as shared
from retentia.operators.models import PipelineSpec
from retentia.operators.newton import fit_logistic_groups, logistic_scores
from retentia.operators.sampling import stratified_folds
from retentia.operators.smote import smote, smote_groups
from retentia.operators.stages import DataImputer, RobustScalerTransformer, StandardScalerTransformer
from retentia.operators.tpe import Mixture, TpeSampler, uniform
from retentia.plans import training

SPACE = {"x": ("float", -5.0, 5.0), "rate": ("log_float", 1e-4, 1.0), "n": ("int", 1, 30), "kind": ("categorical", ["a", "b", "c"])}


def goal(p):
    return -((p["x"] - 1.3) ** 2) - (log(p["rate"]) - log(0.02)) ** 2 - 0.05 * (p["n"] - 17) ** 2 - 2.0 * (p["kind"] != "b")


def best(sampler, trials):
    scores = []
    for _ in range(trials):
        params = sampler.suggest_all(SPACE)
        scores.append(goal(params))
        sampler.tell(params, scores[-1])
    return max(scores)


def test_tpe_beats_uniform_draws():
    tpe = [best(TpeSampler(seed), 60) for seed in range(12)]
    plain = [best(TpeSampler(seed, startup=60), 60) for seed in range(12)]
    assert np.median(tpe) > np.median(plain) / 2 and np.mean(np.array(tpe) > np.array(plain)) >= 0.75


def test_draws_stay_in_the_space():
    sampler = TpeSampler(3, startup=2)
    for k in range(40):
        params = sampler.suggest_all(SPACE)
        assert -5 <= params["x"] <= 5 and 1e-4 <= params["rate"] <= 1 and params["n"] in range(1, 31) and params["kind"] in "abc"
        assert type(params["n"]) is int
        sampler.tell({**params, "only_odd": 1.0} if k % 2 else params, float("nan") if k % 7 == 0 else goal(params))
    assert len(sampler.trials) == 34 and 0 <= sampler.suggest("only_odd", ("float", 0, 2)) <= 2
    assert sampler.suggest("fixed", ("int", 4, 4)) == 4
    for wrong in (("half", 1, 2), ("", 0, 0)):
        with pytest.raises(ValueError):
            sampler.suggest("w", wrong)
        with pytest.raises(ValueError):
            uniform(wrong, sampler.rng)


def test_mixture_is_a_density():
    m = Mixture([0.2, 0.21, 0.9], 0.0, 1.0)
    grid = np.linspace(0, 1, 20001)
    assert abs(np.trapezoid([np.exp(m.log_density(x)) for x in grid], grid) - 1) < 1e-3
    whole = Mixture([3, 7], 0.5, 10.5, 1.0)
    assert abs(sum(np.exp(whole.log_density(x)) for x in range(1, 11)) - 1) < 1e-9


@pytest.mark.parametrize("penalty", ["l2", "l1"])
def test_groups_reach_the_minimum(spark, penalty):
    """At the minimum, the gradient of each group balances the penalty."""
    rng, rows = np.random.default_rng(4), []
    for t in range(3):
        for _ in range(150):
            x = rng.normal(size=4) * [1, 3, 1, 1]
            rows.append((t, [float(v) for v in x], float(rng.random() < 1 / (1 + np.exp(-(x[0] - 0.5 * x[1] + 0.2)))), float(rng.choice([1.0, 2.5]))))
    df = spark.createDataFrame(rows, "t int, x array<double>, y double, w double").repartition(5)
    C = 0.05
    betas = fit_logistic_groups(df, [0, 1, 2, 9], 4, C, penalty)
    assert not betas[9].any()
    for t in range(3):
        own = [r for r in rows if r[0] == t]
        x = np.array([[1, *r[1]] for r in own])
        y, w = np.array([r[2] for r in own]), np.array([r[3] for r in own])
        slope = x.T @ (w * (1 / (1 + np.exp(-x @ betas[t])) - y))
        assert abs(slope[0]) < 1e-4
        if penalty == "l2":
            assert np.abs(slope[1:] + betas[t][1:] / C).max() < 1e-4
        else:
            zero = betas[t][1:] == 0
            assert zero.any() and (np.abs(slope[1:][zero]) <= 1 / C + 1e-4).all()
            assert np.abs(slope[1:][~zero] + np.sign(betas[t][1:][~zero]) / C).max() < 1e-4
    got = logistic_scores(df, betas, ["t", "y"]).toPandas()
    assert list(got.columns) == ["t", "y", "p"] and len(got) == 450 and got["p"].between(0, 1).all()


def test_oversampled_groups_are_those_of_each_alone(spark):
    rng = np.random.default_rng(8)
    rows = [(t, k, [float(v) for v in rng.normal(size=3)], float(k % (4 + t) == 0)) for t in range(3) for k in range(-60, 60)]
    df = spark.createDataFrame(rows, "t int, id long, x array<double>, y double")
    got = smote_groups(df, "t", "id", 3, block_rows=40).select("t", F.transform("x", lambda v: F.round(v, 9)).alias("x"), "y").collect()
    for t in range(3):
        own = df.where(F.col("t") == t).withColumn("features", array_to_vector("x"))
        want = smote(own, "id", "features", "y", 3).select(F.transform(vector_to_array("features"), lambda v: F.round(v, 9)).alias("x"), "y").collect()
        assert sorted((tuple(r["x"]), r["y"]) for r in got if r["t"] == t) == sorted((tuple(r["x"]), r["y"]) for r in want)
    even = smote_groups(df.withColumn("y", (F.col("id") % 2 == 0).cast("double")), "t", "id", 3)
    assert even.count() == 360
    with pytest.raises(ValueError):
        smote_groups(df.where("y = 0 OR id = 0"), "t", "id", 3)


SETTINGS = [
    {"column": "a", "strategy": "median"}, {"column": "b", "strategy": "median_by_group", "group_column": "g"}, {"column": "c", "strategy": "mode"},
    {"column": "s", "strategy": "mode"}, {"column": "d", "strategy": "constant", "fill_value": 7}, {"column": "e", "strategy": "median", "fallback_value": 5},
    {"column": "absent", "strategy": "median"},
]


@pytest.fixture(scope="module")
def table(spark):
    rng, rows = np.random.default_rng(9), []
    for k in range(240):
        gone = rng.random(5) < 0.2
        values = [float(rng.integers(0, 30)), float(rng.normal()), float(rng.integers(0, 4)), float(rng.normal())]
        rows.append((k, int(rng.random() < 0.25), *[None if g else v for g, v in zip(gone, values)], None, "xyz"[int(rng.integers(3))] if not gone[4] else None, "pq"[k % 2], abs(float(rng.normal() * 9))))
    return spark.createDataFrame(rows, "k long, y int, a double, b double, c double, d double, e double, s string, g string, f double")


def test_statistics_of_all_folds_at_once(spark, table):
    cut = stratified_folds(table, "k", "y", 4).persist()
    made = shared.fit_imputers(cut, SETTINGS, "fold", 4)
    long = None
    for t in range(4):
        train = cut.where(F.col("fold") != t)
        want = DataImputer(SETTINGS)._fit(train)
        assert made[t].value == want.value
        assert sorted(map(tuple, made[t].tables["g"].collect())) == sorted(map(tuple, want.tables["g"].select(made[t].tables["g"].columns).collect()))
        part = made[t].transform(train).withColumn("t", F.lit(t))
        long = part if long is None else long.unionByName(part)
    scalers = shared.fit_scalers(long, ["a", "b"], ["f", "d"], ["f"], 4)
    for t in range(4):
        own = long.where(F.col("t") == t)
        standard = StandardScalerTransformer(["a", "b"])._fit(own).value
        robust = RobustScalerTransformer({"columns": ["f", "d"], "log_columns": ["f"]})._fit(own).value
        for got, want in zip(scalers[t], (standard, robust)):
            assert [e["column"] for e in got.value] == [e["column"] for e in want]
            for a, b in zip(got.value, want):
                assert a["center"] == pytest.approx(b["center"], abs=1e-12) and a["spread"] == pytest.approx(b["spread"], abs=1e-12)
    cut.unpersist()


def spec(**options):
    imputation = tuple(s for s in SETTINGS if s["column"] not in ("s", "absent", "e"))
    return PipelineSpec("logistic_regression", ("a", "b", "c", "d", "f"), imputation=imputation, standard=("a", "b"), robust=("f",), log_first=("f",), **options)


@pytest.mark.parametrize("reducer", [{"method": "none"}, {"method": "pca", "n_components": 3}, {"method": "rfe", "n_features_to_select": 3, "rfe_estimator": "logistic_regression"}, {"method": "lda", "n_components": 1}])
def test_folds_equal_fits_of_each_fold(spark, table, reducer):
    from retentia.operators.models import fit_pipeline

    one = spec(reducer=reducer)
    got = shared.Folds(table, "k", "y", one, 3).scores(one, {"C": 1.0, "penalty": "l2", "max_iter": 100}).toPandas()
    cut = stratified_folds(table, "k", "y", 3)
    for t in range(3):
        fitted = fit_pipeline(cut.where(F.col("fold") != t), "k", "y", one)
        want = sorted(r["p"] for r in fitted.score(cut.where(F.col("fold") == t)).select("p").collect())
        assert np.allclose(sorted(got[got["fold"] == t]["p"]), want, atol=2e-3)


def test_search_keeps_what_trials_share(spark, table, monkeypatch):
    made = []
    monkeypatch.setattr(shared, "elimination", lambda *a, f=shared.elimination, **b: made.append(1) or f(*a[:4], "logistic_regression"))
    monkeypatch.setattr(training, "REDUCER_SPACES", {"none": {}, "rfe": {"n_features_to_select": ("int", 3, 4)}, "pca": {"n_components": ("int", 2, 3)}})
    rows, best_spec, better = training.search(table, "k", "y", spec(), trials=6, k=3, methods=("none", "rfe", "pca"))
    found = rows.collect()
    assert len(made) == 3 and [r["trial"] for r in found] == list(range(-1, 6))
    top = max(r["cv_roc_auc"] for r in found)
    assert better == (top > found[0]["cv_roc_auc"]) and (best_spec.params != {}) == better

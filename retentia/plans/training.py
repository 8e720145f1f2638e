"""Cross-validation, search, holdout evaluation and the reduction comparison."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from time import perf_counter

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.functions.expr import named
from retentia.operators.metrics import METRICS, classification_metrics
from retentia.operators.folds import Folds
from retentia.operators.models import DEFAULTS, LINEAR, REDUCER_SPACES, SPACES, FittedPipeline, PipelineSpec, fit_pipeline
from retentia.operators.sampling import stratified_split
from retentia.operators.tpe import TpeSampler
from retentia.plans.preprocessing import BASE_FEATURES, IMPUTATION, LOG_COLUMNS, ROBUST_COLUMNS, STANDARD_COLUMNS
from retentia.session import cut_lineage, fit_width

log = logging.getLogger(__name__)

# Decision thresholds.
DEFAULT_THRESHOLD = 0.50
TUNED_THRESHOLD = 0.40

# Columns of the snapshot's feature table that can be null, beyond the configured imputation.
_MORE_IMPUTATION = (
    {"column": "HasCrCard", "strategy": "mode"},
    {"column": "SatisfactionScore", "strategy": "median"},
    {"column": "AgeInactivity", "strategy": "median"},
    {"column": "EngagementScore", "strategy": "mode"},
    {"column": "BalanceSalaryRatio", "strategy": "median"},
    {"column": "AgeGroup", "strategy": "mode"},
)


def base_spec(model: str, **options) -> PipelineSpec:
    """The pipeline over the snapshot's feature table; group proxy is a one-hot column."""
    imputation = tuple({**s, "group_column": "geo_EUROPE"} if "group_column" in s else s for s in IMPUTATION)
    return PipelineSpec(
        model, tuple(BASE_FEATURES), imputation=(*imputation, *_MORE_IMPUTATION), standard=tuple(STANDARD_COLUMNS),
        robust=tuple(ROBUST_COLUMNS), log_first=tuple(LOG_COLUMNS), **options,
    )


def cross_validate(
    df: DataFrame, key: str, target: str, spec: PipelineSpec, k: int = 5, threshold: float = DEFAULT_THRESHOLD,
    seed: int = 42, parallelism: int = 5, folds: Folds | None = None,
) -> DataFrame:
    """(fold, five metrics). The folds share their statistics, and with `folds` also what earlier fits of them made."""
    folds = folds or Folds(df, key, target, spec, k, seed, spec.model in LINEAR, parallelism)
    scored = folds.scores(spec, {**DEFAULTS[spec.model], **spec.params})
    rows = classification_metrics(cut_lineage(scored), "y", "p", threshold, ["fold"]).select((F.col("fold") + 1).alias("fold"), *METRICS)
    found = rows.collect()  # k rows
    return df.sparkSession.createDataFrame(found, rows.schema)


def summary(folds: DataFrame) -> dict[str, float]:
    """cv_<metric>_mean and cv_<metric>_std."""
    aggs = [a for m in METRICS for a in (F.avg(m).alias(f"cv_{m}_mean"), F.stddev_samp(m).alias(f"cv_{m}_std"))]
    return folds.agg(*aggs).first().asDict()


def holdout_evaluation(
    df: DataFrame, key: str, target: str, spec: PipelineSpec, test_size: float = 0.20, threshold: float = TUNED_THRESHOLD, seed: int = 42
) -> tuple[FittedPipeline, DataFrame, DataFrame]:
    """(fitted pipeline, scored holdout, one row of metrics)."""
    split = stratified_split(df, key, target, test_size, seed).persist()
    split = fit_width(split)
    fitted = fit_pipeline(split.where("split = 'train'"), key, target, spec)
    scored = fitted.score(split.where("split = 'holdout'"))
    return fitted, scored, classification_metrics(scored, target, "p", threshold)


def search(
    df: DataFrame, key: str, target: str, spec: PipelineSpec, trials: int = 30, k: int = 5, seed: int = 42,
    methods=("none", "rfe", "pca", "kpca"), space: dict | None = None, sampler: TpeSampler | None = None,
    at_once: int = 6,
) -> tuple[DataFrame, PipelineSpec, bool]:
    """(trial table, best spec, whether it beat the given one). Invalid draws are skipped.

    The reducer is drawn together with the model's parameters, its own parameters after it. All trials run on the same
    folds, whose prepared rows, elimination orders and oversampled rows are made once. `at_once` trials are drawn and
    run side by side; the sampler learns of them when all of these are done, so that results do not depend on speed.
    """
    sampler = sampler or TpeSampler(seed)
    space = SPACES[spec.model] if space is None else space
    folds = Folds(df, key, target, spec, k, seed, spec.model in LINEAR)
    baseline = summary(cross_validate(df, key, target, spec, k, seed=seed, folds=folds))["cv_roc_auc_mean"]
    rows, best, best_auc = [(-1, "baseline", str(spec.params), spec.reducer["method"], baseline)], spec, baseline
    if "rfe" in methods:
        # Down to the fewest that a trial may ask for, once.
        folds.elimination_orders(min(REDUCER_SPACES["rfe"]["n_features_to_select"][1], len(spec.features)))

    def run(trial):
        t, candidate, _ = trial
        start = perf_counter()
        try:
            auc = summary(cross_validate(df, key, target, candidate, k, seed=seed, folds=folds))["cv_roc_auc_mean"]
        except ValueError as error:
            log.warning("trial %d skipped: %s", t, error)
            return None
        log.info("trial %d: %s, area %.4f, %.1f s", t, candidate.reducer["method"], auc, perf_counter() - start)
        return auc

    with ThreadPoolExecutor(at_once) as pool:
        for first in range(0, trials, at_once):
            batch = []
            for t in range(first, min(first + at_once, trials)):
                params = sampler.suggest_all(space)
                method = sampler.suggest("reducer_method", ("categorical", list(methods)))
                options = sampler.suggest_all(REDUCER_SPACES[method], "red_")
                reducer = {"method": method, **{name.removeprefix("red_"): value for name, value in options.items()}}
                candidate = replace(spec, params={**spec.params, **params}, reducer=reducer)
                batch.append((t, candidate, {**params, "reducer_method": method, **options}))
            for (t, candidate, drawn), auc in zip(batch, pool.map(inheritable_thread_target(df.sparkSession)(run), batch)):
                if auc is None:
                    continue
                sampler.tell(drawn, auc)
                rows.append((t, "trial", str(candidate.params), candidate.reducer["method"], auc))
                if auc > best_auc:
                    best, best_auc = candidate, auc
    table = df.sparkSession.createDataFrame(rows, "trial int, kind string, params string, reducer string, cv_roc_auc double")
    return table, best, best is not spec


def compare_reducers(
    df: DataFrame, key: str, target: str, spec: PipelineSpec, reducers: list[dict], k: int = 5, seed: int = 42
) -> DataFrame:
    """Per reducer cross-validated and holdout metrics, best holdout AUC first."""
    split = stratified_split(df, key, target, seed=seed).persist()
    train, rows = split.where("split = 'train'").drop("split"), []
    try:
        for r in reducers:
            candidate = replace(spec, reducer=r)
            cv = summary(cross_validate(train, key, target, candidate, k, seed=seed))
            fitted = fit_pipeline(train, key, target, candidate)
            scored = fitted.score(split.where("split = 'holdout'"))
            h = classification_metrics(scored, target, "p", TUNED_THRESHOLD).first()
            rows.append((r["method"], len(fitted.names), cv["cv_roc_auc_mean"], cv["cv_f1_mean"], cv["cv_recall_mean"], h["roc_auc"], h["f1"], h["recall"]))
    finally:
        split.unpersist()
    table = df.sparkSession.createDataFrame(
        rows, "method string, n_features int, cv_roc_auc double, cv_f1 double, cv_recall double, holdout_roc_auc double, holdout_f1 double, holdout_recall double"
    )
    return table.orderBy(F.col("holdout_roc_auc").desc(), "method")


def target_share(df: DataFrame, target: str) -> float:
    return df.agg(F.avg(named(target))).first()[0]

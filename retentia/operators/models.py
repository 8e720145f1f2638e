"""Classifiers by name, and the leak-free pipeline around them."""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass, field
from math import ceil, log2

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retentia.functions.expr import named
from retentia.operators.reduction import fit_reducer
from retentia.operators.sampling import random_sample, with_class_weight
from retentia.operators.smote import smote
from retentia.operators.stages import DataImputer, RobustScalerTransformer, StandardScalerTransformer
from retentia.session import fit_width

log = logging.getLogger(__name__)

# Default parameters and search spaces of the four model families.
DEFAULTS = {
    "logistic_regression": {"C": 1.0, "penalty": "l2", "class_weight": "balanced", "max_iter": 1000},
    "random_forest": {"n_estimators": 200, "max_depth": 10, "class_weight": "balanced"},
    "boosting_depth": {
        "n_estimators": 300, "max_depth": 5, "learning_rate": 0.05, "scale_pos_weight": 3.91,
        "subsample": 0.8, "colsample": 0.8,
    },
    "boosting_leaf": {
        "n_estimators": 300, "num_leaves": 31, "learning_rate": 0.05, "class_weight": "balanced",
        "subsample": 0.8, "colsample": 0.8, "min_child_samples": 20,
    },
}
SPACES = {
    "logistic_regression": {
        "C": ("log_float", 1e-3, 100.0), "penalty": ("categorical", ["l2", "l1"]),
    },
    "random_forest": {
        "n_estimators": ("int", 100, 500), "max_depth": ("int", 5, 20), "min_samples_leaf": ("int", 1, 20),
        "max_features": ("categorical", ["sqrt", "log2"]),
    },
    "boosting_depth": {
        "n_estimators": ("int", 100, 600), "max_depth": ("int", 3, 10), "learning_rate": ("log_float", 0.01, 0.3),
        "subsample": ("float", 0.5, 1.0), "colsample": ("float", 0.4, 1.0), "scale_pos_weight": ("float", 1.0, 6.0),
    },
    "boosting_leaf": {
        "n_estimators": ("int", 100, 600), "num_leaves": ("int", 20, 100), "learning_rate": ("log_float", 0.01, 0.3),
        "subsample": ("float", 0.5, 1.0), "colsample": ("float", 0.4, 1.0), "min_child_samples": ("int", 10, 100),
    },
}
REDUCER_SPACES = {
    "none": {},
    "rfe": {"n_features_to_select": ("int", 8, 16)},
    "pca": {"n_components": ("int", 8, 18)},
    "kpca": {
        "n_components": ("int", 8, 18), "kernel": ("categorical", ["rbf", "poly", "cosine"]),
        "gamma": ("log_float", 1e-4, 10.0), "degree": ("int", 2, 5), "coef0": ("float", 0.0, 1.0),
    },
}
LINEAR = ("logistic_regression",)
WEIGHT = "_weight"


def build_estimator(kind: str, params: dict, features: str, label: str, rows: int, seed: int = 42):
    """The Spark classifier for a family. Parameters without a counterpart are refused."""
    if kind not in DEFAULTS:
        raise ValueError(f"unknown model {kind!r}")
    p = {**DEFAULTS[kind], **params}
    common = {"featuresCol": features, "labelCol": label, "weightCol": WEIGHT}
    p.pop("class_weight", None), p.pop("scale_pos_weight", None)  # both act through the weight column
    if kind == "logistic_regression":
        penalty = p.pop("penalty")
        if penalty not in ("l1", "l2"):
            raise ValueError(f"penalty must be l1 or l2, not {penalty!r}")
        made = LogisticRegression(
            regParam=1.0 / (p.pop("C") * rows), elasticNetParam=1.0 if penalty == "l1" else 0.0,
            maxIter=p.pop("max_iter"), standardization=False, tol=p.pop("tol", 1e-5), **common,
        )
    elif kind == "random_forest":
        made = RandomForestClassifier(
            numTrees=p.pop("n_estimators"), maxDepth=p.pop("max_depth"), minInstancesPerNode=p.pop("min_samples_leaf", 1),
            featureSubsetStrategy=p.pop("max_features", "sqrt"), seed=seed, **common,
        )
    else:
        if kind == "boosting_leaf":
            # Depth-wise trees with at least that many leaves; Spark grows no leaf-wise ones.
            depth, smallest = ceil(log2(p.pop("num_leaves"))), p.pop("min_child_samples")
        else:
            depth, smallest = p.pop("max_depth"), 1
        made = GBTClassifier(
            maxIter=p.pop("n_estimators"), maxDepth=depth, stepSize=p.pop("learning_rate"), subsamplingRate=p.pop("subsample"),
            featureSubsetStrategy=str(p.pop("colsample")), minInstancesPerNode=smallest, seed=seed, **common,
        )
    if p:
        raise ValueError(f"{kind} has no counterpart for {sorted(p)}")
    return made


@dataclass(frozen=True)
class PipelineSpec:
    """impute -> scale (linear models) -> assemble -> reduce -> oversample (fit only) -> classify."""

    model: str
    features: tuple[str, ...]
    params: dict = field(default_factory=dict)
    reducer: dict = field(default_factory=lambda: {"method": "none"})
    imputation: tuple[dict, ...] = ()
    standard: tuple[str, ...] = ()
    robust: tuple[str, ...] = ()
    log_first: tuple[str, ...] = ()
    oversample: bool = True
    k_neighbours: int = 5
    seed: int = 42


@dataclass
class FittedPipeline:
    model: PipelineModel
    names: list[str]
    spec: PipelineSpec

    def score(self, df: DataFrame, into: str = "p") -> DataFrame:
        """Adds the probability of the positive class."""
        out = self.model.transform(df)
        extra = [c for c in out.columns if c not in df.columns and c != "probability"]
        return out.withColumn(into, vector_to_array("probability")[1]).drop("probability", *extra)

    @property
    def estimator(self):
        return self.model.stages[-1]

    def importance(self) -> list[tuple[str, float]]:
        """Tree importances, or absolute coefficients."""
        e = self.estimator
        v = e.featureImportances.toArray() if hasattr(e, "featureImportances") else np.abs(e.coefficients.toArray())
        return [(n, float(x)) for n, x in zip(self.names, v)]


def fit_pipeline(train: DataFrame, key: str, target: str, spec: PipelineSpec) -> FittedPipeline:
    """Every statistic, the reducer and the synthetic rows come from the training rows alone."""
    stages = []
    if spec.imputation:
        stages.append(DataImputer([dict(s) for s in spec.imputation]))
    if spec.model in LINEAR:
        if spec.standard:
            stages.append(StandardScalerTransformer([c for c in spec.standard if c in spec.features]))
        if spec.robust:
            stages.append(RobustScalerTransformer({"columns": [c for c in spec.robust if c in spec.features], "log_columns": list(spec.log_first)}))
    stages.append(VectorAssembler(inputCols=list(spec.features), outputCol="features", handleInvalid="error"))
    prepared = Pipeline(stages=stages).fit(train)
    rows = prepared.transform(train).select(key, "features", named(target).cast("double").alias(target))
    reducers, column, names = fit_reducer(rows, spec.reducer, "features", target, list(spec.features), key, spec.seed)
    if reducers:
        rows = PipelineModel(reducers).transform(rows)
    if spec.oversample:
        rows = smote(rows, key, column, target, spec.k_neighbours, spec.seed).withColumnRenamed("features", column)
    positive = {**DEFAULTS[spec.model], **spec.params}.get("scale_pos_weight")
    rows = rows.select(column, target)
    # Iterative fits read the rows many times.
    rows = rows.persist()
    try:
        n = rows.count()
        weighted = with_class_weight(rows, target, WEIGHT, positive)
        estimator = build_estimator(spec.model, spec.params, column, target, n, spec.seed)
        fitted = estimator.fit(fit_width(weighted))
    finally:
        rows.unpersist()
    return FittedPipeline(PipelineModel([*prepared.stages, *reducers, fitted]), names, spec)


def save_pipeline(fitted: FittedPipeline, path: str, target: str, threshold: float) -> None:
    """The fitted stages, and the scoring schema as one JSON row."""
    fitted.model.write().overwrite().save(f"{path}/pipeline")
    schema = {"feature_columns": list(fitted.spec.features), "target_column": target, "threshold": threshold, "n_features": len(fitted.spec.features)}
    spark = SparkSession.active()
    spark.createDataFrame([(json.dumps(schema),)], "schema string").coalesce(1).write.mode("overwrite").text(f"{path}/schema")


def load_pipeline(spark, path: str) -> tuple[PipelineModel, dict]:
    schema = json.loads(spark.read.text(f"{path}/schema").first()[0])
    return PipelineModel.load(f"{path}/pipeline"), schema


def score_with(model: PipelineModel, schema: dict, df: DataFrame) -> DataFrame:
    """Scores rows that have the model's columns; others are refused."""
    missing = [c for c in schema["feature_columns"] if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for scoring: {missing}")
    return model.transform(df).withColumn("p", vector_to_array("probability")[1])


def permutation_importance(
    fitted: FittedPipeline, df: DataFrame, key: str, target: str, rows: int = 2000, repeats: int = 5, seed: int = 42
) -> DataFrame:
    """(feature, importance, deviation): accuracy lost when a feature's values change rows.

    Runs on a sample of `rows`; all features and repeats are permuted and scored in one job.
    """
    cols = list(fitted.spec.features)
    sample = random_sample(df.select(key, target, *[named(c) for c in cols]), key, rows, seed)
    tries = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(r).alias("repeat")) for c in cols for r in range(repeats)]))
    spread = sample.select("*", tries.alias("_t")).select("*", "_t.feature", "_t.repeat").drop("_t")
    # Within one try: row number by key, and by hash; the value at the hashed place moves in.
    place = Window.partitionBy("feature", "repeat")
    numbered = spread.withColumns(
        {
            "_a": F.row_number().over(place.orderBy(key)),
            "_b": F.row_number().over(place.orderBy(F.xxhash64("feature", "repeat", key, F.lit(seed)), key)),
        }
    )
    value = F.lit(None).cast("double")
    for c in cols:
        value = F.when(F.col("feature") == c, named(c).cast("double")).otherwise(value)
    moved = numbered.select("feature", "repeat", F.col("_b").alias("_a"), value.alias("_v"))
    types = dict(df.dtypes)
    joined = numbered.join(moved, ["feature", "repeat", "_a"]).withColumns(
        {c: F.when(F.col("feature") == c, F.col("_v").cast(types[c])).otherwise(named(c)) for c in cols}
    )

    def accuracy():
        return F.avg(((F.col("p") >= 0.5).cast("int") == named(target).cast("int")).cast("double"))

    base = fitted.score(sample).agg(accuracy()).scalar()
    per_try = fitted.score(joined).groupBy("feature", "repeat").agg(accuracy().alias("acc"))
    means = per_try.groupBy("feature").agg(F.avg("acc").alias("acc"), F.stddev_pop("acc").alias("deviation"))
    return means.select("feature", (base - F.col("acc")).alias("importance"), "deviation")


def contributions(df: DataFrame, key: str, weights: dict[str, float], means: dict[str, float], top: int | None = None) -> DataFrame:
    """(key, feature, contribution): weight x (value - mean), the strongest `top` per row."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), (F.lit(float(w)) * (named(c) - F.lit(float(means[c])))).alias("contribution")) for c, w in weights.items()]
    )
    kept = F.filter(cells, lambda s: s["contribution"].isNotNull())
    if top is not None:
        # Sorted inside the row, no shuffle: strongest first, then by name.
        keyed = F.transform(kept, lambda s: F.struct((-F.abs(s["contribution"])).alias("k"), s["feature"].alias("feature"), s["contribution"].alias("contribution")))
        kept = F.slice(F.array_sort(keyed), 1, top)
    return df.select(key, F.explode(kept).alias("_s")).select(key, "_s.feature", "_s.contribution")

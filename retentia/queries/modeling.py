"""Resampling, reduction, clustering, training, importance, persistence."""

import uuid
from datetime import datetime, timezone

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from retentia.operators import clustering, knn, models, reduction, runs, smote
from retentia.operators.metrics import METRICS
from retentia.operators.stages import population_zscores
from retentia.plans import training as t
from retentia.plans.churn_base import CONTINUOUS, KEY, TARGET, churn_base, table
from retentia.plans.preprocessing import BASE_PLAN
from retentia.queries.profiling import rounded, union
from retentia.queries.registry import query
from retentia.session import scratch


def features(spark, sf):
    return BASE_PLAN.transform(churn_base(spark, sf))


def vectors(spark, sf, columns=CONTINUOUS):
    """Complete rows, z-scored with population deviations, as a vector."""
    rows = churn_base(spark, sf).select(KEY, TARGET, *[F.col(c).cast("double").alias(c) for c in columns]).na.drop()
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(population_zscores(rows, columns))


@query(
    "nearest_neighbours",
    """SELECT id, nn, "rank" FROM (SELECT a.vec_id AS id, b.vec_id AS nn, CAST(row_number() OVER (PARTITION BY a.vec_id
      ORDER BY list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), b.vec_id) AS INT) AS "rank"
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) WHERE "rank" <= 5""",
    on_base=False,
)
def _(spark, sf):
    points = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"))
    return knn.nearest(points, 5).select("id", "nn", "rank")


@query(
    "smote_balance",
    """x AS (SELECT * FROM churn_base WHERE CreditScore IS NOT NULL)
    SELECT 'before' AS phase, Exited AS class, count(*) AS n FROM x GROUP BY 2
    UNION ALL SELECT 'after', v.c, (SELECT max(n) FROM (SELECT count(*) AS n FROM x GROUP BY Exited)) FROM (VALUES (0), (1)) v(c)""",
)
def _(spark, sf):
    rows = vectors(spark, sf)
    after = smote.smote(rows, KEY, "features", TARGET)
    return smote.class_distribution(rows, TARGET, "before").unionByName(smote.class_distribution(after, TARGET, "after"))


@query("smote_rows")
def _(spark, sf):
    made = smote.smote(vectors(spark, sf), KEY, "features", TARGET).where("synthetic")
    return made.select(vector_to_array("features").alias("features"), TARGET)


# Two z-scored columns have component variances 1 + r and 1 - r.
@query(
    "pca_variance",
    """r AS (SELECT abs(corr(CreditScore, PointEarned)) AS r FROM churn_base WHERE CreditScore IS NOT NULL)
    SELECT 'pc_0' AS component, round((1 + r) / 2, 6) AS ratio FROM r UNION ALL SELECT 'pc_1', round((1 - r) / 2, 6) FROM r""",
)
def _(spark, sf):
    model = reduction.fit_pca(vectors(spark, sf, ["CreditScore", "PointEarned"]), "features", 2)
    ratio = model.stages[-1].explainedVariance.toArray()
    return rounded(spark.createDataFrame([(f"pc_{i}", float(x)) for i, x in enumerate(ratio)], "component string, ratio double"))


@query("pca_projection")
def _(spark, sf):
    rows = vectors(spark, sf)
    out = reduction.fit_pca(rows, "features", 3).transform(rows)
    return out.select(KEY, *[vector_to_array("reduced")[i].alias(f"pc_{i}") for i in range(3)])


@query(
    "covariance",
    union(
        f"SELECT '{a}' AS a, '{b}' AS b, round(covar_samp(za, zb), 6) AS cov FROM (SELECT ({a} - avg({a}) OVER ()) / stddev_pop({a}) OVER () AS za, "
        f"({b} - avg({b}) OVER ()) / stddev_pop({b}) OVER () AS zb FROM churn_base WHERE CreditScore IS NOT NULL)"
        for i, a in enumerate(CONTINUOUS)
        for b in CONTINUOUS[i:]
    ),
)
def _(spark, sf):
    """Covariance of the z-scored columns from the per-task moments the discriminant uses."""
    _, classes = reduction.class_moments(vectors(spark, sf).withColumn("one", F.lit(1)), "features", "one")
    n, s, o = classes[1.0]
    cov = (o - s[:, None] * s[None, :] / n) / (n - 1)
    rows = [(a, b, float(cov[i, j])) for i, a in enumerate(CONTINUOUS) for j, b in enumerate(CONTINUOUS) if j >= i]
    return rounded(spark.createDataFrame(rows, "a string, b string, cov double"))


# One direction over two columns separates the class means by their Mahalanobis distance.
@query(
    "lda_separation",
    """x AS (SELECT Exited, (CreditScore - avg(CreditScore) OVER ()) / stddev_pop(CreditScore) OVER () AS a,
      (Age - avg(Age) OVER ()) / stddev_pop(Age) OVER () AS b FROM churn_base WHERE CreditScore IS NOT NULL),
    m AS (SELECT Exited, avg(a) AS ma, avg(b) AS mb, count(*) AS n, var_samp(a) * (count(*) - 1) AS saa, var_samp(b) * (count(*) - 1) AS sbb,
      covar_samp(a, b) * (count(*) - 1) AS sab FROM x GROUP BY 1),
    w AS (SELECT sum(saa) / (sum(n) - 2) AS waa, sum(sbb) / (sum(n) - 2) AS wbb, sum(sab) / (sum(n) - 2) AS wab,
      max(ma) FILTER (Exited = 1) - max(ma) FILTER (Exited = 0) AS da, max(mb) FILTER (Exited = 1) - max(mb) FILTER (Exited = 0) AS db FROM m)
    SELECT round(sqrt((wbb * da * da - 2 * wab * da * db + waa * db * db) / (waa * wbb - wab * wab)), 6) AS separation FROM w""",
)
def _(spark, sf):
    rows = vectors(spark, sf, ["CreditScore", "Age"])
    out = reduction.fit_lda(rows, "features", TARGET, 1).transform(rows).withColumn("z", vector_to_array("reduced")[0])
    gap = out.agg((F.avg(F.when(F.col(TARGET) == 1, F.col("z"))) - F.avg(F.when(F.col(TARGET) == 0, F.col("z")))).alias("g"))
    return rounded(gap.select(F.abs("g").alias("separation")))


@query("lda_projection")
def _(spark, sf):
    rows = vectors(spark, sf)
    out = reduction.fit_lda(rows, "features", TARGET, 1).transform(rows)
    return out.select(KEY, TARGET, vector_to_array("reduced")[0].alias("lda_0"))


def kernel_query(kernel):
    @query(f"kernel_pca_{kernel}")
    def _(spark, sf):
        rows = vectors(spark, sf)
        out = reduction.fit_kpca(rows, "features", 3, kernel, key=KEY).transform(rows)
        return out.select(KEY, *[vector_to_array("reduced")[i].alias(f"kpc_{i}") for i in range(3)])


for kernel in ("rbf", "poly", "cosine"):
    kernel_query(kernel)


def rfe_query(estimator):
    @query(f"rfe_{estimator}")
    def _(spark, sf):
        _, kept = reduction.fit_rfe(vectors(spark, sf), "features", TARGET, 3, estimator)
        return spark.createDataFrame([(i, CONTINUOUS[i]) for i in kept], "position int, feature string")


for estimator in ("random_forest", "logistic_regression"):
    rfe_query(estimator)


@query("cluster_elbow")
def _(spark, sf):
    return clustering.segment(churn_base(spark, sf), CONTINUOUS, TARGET)[0]


@query("cluster_profile")
def _(spark, sf):
    return clustering.segment(churn_base(spark, sf), CONTINUOUS, TARGET)[2]


MODELS = ("logistic_regression", "random_forest", "boosting_depth", "boosting_leaf")


def model_query(model):
    @query(f"model_{model}")
    def _(spark, sf):
        return t.holdout_evaluation(features(spark, sf), KEY, TARGET, t.base_spec(model))[2]


for model in MODELS:
    model_query(model)


@query("pipeline_with_smote")
def _(spark, sf):
    return t.holdout_evaluation(features(spark, sf), KEY, TARGET, t.base_spec("logistic_regression"))[2]


@query("cross_validation")
def _(spark, sf):
    return t.cross_validate(features(spark, sf), KEY, TARGET, t.base_spec("logistic_regression"))


@query("search_trials")
def _(spark, sf):
    return t.search(features(spark, sf), KEY, TARGET, t.base_spec("logistic_regression"))[0]


@query("reducer_comparison")
def _(spark, sf):
    reducers = [{"method": "none"}, {"method": "pca", "n_components": 18}, {"method": "lda", "n_components": 1}]
    return t.compare_reducers(features(spark, sf), KEY, TARGET, t.base_spec("logistic_regression"), reducers)


def fitted(spark, sf, model="random_forest"):
    return t.fit_pipeline(features(spark, sf), KEY, TARGET, t.base_spec(model))


@query("feature_importance")
def _(spark, sf):
    return spark.createDataFrame(fitted(spark, sf).importance(), "feature string, importance double")


@query("coefficient_importance")
def _(spark, sf):
    return spark.createDataFrame(fitted(spark, sf, "logistic_regression").importance(), "feature string, importance double")


@query("permutation_importance")
def _(spark, sf):
    return models.permutation_importance(fitted(spark, sf), features(spark, sf), KEY, TARGET)


EXPLAINED = ["CreditScore", "Age", "Balance", "Tenure"]


@query(
    "linear_contributions",
    "w AS ("
    + union(f"SELECT '{c}' AS feature, round(corr({c}, Exited), 6) AS w, round(avg({c}), 4) AS m FROM churn_base" for c in EXPLAINED)
    + "), v AS ("
    + union(f"SELECT CustomerId, '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM churn_base WHERE {c} IS NOT NULL" for c in EXPLAINED)
    + """), s AS (SELECT CustomerId, feature, w * (x - m) AS contribution FROM v JOIN w USING (feature))
    SELECT CustomerId, feature, round(contribution, 4) AS contribution FROM
      (SELECT *, row_number() OVER (PARTITION BY CustomerId ORDER BY abs(contribution) DESC, feature) AS k FROM s) WHERE k <= 2""",
)
def _(spark, sf):
    b = churn_base(spark, sf)
    row = b.agg(*[F.round(F.corr(c, TARGET), 6).alias(f"w_{c}") for c in EXPLAINED], *[F.round(F.avg(c), 4).alias(f"m_{c}") for c in EXPLAINED]).first()
    out = models.contributions(b, KEY, {c: row[f"w_{c}"] for c in EXPLAINED}, {c: row[f"m_{c}"] for c in EXPLAINED}, top=2)
    return rounded(out, 4)


@query("pipeline_round_trip", "SELECT count(*) AS n, count(*) AS same FROM churn_base")
def _(spark, sf):
    """Scores of a saved and reloaded pipeline equal those of the fitted one."""
    rows = features(spark, sf)
    one = fitted(spark, sf, "logistic_regression")
    path = scratch(spark, "model")
    models.save_pipeline(one, path, TARGET, t.TUNED_THRESHOLD)
    loaded, schema = models.load_pipeline(spark, path)
    a = one.score(rows).select(KEY, "p")
    b = models.score_with(loaded, schema, rows).select(KEY, F.col("p").alias("q"))
    return a.join(b, KEY).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs(F.col("p") - F.col("q")) < 1e-12).alias("same"))


@query("run_log", union(f"SELECT 'holdout' AS stage, '{m}' AS metric, 1 AS step" for m in METRICS), on_base=False)
def _(spark, sf):
    root = scratch(spark, "runs")
    spec = t.base_spec("logistic_regression")
    metrics = t.holdout_evaluation(features(spark, sf), KEY, TARGET, spec)[2].first()
    run = {
        "run_uuid": uuid.uuid4().hex, "experiment": "churn", "name": "deploy_final_model", "stage": "holdout",
        "start_time": datetime.now(timezone.utc), "params": {"model": spec.model},
    }
    runs.log_run(spark, root, run, {m: metrics[m] for m in METRICS}, step=1)
    logged, values = runs.read_runs(spark, root)
    return logged.join(values, "run_uuid").select("stage", "metric", "step")

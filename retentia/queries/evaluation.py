"""Metrics, curves, thresholds, scoring, run tables. Scores are a fixed rule of the customer id."""

from pyspark.sql import functions as F

from retentia.functions.expr import AUC_DROP_ALERT, RECALL_DROP_ALERT
from retentia.operators import drift as d
from retentia.operators import metrics as m
from retentia.operators import runs as r
from retentia.operators.models import PipelineSpec, fit_pipeline, save_pipeline
from retentia.plans.churn_base import KEY, NUMERIC, TARGET, churn_base
from retentia.plans.scoring import Predictor
from retentia.queries.profiling import rounded, union
from retentia.queries.registry import query
from retentia.queries.statistics import KS_SQL, STATUS, ks_p_sql, psi_sql
from retentia.session import scratch

SCORED_SQL = """scored AS (SELECT *, round(((CustomerId * 7919) % 10007) / 10007.0, 2) AS p FROM churn_base)"""


def scored(spark, sf):
    p = F.round(((F.col(KEY) * 7919) % 10007) / 10007.0, 2)
    return churn_base(spark, sf).withColumn("p", p)


def metrics_sql(src, by=(), threshold=0.4):
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    keys = "".join(f"{b}, " for b in by)
    return f"""SELECT {keys}(sum(rk) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))) AS roc_auc,
      coalesce(2.0 * tp_ / nullif(2 * tp_ + fp_ + fn_, 0), 0) AS f1, coalesce(tp_ / nullif(tp_ + fn_, 0), 0) AS recall,
      coalesce(tp_ / nullif(tp_ + fp_, 0), 0) AS precision, sum(prec) FILTER (y = 1) / sum(y) AS avg_precision,
      tp_ AS tp, fp_ AS fp, fn_ AS fn, count(*) FILTER (p < {threshold} AND y = 0) AS tn
    FROM (SELECT *, rank() OVER ({part} ORDER BY p) + (count(*) OVER (PARTITION BY {keys}p) - 1) / 2.0 AS rk,
        sum(y) OVER ({part} ORDER BY p DESC) / count(*) OVER ({part} ORDER BY p DESC) AS prec,
        count(*) FILTER (p >= {threshold} AND y = 1) OVER ({part}) AS tp_, count(*) FILTER (p >= {threshold} AND y = 0) OVER ({part}) AS fp_,
        count(*) FILTER (p < {threshold} AND y = 1) OVER ({part}) AS fn_
      FROM {src}) GROUP BY {keys}tp_, fp_, fn_"""


def five(prefix=""):
    return ", ".join(f"round({prefix}{x}, 6) AS {x}" for x in m.METRICS)


@query(
    "classification_metrics",
    SCORED_SQL + f", x AS ({metrics_sql('(SELECT p, Exited AS y FROM scored)')}) SELECT {five()}, tp, fp, fn, tn FROM x",
)
def _(spark, sf):
    return rounded(m.classification_metrics(scored(spark, sf), TARGET, "p", 0.4))


@query(
    "roc_auc",
    SCORED_SQL + f", x AS ({metrics_sql('(SELECT p, Exited AS y FROM scored)')}) SELECT round(roc_auc, 6) AS roc_auc, round(avg_precision, 6) AS avg_precision FROM x",
)
def _(spark, sf):
    return rounded(m.ranking_metrics(scored(spark, sf), TARGET, "p"))


@query(
    "metrics_undefined",
    SCORED_SQL + """ SELECT count(*) FILTER (p >= 2 AND Exited = 1) AS tp, count(*) FILTER (p >= 2 AND Exited = 0) AS fp,
    count(*) FILTER (p < 2 AND Exited = 1) AS fn, count(*) FILTER (p < 2 AND Exited = 0) AS tn, 0.0::DOUBLE AS precision, 0.0::DOUBLE AS recall, 0.0::DOUBLE AS f1 FROM scored""",
)
def _(spark, sf):
    return m.confusion(scored(spark, sf), TARGET, "p", 2.0).withColumns(m.rates())


@query(
    "confusion_matrix",
    SCORED_SQL + """ SELECT a.v AS actual, b.v AS predicted, count(s.p) AS n FROM (VALUES (0), (1)) a(v) CROSS JOIN (VALUES (0), (1)) b(v)
    LEFT JOIN scored s ON s.Exited = a.v AND CAST(s.p >= 0.4 AS INT) = b.v GROUP BY 1, 2""",
)
def _(spark, sf):
    return m.confusion_matrix(scored(spark, sf), TARGET, "p", 0.4)


@query(
    "roc_curve",
    SCORED_SQL + """ SELECT p AS threshold, round(sum(sum(1 - Exited)) OVER (ORDER BY p DESC) / sum(sum(1 - Exited)) OVER (), 6) AS fpr,
    round(sum(sum(Exited)) OVER (ORDER BY p DESC) / sum(sum(Exited)) OVER (), 6) AS tpr FROM scored GROUP BY p
    UNION ALL SELECT NULL, 0.0, 0.0""",
)
def _(spark, sf):
    return rounded(m.roc_curve(scored(spark, sf), TARGET, "p"))


@query(
    "precision_recall_curve",
    SCORED_SQL + """ SELECT p AS threshold, round(sum(sum(Exited)) OVER (ORDER BY p DESC) / sum(count(*)) OVER (ORDER BY p DESC), 6) AS precision,
    round(sum(sum(Exited)) OVER (ORDER BY p DESC) / sum(sum(Exited)) OVER (), 6) AS recall FROM scored GROUP BY p
    UNION ALL SELECT NULL, 1.0, 0.0""",
)
def _(spark, sf):
    return rounded(m.precision_recall_curve(scored(spark, sf), TARGET, "p"))


T_LIST = ", ".join(f"({t!r}::DOUBLE)" for t in m.THRESHOLDS)
SWEEP_SQL = SCORED_SQL + f""", sweep AS (SELECT t.v AS threshold, count(*) FILTER (p >= t.v AND Exited = 1) AS tp, count(*) FILTER (p >= t.v AND Exited = 0) AS fp,
  count(*) FILTER (p < t.v AND Exited = 1) AS fn, count(*) FILTER (p < t.v AND Exited = 0) AS tn
  FROM scored, (VALUES {T_LIST}) t(v) GROUP BY 1)"""


@query(
    "threshold_sweep",
    SWEEP_SQL + """ SELECT *, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
    round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM sweep""",
)
def _(spark, sf):
    s = m.threshold_sweep(scored(spark, sf), TARGET, "p")
    return s.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query("profit_curve", SWEEP_SQL + " SELECT threshold, fn, fp, CAST(-(fn * 500 + fp * 20) AS DOUBLE) AS profit FROM sweep")
def _(spark, sf):
    return m.profit_curve(m.threshold_sweep(scored(spark, sf), TARGET, "p"))


@query(
    "best_threshold",
    SWEEP_SQL + " SELECT threshold, fn, fp, CAST(-(fn * 500 + fp * 20) AS DOUBLE) AS profit FROM sweep ORDER BY profit DESC, threshold LIMIT 1",
)
def _(spark, sf):
    return m.best_threshold(m.profit_curve(m.threshold_sweep(scored(spark, sf), TARGET, "p")))


@query(
    "campaign_roi",
    SCORED_SQL + """ SELECT count(*) AS n_customers, count(*) FILTER (Exited = 1) AS n_churners, count(*) FILTER (p >= 0.4 AND Exited = 1) AS n_detected,
    count(*) FILTER (p >= 0.4 AND Exited = 0) AS n_false_positives, round(count(*) FILTER (p >= 0.4 AND Exited = 1) * 0.3 * 500, 4)::DOUBLE AS preserved_revenue,
    CAST(count(*) FILTER (p >= 0.4) * 40 AS DOUBLE) AS campaign_cost,
    round((count(*) FILTER (p >= 0.4 AND Exited = 1) * 150.0 - count(*) FILTER (p >= 0.4) * 40) / greatest(count(*) FILTER (p >= 0.4) * 40, 1), 6)::DOUBLE AS roi FROM scored""",
)
def _(spark, sf):
    return rounded(m.campaign_roi(scored(spark, sf), TARGET, "p", 0.4), 6, preserved_revenue=4)


RAW_P = "((CustomerId * 7919) % 10007) / 10007.0"
SCORE_SQL = f"""out AS (SELECT CustomerId, Geography, Age, IsActiveMember, round_even({RAW_P}, 4) AS churn_probability, CAST({RAW_P} >= 0.4 AS INT) AS churn_flag,
  CASE WHEN {RAW_P} <= 0.30 THEN 'low' WHEN {RAW_P} <= 0.55 THEN 'medium' ELSE 'high' END AS risk_level FROM churn_base)"""


def raw_scores(spark, sf):
    return churn_base(spark, sf).withColumn("p", ((F.col(KEY) * 7919) % 10007) / 10007.0)


# A logistic model of two flags and their product has a coefficient per combination of flags, so its fitted
# probability is the class-weighted churn rate of the combination, which SQL finds without any fit.
MODEL_FLAGS = ("IsActiveMember", "CardHeld", "ActiveCard")
MODEL_SQL = """flagged AS (SELECT *, coalesce(HasCrCard, 0) AS CardHeld FROM churn_base),
c AS (SELECT count(*) FILTER (Exited = 1) AS c1, count(*) FILTER (Exited = 0) AS c0 FROM churn_base),
g AS (SELECT IsActiveMember, CardHeld, count(*) FILTER (Exited = 1) / any_value(c1) AS w1, count(*) FILTER (Exited = 0) / any_value(c0) AS w0
  FROM flagged, c GROUP BY 1, 2),
out AS (SELECT flagged.*, w1 / (w1 + w0) AS p FROM flagged JOIN g USING (IsActiveMember, CardHeld))"""
PREDICTED_SQL = """round_even(p, 4) AS churn_probability, CAST(p >= {at} AS INT) AS churn_flag,
  CASE WHEN p <= 0.30 THEN 'low' WHEN p <= 0.55 THEN 'medium' ELSE 'high' END AS risk_level"""


def with_flags(df):
    held = F.coalesce("HasCrCard", F.lit(0))
    return df.withColumns({"CardHeld": held, "ActiveCard": F.col("IsActiveMember") * held})


def saved_predictor(spark, sf):
    """Fit on the whole snapshot, save, and load again as a predictor."""
    rows = with_flags(churn_base(spark, sf))
    spec = PipelineSpec("logistic_regression", MODEL_FLAGS, {"C": 1e9, "tol": 1e-13}, oversample=False)
    path = f"{scratch(spark, 'model')}/churn_model"
    save_pipeline(fit_pipeline(rows, KEY, TARGET, spec), path, TARGET, 0.45)
    return Predictor(spark, path)


@query("score_batch", MODEL_SQL + f" SELECT CustomerId, {PREDICTED_SQL.format(at=0.45)} FROM out")
def _(spark, sf):
    return saved_predictor(spark, sf).predict(with_flags(churn_base(spark, sf)), keep=(KEY,))


@query("score_response", MODEL_SQL + f" SELECT CustomerId, {PREDICTED_SQL.format(at=0.5)}, 0.5::DOUBLE AS threshold_used, 'saved:churn_model' AS model_source FROM out")
def _(spark, sf):
    model = saved_predictor(spark, sf)
    out = model.predict(with_flags(churn_base(spark, sf)), 0.5, (KEY,))
    return out.withColumns({"threshold_used": F.lit(0.5), "model_source": F.lit(model.source)})


@query(
    "score_summary",
    SCORE_SQL + """ SELECT count(*) AS n_customers, CAST(sum(churn_flag) AS BIGINT) AS n_churn_flag,
    CAST(sum(churn_flag) AS VARCHAR) || ' / ' || CAST(count(*) AS VARCHAR) AS at_risk FROM out""",
)
def _(spark, sf):
    return m.batch_summary(m.score_rows(raw_scores(spark, sf), "p"))


@query(
    "score_display",
    SCORE_SQL + """ SELECT CustomerId, Geography, CASE WHEN IsActiveMember = 1 THEN '✓' ELSE '✗' END AS Active,
    printf('%.2f%%', churn_probability * 100) AS "Churn Prob.", upper(risk_level[1]) || risk_level[2:] AS Risk,
    CASE WHEN churn_flag = 1 THEN '⚠ Churn' ELSE '✓ Retained' END AS Flag FROM out""",
)
def _(spark, sf):
    return m.display_rows(m.score_rows(raw_scores(spark, sf), "p"), [KEY, "Geography"], "IsActiveMember")


BATCH = "(SELECT p, Exited AS y, CASE WHEN CustomerId % 2 = 1 THEN 'ref' ELSE 'prod' END AS batch FROM scored)"
DROPS_SQL = SCORED_SQL + f""", x AS ({metrics_sql(BATCH, ['batch'])}),
drops AS (SELECT a.roc_auc AS ref_roc_auc, a.recall AS ref_recall, a.f1 AS ref_f1, b.roc_auc AS prod_roc_auc, b.recall AS prod_recall, b.f1 AS prod_f1,
  b.precision AS prod_precision, a.roc_auc - b.roc_auc AS auc_drop, a.recall - b.recall AS recall_drop
  FROM x a JOIN x b ON a.batch = 'ref' AND b.batch = 'prod')"""


def batches(spark, sf):
    return scored(spark, sf).withColumn("batch", F.when(F.col(KEY) % 2 == 1, "ref").otherwise("prod"))


def drops(spark, sf):
    return m.batch_drops(batches(spark, sf), TARGET, "p", 0.4, "batch", "ref", "prod")


@query(
    "batch_metric_drops",
    DROPS_SQL + " SELECT " + ", ".join(
        f"round({c}, 6) AS {c}"
        for c in ("ref_roc_auc", "ref_recall", "ref_f1", "prod_roc_auc", "prod_recall", "prod_f1", "prod_precision", "auc_drop", "recall_drop")
    ) + " FROM drops",
)
def _(spark, sf):
    return rounded(drops(spark, sf))


@query(
    "drift_alerts",
    DROPS_SQL + ", " + psi_sql("scored", "p", "(CustomerId % 2)") + f""", y AS (SELECT sum((a - e) * ln(a / e)) AS psi FROM shares)
    SELECT round(psi, 6) AS psi, {STATUS}, auc_drop > 0.03 AS auc_alert, recall_drop > 0.05 AS recall_alert FROM y, drops""",
)
def _(spark, sf):
    index = d.psi(scored(spark, sf), "p", F.col(KEY) % 2 == 1)
    losses = drops(spark, sf).select(F.struct("auc_drop", "recall_drop")).scalar()
    return rounded(
        index.withColumns(
            {"auc_alert": losses["auc_drop"] > AUC_DROP_ALERT, "recall_alert": losses["recall_drop"] > RECALL_DROP_ALERT}
        )
    )


KS_ALL = union(
    KS_SQL.format(c=c, ref="CustomerId % 2", src="churn_base").replace("round(max(abs(ca / na - cb / nb)), 6)", "max(abs(ca / na - cb / nb))")
    for c in NUMERIC
)
SUMMARY_SQL = DROPS_SQL + ", " + psi_sql("scored", "p", "(CustomerId % 2)") + f""", k AS ({KS_ALL}),
summary AS (SELECT (SELECT CAST(count(*) FILTER (CAST({ks_p_sql('n_reference', 'n_production', 'ks_stat')} AS DOUBLE) < 0.05) AS INT) FROM k) AS n_features_drifted,
  (SELECT sum((a - e) * ln(a / e)) FROM shares) AS psi_score, auc_drop, recall_drop FROM drops),
flagged AS (SELECT *, CAST(n_features_drifted > 0 AS INT) AS data_drift_detected, CAST(auc_drop > 0.03 OR recall_drop > 0.05 AS INT) AS model_drift_detected FROM summary)
SELECT n_features_drifted, round(psi_score, 6) AS psi_score, round(auc_drop, 6) AS auc_drop, round(recall_drop, 6) AS recall_drop,
  data_drift_detected, model_drift_detected"""


def monitoring_summary(spark, sf):
    ks = d.with_drift_flag(d.ks_two_sample(churn_base(spark, sf), NUMERIC, F.col(KEY) % 2))
    return d.drift_summary(ks, d.psi(scored(spark, sf), "p", F.col(KEY) % 2 == 1), drops(spark, sf))


@query("drift_summary", SUMMARY_SQL + " FROM flagged")
def _(spark, sf):
    return rounded(monitoring_summary(spark, sf))


@query(
    "retraining_trigger",
    SUMMARY_SQL + """, concat_ws(',', CASE WHEN n_features_drifted >= 3 THEN 'features' END, CASE WHEN psi_score > 0.20 THEN 'psi' END,
    CASE WHEN model_drift_detected = 1 THEN 'metrics' END) AS reasons, n_features_drifted >= 3 OR psi_score > 0.20 OR model_drift_detected = 1 AS retrain FROM flagged""",
)
def _(spark, sf):
    return rounded(d.retraining_trigger(monitoring_summary(spark, sf)))


# Three score rules stand for three models; folds are the customer id modulo 5.
MODELS_SQL = """models AS (SELECT *, 'rule_a' AS model, round(((CustomerId * 7919) % 10007) / 10007.0, 2) AS p FROM churn_base
  UNION ALL SELECT *, 'rule_b', round(((CustomerId * 104729) % 10007) / 10007.0, 2) FROM churn_base
  UNION ALL SELECT *, 'rule_c', floor(least(coalesce(Age, 0), 1000) / 10.0) / 100.0 FROM churn_base),
folds AS ({folds})""".format(folds=metrics_sql("(SELECT model, CAST(CustomerId % 5 AS INT) AS fold, p, Exited AS y FROM models)", ["model", "fold"]))


def models(spark, sf):
    rules = {
        "rule_a": ((F.col(KEY) * 7919) % 10007) / 10007.0,
        "rule_b": ((F.col(KEY) * 104729) % 10007) / 10007.0,
        "rule_c": F.floor(F.least(F.coalesce("Age", F.lit(0)), F.lit(1000)) / 10.0) / 100.0,
    }
    cells = F.array(*[F.struct(F.lit(n).alias("model"), F.round(p, 2).alias("p")) for n, p in rules.items()])
    return churn_base(spark, sf).select("*", F.inline(cells))


def fold_metrics(spark, sf):
    folds = models(spark, sf).withColumn("fold", (F.col(KEY) % 5).cast("int"))
    return m.classification_metrics(folds, TARGET, "p", 0.4, ["model", "fold"])


@query("fold_metrics", MODELS_SQL + f" SELECT model, fold, {five()} FROM folds")
def _(spark, sf):
    return rounded(fold_metrics(spark, sf).select("model", "fold", *m.METRICS))


CV = [(x, f"cv_{x}_{s}", f) for x in m.METRICS for s, f in (("mean", "avg"), ("std", "stddev_samp"))]
CV_SQL = MODELS_SQL + ", cv AS (SELECT model, " + ", ".join(f"round({f}({x}), 6) AS {n}" for x, n, f in CV) + " FROM folds GROUP BY model)"


def cv_summary(spark, sf):
    return rounded(r.fold_summary(fold_metrics(spark, sf), m.METRICS))


@query("fold_summary", CV_SQL + " SELECT * FROM cv")
def _(spark, sf):
    return cv_summary(spark, sf)


@query("leaderboard", CV_SQL + " SELECT model, cv_roc_auc_mean, cv_f1_mean, cv_recall_mean FROM cv ORDER BY 2 DESC")
def _(spark, sf):
    return r.leaderboard(cv_summary(spark, sf), "cv_roc_auc_mean").select("model", "cv_roc_auc_mean", "cv_f1_mean", "cv_recall_mean")


@query("best_model", CV_SQL + " SELECT model, cv_roc_auc_mean FROM cv ORDER BY cv_roc_auc_mean DESC, model DESC LIMIT 1")
def _(spark, sf):
    return r.best_model(cv_summary(spark, sf), "cv_roc_auc_mean")


@query(
    "cv_against_holdout",
    CV_SQL + f""", h AS ({metrics_sql("(SELECT p, Exited AS y FROM models WHERE model = 'rule_a')")}),
    a AS (UNPIVOT (SELECT {", ".join(f"cv_{x}_mean AS {x}" for x in m.METRICS)} FROM cv WHERE model = 'rule_a') ON COLUMNS(*) INTO NAME metric VALUE cv_mean),
    b AS (UNPIVOT (SELECT {five()} FROM h) ON COLUMNS(*) INTO NAME metric VALUE holdout)
    SELECT metric, cv_mean, holdout, round(holdout - cv_mean, 6) AS gap FROM a JOIN b USING (metric)""",
)
def _(spark, sf):
    cv = cv_summary(spark, sf).where("model = 'rule_a'").select(*[F.col(f"cv_{x}_mean").alias(x) for x in m.METRICS])
    holdout = rounded(m.classification_metrics(models(spark, sf).where("model = 'rule_a'"), TARGET, "p", 0.4))
    return rounded(r.cv_against_holdout(m.long_metrics(cv), m.long_metrics(holdout)))


# A run per region, rule and segment; its clock is the newest customer in it.
RUNS_SQL = MODELS_SQL + """, runs AS (SELECT Geography || '-' || model || '-' || CardType AS run_uuid, dense_rank() OVER (ORDER BY Geography) AS experiment_id,
  model AS name, max(CustomerId) AS start_time FROM models GROUP BY Geography, model, CardType),
experiments AS (SELECT DISTINCT Geography AS experiment_name, dense_rank() OVER (ORDER BY Geography) AS experiment_id FROM churn_base),
run_metrics AS ({rm})""".format(rm=metrics_sql("(SELECT Geography || '-' || model || '-' || CardType AS run_uuid, p, Exited AS y FROM models)", ["run_uuid"]))


def run_tables(spark, sf):
    x = models(spark, sf).withColumn("run_uuid", F.concat_ws("-", "Geography", "model", "CardType"))
    grouped = x.groupBy("run_uuid", "Geography", F.col("model").alias("name")).agg(F.max(KEY).alias("start_time"))
    runs = grouped.withColumnRenamed("Geography", "experiment_id")
    experiments = x.select(F.col("Geography").alias("experiment_id"), F.col("Geography").alias("experiment_name")).distinct()
    return runs, experiments, m.classification_metrics(x, TARGET, "p", 0.4, ["run_uuid"])


@query(
    "latest_run",
    RUNS_SQL + """ SELECT run_uuid, name, start_time FROM runs JOIN experiments USING (experiment_id)
    WHERE experiment_name = 'EUROPE' AND name = 'rule_b' ORDER BY start_time DESC LIMIT 1""",
)
def _(spark, sf):
    runs, experiments, _ = run_tables(spark, sf)
    return r.latest_run(runs, experiments, "EUROPE", "rule_b").select("run_uuid", "name", "start_time")


@query(
    "run_metrics",
    RUNS_SQL + """, l AS (SELECT run_uuid FROM runs JOIN experiments USING (experiment_id)
    WHERE experiment_name = 'EUROPE' AND name = 'rule_b' ORDER BY start_time DESC LIMIT 1)
    SELECT run_uuid, round(roc_auc, 6) AS roc_auc, round(recall, 6) AS recall FROM run_metrics JOIN l USING (run_uuid)""",
)
def _(spark, sf):
    runs, experiments, wide = run_tables(spark, sf)
    latest = r.latest_run(runs, experiments, "EUROPE", "rule_b")
    found = r.metrics_of(m.long_metrics(wide, ["run_uuid"]), latest)
    return rounded(found.select("run_uuid", F.col("metrics")["roc_auc"].alias("roc_auc"), F.col("metrics")["recall"].alias("recall")))


@query(
    "promotion_gate",
    RUNS_SQL + """ SELECT run_uuid, CASE WHEN roc_auc >= 0.85 AND recall >= 0.70 THEN 'Production' ELSE 'Staging' END AS stage FROM run_metrics""",
)
def _(spark, sf):
    return run_tables(spark, sf)[2].select("run_uuid", r.promotion(F.col("roc_auc"), F.col("recall")).alias("stage"))


@query("top_models_per_experiment", RUNS_SQL + """ SELECT experiment_name, name, run_uuid, round(roc_auc, 6) AS roc_auc FROM
    (SELECT *, row_number() OVER (PARTITION BY experiment_name, name ORDER BY roc_auc DESC, run_uuid) AS k FROM runs JOIN experiments USING (experiment_id) JOIN run_metrics USING (run_uuid) WHERE isfinite(roc_auc)) WHERE k = 1""")
def _(spark, sf):
    runs, experiments, wide = run_tables(spark, sf)
    both = runs.join(experiments, "experiment_id").join(wide.where("roc_auc IS NOT NULL"), "run_uuid")
    best = both.groupBy("experiment_name", "name").agg(F.min_by(F.struct("run_uuid", "roc_auc"), F.struct(-F.col("roc_auc"), F.col("run_uuid"))).alias("b"))
    return rounded(best.select("experiment_name", "name", "b.run_uuid", "b.roc_auc"))

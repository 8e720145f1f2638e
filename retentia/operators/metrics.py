"""Evaluation of scored rows (0/1 label, probability) and business figures.

Threshold-free metrics read ranks of distinct scores, so no curve is collected or sorted whole.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retentia.functions.expr import named, risk_level
from retentia.operators.ranks import average_rank, frequencies, ranked


def _scores(df: DataFrame, y: str, p: str, by: Sequence[str]) -> DataFrame:
    rows = df.select(*by, F.lit("score").alias("feature"), named(p).cast("double").alias("value"), named(y).cast("long").alias("_y"))
    freq = frequencies(rows.where("value is not null and _y is not null"), by, {"n": F.lit(1), "pos": F.col("_y")})
    return ranked(freq, ["feature", *by], weights=["n", "pos"])


def _safe(num, den) -> Column:
    """A ratio that is 0 when its denominator is."""
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def confusion(df: DataFrame, y: str, p: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn (and n) at a threshold, one pass."""
    hit, pos = named(p) >= threshold, named(y) == 1
    return df.groupBy(*by).agg(
        F.count_if(hit & pos).alias("tp"), F.count_if(hit & ~pos).alias("fp"),
        F.count_if(~hit & pos).alias("fn"), F.count_if(~hit & ~pos).alias("tn"),
    )


def rates() -> dict[str, Column]:
    """precision, recall and F1 columns over tp, fp, fn; 0 where undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return {"precision": _safe(tp, tp + fp), "recall": _safe(tp, tp + fn), "f1": _safe(2 * tp, 2 * tp + fp + fn)}


def ranking_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Tie-aware area under the ROC curve and step-wise average precision."""
    r = _scores(df, y, p, by)
    above = F.col("pos_total") - F.col("pos_before")
    taken = F.col("n_total") - F.col("n_before")
    s = r.groupBy(*by).agg(
        F.max("n_total").cast("double").alias("n"), F.max("pos_total").cast("double").alias("n1"),
        F.sum(F.col("pos") * average_rank()).alias("rs"), F.sum(F.col("pos") * above / taken).alias("ap"),
    )
    n1 = F.col("n1")
    return s.select(
        *by,
        F.try_divide(F.col("rs") - n1 * (n1 + 1) / 2, n1 * (F.col("n") - n1)).alias("roc_auc"),
        F.try_divide("ap", n1).alias("avg_precision"),
    )


METRICS = ["roc_auc", "f1", "recall", "precision", "avg_precision"]


def classification_metrics(df: DataFrame, y: str, p: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """The five metrics per group (or one row)."""
    at = confusion(df, y, p, threshold, by).withColumns(rates())
    free = ranking_metrics(df, y, p, by)
    if by:
        joined = at.join(free, list(by))
    else:
        both = free.select(F.struct("roc_auc", "avg_precision")).scalar()
        joined = at.withColumn("_f", both).select("*", "_f.*").drop("_f")
    return joined.select(*by, *METRICS, "tp", "fp", "fn", "tn")


def confusion_matrix(df: DataFrame, y: str, p: str, threshold: float) -> DataFrame:
    """(actual, predicted, n), all four cells present."""
    cells = [("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1)]
    rows = F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(c).alias("n")) for c, a, b in cells])
    return confusion(df, y, p, threshold).select(F.inline(rows))


def roc_curve(df: DataFrame, y: str, p: str) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score; the origin has no threshold."""
    r = _scores(df, y, p, [])
    pos, neg = F.col("pos_total"), F.col("n_total") - F.col("pos_total")
    tp = pos - F.col("pos_before")
    fp = F.col("n_total") - F.col("n_before") - tp
    points = r.select(F.col("value").alias("threshold"), F.try_divide(fp, neg).alias("fpr"), F.try_divide(tp, pos).alias("tpr"))
    origin = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(origin)


def precision_recall_curve(df: DataFrame, y: str, p: str) -> DataFrame:
    """(threshold, precision, recall) at every distinct score; closes at precision 1, recall 0."""
    r = _scores(df, y, p, [])
    tp = F.col("pos_total") - F.col("pos_before")
    points = r.select(
        F.col("value").alias("threshold"),
        (tp / (F.col("n_total") - F.col("n_before"))).alias("precision"),
        F.try_divide(tp, "pos_total").alias("recall"),
    )
    end = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.unionByName(end)


# The swept thresholds.
THRESHOLDS = [float(t) for t in np.linspace(0.1, 0.9, 81)]


def threshold_sweep(df: DataFrame, y: str, p: str, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Confusion counts and rates at evenly spaced thresholds.

    Each row is counted once, at the highest threshold it passes; the sweep is a running sum over
    the thresholds, not a pass per threshold.
    """
    t = F.array(*[F.lit(x) for x in thresholds])
    step = (thresholds[-1] - thresholds[0]) / (len(thresholds) - 1)
    x = named(p)
    guess = F.least(F.greatest(F.floor((x - thresholds[0]) / step), F.lit(-1)), F.lit(len(thresholds) - 1)).cast("int")
    passed = (
        F.when(F.get(t, F.col("_i") + 1) <= x, F.col("_i") + 1)
        .when((F.col("_i") >= 0) & (F.get(t, F.greatest(F.col("_i"), F.lit(0))) > x), F.col("_i") - 1)
        .otherwise(F.col("_i"))
    )
    counts = (
        df.where(x.isNotNull()).withColumn("_i", guess).groupBy(passed.alias("i"))
        .agg(F.count_if(named(y) == 1).alias("pos"), F.count_if(named(y) == 0).alias("neg"))
    )
    rows = [F.struct(F.lit(i).alias("i"), F.lit(v).alias("threshold")) for i, v in [(-1, None), *enumerate(thresholds)]]
    grid = df.sparkSession.range(1).select(F.inline(F.array(*rows)))
    # A table of len(thresholds) + 1 rows from here on.
    down = Window.orderBy(F.col("i").desc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = grid.join(counts, "i", "left").na.fill(0, ["pos", "neg"])
    swept = full.select(
        "i", "threshold", F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"),
        F.sum("pos").over(whole).alias("_pos"), F.sum("neg").over(whole).alias("_neg"),
    ).where("i >= 0")
    return swept.select(
        "threshold", "tp", "fp", (F.col("_pos") - F.col("tp")).alias("fn"), (F.col("_neg") - F.col("fp")).alias("tn")
    ).withColumns(rates())


# Costs in euro and the retention success rate.
MISSED_COST = 500
CONTACT_COST = 20
REVENUE_PER_CUSTOMER = 500
CAMPAIGN_COST = 40
RETENTION_SUCCESS = 0.30


def profit_curve(sweep: DataFrame) -> DataFrame:
    return sweep.select("threshold", "fn", "fp", (-(F.col("fn") * MISSED_COST + F.col("fp") * CONTACT_COST)).cast("double").alias("profit"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """The most profitable threshold, the lowest on ties."""
    return curve.orderBy(F.col("profit").desc(), "threshold").limit(1)


def campaign_roi(df: DataFrame, y: str, p: str, threshold: float) -> DataFrame:
    """Customers, churners found and what a retention campaign would cost and keep."""
    preserved = F.col("tp") * RETENTION_SUCCESS * REVENUE_PER_CUSTOMER
    cost = ((F.col("tp") + F.col("fp")) * CAMPAIGN_COST).cast("double")
    c = confusion(df, y, p, threshold)
    return c.select(
        (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n_customers"),
        (F.col("tp") + F.col("fn")).alias("n_churners"), F.col("tp").alias("n_detected"), F.col("fp").alias("n_false_positives"),
        preserved.alias("preserved_revenue"), cost.alias("campaign_cost"),
        ((preserved - cost) / F.greatest(cost, F.lit(1.0))).alias("roi"),
    )


def score_rows(df: DataFrame, p: str, threshold: float = 0.40, source: str | None = None) -> DataFrame:
    """Adds churn_probability (4 digits), churn_flag and risk_level; flag and risk see all digits."""
    out = df.withColumns(
        {
            "churn_probability": F.bround(named(p), 4),
            "churn_flag": (named(p) >= threshold).cast("int"),
            "risk_level": risk_level(named(p)),
        }
    )
    if source is not None:
        out = out.withColumns({"threshold_used": F.lit(float(threshold)), "model_source": F.lit(source)})
    return out


def batch_summary(scored: DataFrame) -> DataFrame:
    n, flagged = F.count(F.lit(1)), F.count_if(F.col("churn_flag") == 1)
    return scored.agg(
        n.alias("n_customers"), flagged.alias("n_churn_flag"), F.format_string("%d / %d", flagged, n).alias("at_risk")
    )


def display_rows(scored: DataFrame, keep: Sequence[str], active: str) -> DataFrame:
    """Columns as shown to users: percent text, capitalised risk, marks."""
    return scored.select(
        *keep,
        F.when(named(active) == 1, "✓").otherwise("✗").alias("Active"),
        F.format_string("%.2f%%", F.col("churn_probability") * 100).alias("Churn Prob."),
        F.initcap("risk_level").alias("Risk"),
        F.when(F.col("churn_flag") == 1, "⚠ Churn").otherwise("✓ Retained").alias("Flag"),
    )


def batch_drops(df: DataFrame, y: str, p: str, threshold: float, batch: str, reference: str, production: str) -> DataFrame:
    """One row: metrics of both batches side by side and the drops between them."""
    m = classification_metrics(df, y, p, threshold, [batch])

    def of(name, metric):
        return F.max(F.when(F.col(batch) == name, F.col(metric)))

    one = m.agg(
        *[of(reference, x).alias(f"ref_{x}") for x in ("roc_auc", "recall", "f1")],
        *[of(production, x).alias(f"prod_{x}") for x in ("roc_auc", "recall", "f1", "precision")],
    )
    return one.withColumns(
        {
            "auc_drop": F.col("ref_roc_auc") - F.col("prod_roc_auc"),
            "recall_drop": F.col("ref_recall") - F.col("prod_recall"),
        }
    )


def long_metrics(wide: DataFrame, keys: Sequence[str] = (), metrics: Sequence[str] = METRICS) -> DataFrame:
    """(keys, metric, value)."""
    return wide.unpivot(list(keys), list(metrics), "metric", "value")

"""Distribution drift between a reference and a production batch, and its alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.functions.expr import AUC_DROP_ALERT, KS_P_ALERT, PSI_BANDS, RECALL_DROP_ALERT, named, psi_label
from retentia.functions.pvalues import ks_p
from retentia.operators.ranks import frequencies, melt, quantile_map, ranked


def ks_two_sample(df: DataFrame, columns: Sequence[str], is_reference: Column) -> DataFrame:
    """Largest gap between the two empirical distributions of each column."""
    long = melt(df, columns, [is_reference.cast("long").alias("_ref")])
    freq = frequencies(long, weights={"a": F.col("_ref"), "b": 1 - F.col("_ref")})
    r = ranked(freq, weights=["a", "b"])

    def upto(w):
        return F.try_divide(F.col(f"{w}_before") + F.col(f"{w}_tie"), F.col(f"{w}_total"))

    return r.groupBy("feature").agg(
        F.max("a_total").alias("n_reference"), F.max("b_total").alias("n_production"),
        F.max(F.abs(upto("a") - upto("b"))).alias("ks_stat"),
    )


def with_drift_flag(table: DataFrame, alpha: float = KS_P_ALERT) -> DataFrame:
    """Adds the limit-law p and the drift flag, smallest p first."""
    n, m = F.col("n_reference").cast("double"), F.col("n_production").cast("double")
    return (
        table.withColumn("p_value", ks_p(F.col("ks_stat") * F.sqrt(n * m / (n + m))))
        .withColumn("drift", F.col("p_value") < alpha)
        .orderBy("p_value", "feature")
    )


def psi_edges(expected: DataFrame, column: str, bins: int = 10) -> list[float]:
    """Distinct quantile edges of the expected sample: at most bins + 1 numbers."""
    found = quantile_map(expected, [column], [i / bins for i in range(bins + 1)])[column]
    return sorted(set(found.values()))


def psi_bin(x: Column, edges: Sequence[float], open_ends: bool = False) -> Column:
    """Bin [lo, hi), the last one closed; outside null, or in the end bins when those are open."""
    last = len(edges) - 2
    inside = F.lit(True) if open_ends else (x >= edges[0]) & (x <= edges[-1])
    out = F.when(x.isNull() | ~inside, F.lit(None))
    for i, hi in enumerate(edges[1:-1]):
        out = out.when(x < hi, F.lit(i))
    return out.otherwise(F.lit(last))


def psi_table(df: DataFrame, column: str, is_expected: Column, edges: Sequence[float], open_ends: bool = False) -> DataFrame:
    """Per bin both shares (empty bins count 1e-6) and the bin's part of the index."""
    cells = df.select(psi_bin(named(column), edges, open_ends).cast("int").alias("bin"), is_expected.alias("e"))
    counted = cells.where("bin is not null").groupBy("bin").agg(F.count_if("e").alias("e"), F.count_if(~F.col("e")).alias("a"))
    totals = cells.agg(F.struct(F.count_if("e").alias("e"), F.count_if(~F.col("e")).alias("a")))
    every = df.sparkSession.range(len(edges) - 1).select(F.col("id").cast("int").alias("bin"))

    def share(x):
        n = F.coalesce(F.col(x), F.lit(0))
        return F.when(n == 0, F.lit(1e-6)).otherwise(n / totals.scalar()[x])

    shares = every.join(counted, "bin", "left").select("bin", share("e").alias("expected_pct"), share("a").alias("actual_pct"))
    gap = F.col("actual_pct") - F.col("expected_pct")
    return shares.withColumn("psi", gap * F.log(F.col("actual_pct") / F.col("expected_pct")))


def psi(df: DataFrame, column: str, is_expected: Column, bins: int = 10, open_ends: bool = False) -> DataFrame:
    """One row: the stability index and its alert level."""
    edges = psi_edges(df.where(is_expected), column, bins)
    total = psi_table(df, column, is_expected, edges, open_ends).agg(F.sum("psi").alias("psi"))
    return total.withColumn("status", psi_label(F.col("psi")))


def drift_summary(ks: DataFrame, index: DataFrame, drops: DataFrame) -> DataFrame:
    """One row over the three one-row results: counts, index, metric drops and flags."""
    n = ks.agg(F.count_if("drift").cast("int").alias("n")).scalar()
    return drops.select(
        n.alias("n_features_drifted"),
        index.select("psi").scalar().alias("psi_score"),
        "auc_drop", "recall_drop",
    ).withColumns(
        {
            "data_drift_detected": (F.col("n_features_drifted") > 0).cast("int"),
            "model_drift_detected": (
                (F.col("auc_drop") > AUC_DROP_ALERT) | (F.col("recall_drop") > RECALL_DROP_ALERT)
            ).cast("int"),
        }
    )


def retraining_trigger(summary: DataFrame, monthly_due: Column | None = None, features: int = 3) -> DataFrame:
    """Why and whether to retrain: enough drifted features, severe index, metric loss, schedule."""
    reasons = [
        ("features", F.col("n_features_drifted") >= features),
        ("psi", F.col("psi_score") > PSI_BANDS[0][1]),
        ("metrics", F.col("model_drift_detected") == 1),
        ("schedule", monthly_due if monthly_due is not None else F.lit(False)),
    ]
    said = F.filter(F.array(*[F.when(test, F.lit(name)) for name, test in reasons]), lambda x: x.isNotNull())
    return summary.withColumn("reasons", F.array_join(said, ",")).withColumn("retrain", F.size(said) > 0)

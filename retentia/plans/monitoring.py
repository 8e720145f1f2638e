"""One monitoring cycle: drift of inputs, drift of scores, loss of metrics, campaign figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.operators import drift as d
from retentia.operators.metrics import batch_drops, campaign_roi


def cycle(
    train: DataFrame, scored: DataFrame, features: Sequence[str], target: str, p: str = "p", batch: str = "batch",
    reference: str = "reference", production: str = "production", threshold: float = 0.40,
) -> dict[str, DataFrame]:
    """`train` and `scored` hold the features; `scored` also score, target and batch name.

    Inputs of the production batch are compared with the training rows, its scores and metrics
    with the reference batch.
    """
    live = scored.where(F.col(batch) == production)
    both = train.select(*features, F.lit(1).alias("_ref")).unionByName(live.select(*features, F.lit(0).alias("_ref")))
    ks = d.with_drift_flag(d.ks_two_sample(both, features, F.col("_ref")))
    # The index reads scores as reported, with four digits.
    reported = scored.withColumn("_score", F.bround(p, 4))
    index = d.psi(reported, "_score", F.col(batch) == reference)
    drops = batch_drops(reported, target, "_score", threshold, batch, reference, production)
    summary = d.drift_summary(ks, index, drops)
    return {
        "ks": ks, "psi": index, "drops": drops, "summary": summary,
        "retraining": d.retraining_trigger(summary), "roi": campaign_roi(live, target, p, threshold),
    }

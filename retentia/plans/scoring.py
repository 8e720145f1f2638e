"""A saved pipeline as a predictor for tables, streams and single records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retentia.operators.metrics import score_rows
from retentia.operators.models import load_pipeline, score_with


class Predictor:
    """Loads a pipeline folder; its saved threshold holds unless another is given."""

    def __init__(self, spark: SparkSession, path: str, threshold: float | None = None):
        self.spark = spark
        self.model, self.schema = load_pipeline(spark, path)
        self.threshold = self.schema["threshold"] if threshold is None else threshold
        self.source = f"saved:{path.rstrip('/').rsplit('/', 1)[-1]}"

    def predict(self, df: DataFrame, threshold: float | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
        """(kept columns, churn_probability, churn_flag, risk_level); batch or stream."""
        at = self.threshold if threshold is None else threshold
        return score_rows(score_with(self.model, self.schema, df), "p", at).select(
            *keep, "churn_probability", "churn_flag", "risk_level"
        )

    def predict_single(self, record: dict, threshold: float | None = None) -> dict:
        """One record's prediction with the threshold that was used and the model's source."""
        at = self.threshold if threshold is None else threshold
        row = self.predict(self.spark.createDataFrame([record]), at).first()
        return {**row.asDict(), "threshold_used": at, "model_source": self.source}

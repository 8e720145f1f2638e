"""Run and metric tables: append, look up, compare, promote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

# Promotion bounds.
MIN_AUC = 0.85
MIN_RECALL = 0.70

RUN_SCHEMA = "run_uuid string, experiment string, name string, stage string, start_time timestamp, params map<string,string>"
METRIC_SCHEMA = "run_uuid string, metric string, value double, step int"


def log_run(spark: SparkSession, root: str, run: dict, metrics: dict[str, float], step: int = 0) -> None:
    """Append one run and its metrics to the Parquet tables below root."""
    spark.createDataFrame([run], RUN_SCHEMA).write.mode("append").parquet(f"{root}/runs")
    rows = [(run["run_uuid"], k, float(v), step) for k, v in metrics.items()]
    spark.createDataFrame(rows, METRIC_SCHEMA).write.mode("append").parquet(f"{root}/metrics")


def read_runs(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    try:
        return spark.read.schema(RUN_SCHEMA).parquet(f"{root}/runs"), spark.read.schema(METRIC_SCHEMA).parquet(f"{root}/metrics")
    except AnalysisException:
        return spark.createDataFrame([], RUN_SCHEMA), spark.createDataFrame([], METRIC_SCHEMA)


def latest_run(runs: DataFrame, experiments: DataFrame, experiment: str, name: str) -> DataFrame:
    """The most recent run of that name in the experiment."""
    wanted = experiments.where(F.col("experiment_name") == experiment).select("experiment_id")
    return (
        runs.join(wanted, "experiment_id").where(F.col("name") == name)
        .orderBy(F.col("start_time").desc(), "run_uuid").limit(1)
    )


def metrics_of(metrics: DataFrame, run: DataFrame) -> DataFrame:
    """(run_uuid, metrics map) of the given runs."""
    kept = metrics.join(run.select("run_uuid"), "run_uuid", "left_semi")
    return kept.groupBy("run_uuid").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", "value")))).alias("metrics"))


def leaderboard(summary: DataFrame, metric: str) -> DataFrame:
    """Models from best to worst."""
    return summary.orderBy(F.col(metric).desc(), "model")


def best_model(summary: DataFrame, metric: str) -> DataFrame:
    return summary.agg(F.max_by("model", F.struct(metric, "model")).alias("model"), F.max(metric).alias(metric))


def fold_summary(folds: DataFrame, metrics, by: str = "model") -> DataFrame:
    """Mean and sample deviation of each metric over the folds."""
    aggs = [a for m in metrics for a in (F.avg(m).alias(f"cv_{m}_mean"), F.stddev_samp(m).alias(f"cv_{m}_std"))]
    return folds.groupBy(by).agg(*aggs)


def cv_against_holdout(cv: DataFrame, holdout: DataFrame) -> DataFrame:
    """(metric, cv_mean, holdout, gap) from two (metric, value) tables."""
    return cv.select("metric", F.col("value").alias("cv_mean")).join(
        holdout.select("metric", F.col("value").alias("holdout")), "metric"
    ).withColumn("gap", F.col("holdout") - F.col("cv_mean"))


def promotion(auc: Column, recall: Column) -> Column:
    return F.when((auc >= MIN_AUC) & (recall >= MIN_RECALL), "Production").otherwise("Staging")

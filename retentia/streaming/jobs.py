"""Streaming scoring, windowed drift and the streaming quality gate.

Each job reads files as they arrive, keeps its progress below the shared folder, and can be
restarted after losing executors or the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from retentia.operators.drift import psi_bin
from retentia.operators.quality import Rule, split_rows


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def stream_scores(rows: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, progress: str) -> StreamingQuery:
    """Row-wise features and scores to a Parquet sink; every row exactly once."""
    return (
        score(rows).writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", progress)
        .trigger(availableNow=True).start()
    )


def window_bins(events: DataFrame, ts: str, value: str, edges: Sequence[float], width: str, late: str) -> DataFrame:
    """Counts per tumbling window and reference bin; windows close when the watermark passes."""
    binned = events.withWatermark(ts, late).select(
        F.window(ts, width).alias("w"), F.coalesce(psi_bin(F.col(value), edges).cast("int"), F.lit(-1)).alias("bin")
    )
    return binned.groupBy("w", "bin").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("window_start"), "bin", "n"
    )


def window_psi(counts: DataFrame, reference: DataFrame) -> DataFrame:
    """Index of each window against the reference bin counts (bin, n); bin -1 is out of range.

    Works on finished window counts: windows x bins rows.
    """
    total = reference.agg(F.sum("n")).scalar()
    shares = reference.where("bin >= 0").select("bin", F.when(F.col("n") == 0, 1e-6).otherwise(F.col("n") / total).alias("e"))
    windows = counts.groupBy("window_start").agg(F.sum("n").alias("total"))
    # Every window gets every bin: the fixed bins are unfolded per window row.
    bins = shares.agg(F.collect_list(F.struct("bin", "e"))).scalar()
    full = windows.select("window_start", "total", F.inline(bins))
    joined = full.join(counts, ["window_start", "bin"], "left")
    a = F.when(F.coalesce("n", F.lit(0)) == 0, 1e-6).otherwise(F.col("n") / F.col("total"))
    term = (a - F.col("e")) * F.log(a / F.col("e"))
    return joined.groupBy("window_start").agg(F.max("total").alias("n"), F.sum(term).alias("psi"))


def stream_window_counts(counts: DataFrame, out: str, progress: str) -> StreamingQuery:
    """Closed windows to a Parquet sink (append: a window is written once, when it is final)."""
    return (
        counts.writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", progress)
        .trigger(availableNow=True).start()
    )


def stream_quality_gate(rows: DataFrame, rules: Sequence[Rule], good: str, bad: str, progress: str) -> StreamingQuery:
    """Split arriving rows into good and quarantined ones, both kept.

    A batch that is run again after a failure overwrites its own folder, so no row is doubled.
    """

    def split(batch: DataFrame, number: int) -> None:
        tested = split_rows(batch, rules).persist()
        try:
            tested.where(F.size("violated") == 0).drop("violated").write.mode("overwrite").parquet(f"{good}/batch={number}")
            tested.where(F.size("violated") > 0).write.mode("overwrite").parquet(f"{bad}/batch={number}")
        finally:
            tested.unpersist()

    return rows.writeStream.foreachBatch(split).option("checkpointLocation", progress).trigger(availableNow=True).start()

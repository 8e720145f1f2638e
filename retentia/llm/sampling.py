"""Held-out rule and bounded samples of labelled rows, shared by the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4, is 2; null ids are not held out (and never learned from)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample_ids(rows: DataFrame, label: str, per_label: int) -> DataFrame:
    """(doc_id, label) of at most `per_label` rows of each label, lowest hashes of the id first.

    Labels are counted map-side, and a label's rows are compared where they lie with the share of hashes that holds
    twice as many as wanted (and 64 more), so that only about so many rows of a label are ranked, whatever its size.
    That fewer than `per_label` hashes lie below it has no chance worth naming (below e^-100 for 400).
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 52)) / float(1 << 52)
    one = rows.select("doc_id", F.col(label).alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL").where(~held_out())
    sizes = one.groupBy(F.col("label").alias("__label")).agg(F.count(F.lit(1)).alias("__n"))
    near = one.join(sizes, F.col("label") == F.col("__label")).withColumn("__at", place).where(F.col("__at") * F.col("__n") < 2 * per_label + 64)
    ranked = near.withColumn("__place", F.row_number().over(Window.partitionBy("label").orderBy("__at", "doc_id")))
    return ranked.where(F.col("__place") <= per_label).select("doc_id", "label").distinct()

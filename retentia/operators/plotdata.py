"""Data behind the figures: histograms, box plots, density curves."""

from __future__ import annotations

from collections.abc import Sequence
from math import pi, sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.operators.profile import quartiles, row_percent
from retentia.operators.ranks import frequencies, melt, quantiles_of
from retentia.session import lookup


def histogram(df: DataFrame, columns: Sequence[str], bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width counts between each column's (and group's) own minimum and maximum."""
    long = melt(df, columns, by)
    for b in by:
        long = long.where(F.col(b).isNotNull())
    keys = ["feature", *by]
    span = long.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.when(F.col("hi") == F.col("lo"), 0).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1))
    )
    return (
        long.join(lookup(span), keys)
        .groupBy(*keys, at.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"), F.min("hi").alias("hi"))
        .select(*keys, "bin", (F.col("lo") + F.col("bin") * width).alias("bin_lo"), "n")
    )


def box_plot(df: DataFrame, columns: Sequence[str], by: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends (last value within reach x IQR) and points beyond, per class."""
    freq = frequencies(melt(df, columns, [by]).where(F.col(by).isNotNull()), [by])
    q = quartiles(quantiles_of(freq, [0.25, 0.5, 0.75], [by]), [by])
    keys = ["feature", by]
    spread = (F.col("q3") - F.col("q1")) * reach
    near = (F.col("value") >= F.col("q1") - spread) & (F.col("value") <= F.col("q3") + spread)
    return (
        freq.join(lookup(q), keys)
        .groupBy(*keys)
        .agg(
            F.min("q1").alias("q1"), F.min("median").alias("median"), F.min("q3").alias("q3"),
            F.min(F.when(near, F.col("value"))).alias("whisker_lo"),
            F.max(F.when(near, F.col("value"))).alias("whisker_hi"),
            F.sum(F.when(near, 0).otherwise(F.col("n"))).alias("fliers"),
        )
    )


def density(df: DataFrame, column: str, by: str, points: int = 100) -> DataFrame:
    """Gaussian density per class on an even grid, bandwidth n^(-1/5) sample deviations.

    The grid runs half the value range beyond both ends. Values are collapsed first and partial
    sums stay map-side, so the shuffle carries classes x points rows.
    """
    freq = frequencies(melt(df, [column], [by]).where(F.col(by).isNotNull()), [by])
    n, x = F.col("n"), F.col("value")
    shape = melt(df, [column], [by]).where(F.col(by).isNotNull()).groupBy(by).agg(
        F.count(x).alias("n_all"),
        (F.stddev_samp(x) * F.pow(F.count(x).cast("double"), F.lit(-0.2))).alias("h"),
        F.min(x).alias("lo"),
        F.max(x).alias("hi"),
    )
    start, step = F.col("lo") - (F.col("hi") - F.col("lo")) / 2, (F.col("hi") - F.col("lo")) * 2 / (points - 1)
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    u = (F.col("x") - x) / F.col("h")
    return (
        freq.join(lookup(shape), by)
        .select(by, "value", "n", "h", "n_all", start.alias("start"), step.alias("step"), grid.alias("point"))
        .withColumn("x", F.col("start") + F.col("point") * F.col("step"))
        .groupBy(by, "point")
        .agg(
            F.min("x").alias("x"),
            (F.sum(n * F.exp(-u * u / 2)) / (F.min("n_all") * F.min("h") * sqrt(2 * pi))).alias("density"),
        )
    )


def three_way(df: DataFrame, outer: str, inner: str, target: str) -> DataFrame:
    """Share of the target's values within (outer, inner), percent."""
    cells = df.groupBy(outer, inner, target).agg(F.count(F.lit(1)).alias("n"))
    return row_percent(cells, [outer, inner])

"""Ranks, cumulative counts and exact quantiles without a global sort in one task.

Rows are collapsed to distinct values first, so a value that fills a third of the table is one
row. Distinct values are cut into buckets of about equal size at approximate quantiles, each
bucket is summed up, and the running sum inside a bucket starts from the sum of the buckets
before it. The result is exact whatever the cut points are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retentia.functions.expr import named
from retentia.session import bucket_count

_STRIDE = 32


def melt(df: DataFrame, columns: Sequence[str], carry: Sequence[str | Column] = ()) -> DataFrame:
    """(feature, value, carried columns), one row per non-null number; NaN counts as null."""
    pairs = [F.struct(F.lit(c).alias("feature"), named(c).cast("double").alias("value")) for c in columns]
    kept = [named(c) if isinstance(c, str) else c for c in carry]
    long = df.select(*kept, F.explode(F.array(*pairs)).alias("_p"))
    out = long.select("_p.feature", "_p.value", *[x for x in long.columns if x != "_p"])
    return out.where(F.col("value").isNotNull() & ~F.isnan("value"))


def frequencies(long: DataFrame, by: Sequence[str] = (), weights: dict[str, Column] | None = None) -> DataFrame:
    """Distinct values per feature (and `by`) with summed weights; plain count by default."""
    aggs = [F.sum(w).alias(n) for n, w in (weights or {"n": F.lit(1)}).items()]
    return long.groupBy("feature", *by, "value").agg(*aggs)


def _bucket(value: str, cuts: str) -> Column:
    """Number of cut points below the value, found in two short passes over the sorted cuts."""
    v = F.col(value).cast("double")
    coarse = F.size(
        F.filter(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor(F.size(cuts) / _STRIDE).cast("int"))),
                lambda i: F.get(F.col(cuts), i * _STRIDE - 1),
            ),
            lambda x: x < v,
        )
    )
    fine = F.slice(F.col(cuts), coarse * _STRIDE + 1, F.lit(_STRIDE))
    return F.coalesce(coarse * _STRIDE + F.size(F.filter(fine, lambda x: x < v)), F.lit(0))


def with_buckets(freq: DataFrame, value: str, buckets: int | None = None) -> DataFrame:
    """Adds `_bucket`, monotone in the value within a feature."""
    b = buckets or bucket_count(freq.sparkSession)
    probs = [i / b for i in range(1, b)]
    cuts = freq.groupBy("feature").agg(F.percentile_approx(F.col(value).cast("double"), probs, 10 * b).alias("_cuts"))
    # One array of at most `buckets` numbers per feature: bounded, whatever the data size. They are taken once: the
    # approximation depends on the order of the tasks, and rows must not be cut otherwise than the sums before them.
    cuts = freq.sparkSession.createDataFrame(cuts.collect(), cuts.schema)
    return (
        freq.join(F.broadcast(cuts), "feature")
        .withColumn("_bucket", _bucket(value, "_cuts"))
        .drop("_cuts")
    )


def ranked(
    freq: DataFrame,
    keys: Sequence[str] = ("feature",),
    value: str = "value",
    weights: Sequence[str] = ("n",),
    buckets: int | None = None,
    only: Column | None = None,
    repeated: bool = False,
) -> DataFrame:
    """Adds per weight w: w_before (sum over smaller values), w_tie (equal values), w_total.

    `keys` starts with "feature". `freq` has one row per key and value; with `repeated` it may
    hold several (one per class, say), which then share one place.
    Average rank of a value is n_before + (n_tie + 1) / 2. `only` keeps the buckets it holds for,
    tested on w_total, _off_w (weight in earlier buckets) and _in_w (weight in the bucket).
    """
    keys = list(keys)
    cut = with_buckets(freq, value, buckets)
    sums = cut.groupBy(*keys, "_bucket").agg(*[F.sum(w).alias(w) for w in weights])
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = sums.select(
        *keys,
        "_bucket",
        *[F.coalesce(F.sum(w).over(earlier), F.lit(0)).alias(f"_off_{w}") for w in weights],
        *[F.sum(w).over(whole).alias(f"{w}_total") for w in weights],
        *[F.col(w).alias(f"_in_{w}") for w in weights],
    )
    if only is not None:
        offsets = offsets.where(only)
    offsets = offsets.drop(*[f"_in_{w}" for w in weights])
    running = Window.partitionBy(*keys, "_bucket").orderBy(value)
    tie = Window.partitionBy(*keys, "_bucket", value)
    out = cut.join(offsets, [*keys, "_bucket"])
    out = out.withColumns(
        {f"_cum_{w}": F.col(f"_off_{w}") + F.sum(w).over(running) for w in weights}
    ).withColumns({f"{w}_tie": F.sum(w).over(tie) if repeated else F.col(w) for w in weights})
    return out.withColumns({f"{w}_before": F.col(f"_cum_{w}") - F.col(f"{w}_tie") for w in weights}).drop(
        "_bucket", *[f"_off_{w}" for w in weights], *[f"_cum_{w}" for w in weights]
    )


def average_rank(weight: str = "n") -> Column:
    return F.col(f"{weight}_before") + (F.col(f"{weight}_tie") + 1) / 2


def quantiles_of(freq: DataFrame, probs: Sequence[float], by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Linear-interpolated quantiles from distinct-value counts: (feature, by, prob, quantile)."""
    # Only the buckets that hold a wanted order statistic are shuffled and sorted.
    at = [(F.col("n_total") - 1) * F.lit(float(p)) for p in probs]
    first, end = F.col("_off_n"), F.col("_off_n") + F.col("_in_n") - 1
    touched = F.exists(F.array(*at), lambda x: (F.ceil(x) >= first) & (F.floor(x) <= end))
    r = ranked(freq, ["feature", *by], buckets=buckets, only=touched)
    wanted = F.array(
        *[
            F.struct(
                F.lit(float(p)).alias("prob"),
                ((F.col("n_total") - 1) * F.lit(float(p))).alias("at"),
            )
            for p in probs
        ]
    )
    last = F.col("n_before") + F.col("n_tie") - 1
    # A distinct value answers only the probabilities whose two order statistics touch it.
    hits = r.withColumn(
        "_hits", F.filter(wanted, lambda s: (F.ceil(s["at"]) >= F.col("n_before")) & (F.floor(s["at"]) <= last))
    ).where(F.size("_hits") > 0)
    rows = hits.select("feature", *by, "value", "n_before", last.alias("last"), F.explode("_hits").alias("h"))
    lo, hi = F.floor("h.at"), F.ceil("h.at")
    ends = rows.groupBy("feature", *by, F.col("h.prob").alias("prob"), F.col("h.at").alias("at")).agg(
        F.max(F.when((lo >= F.col("n_before")) & (lo <= F.col("last")), F.col("value"))).alias("lo"),
        F.max(F.when((hi >= F.col("n_before")) & (hi <= F.col("last")), F.col("value"))).alias("hi"),
    )
    step = F.col("at") - F.floor("at")
    return ends.select(
        "feature", *by, "prob", (F.col("lo") + (F.col("hi") - F.col("lo")) * step).alias("quantile")
    )


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), accuracy: int | None = None
) -> DataFrame:
    """Exact quantiles of several columns in one job.

    With `accuracy` the built-in sketch is used instead (one pass, rank error 1/accuracy).
    """
    long = melt(df, columns, by)
    for b in by:
        long = long.where(named(b).isNotNull())
    if accuracy:
        probs = [float(p) for p in probs]
        sketch = long.groupBy("feature", *by).agg(F.percentile_approx("value", probs, accuracy).alias("q"))
        pairs = F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("prob"), F.col("q").alias("quantile"))
        return sketch.select("feature", *by, F.inline(pairs).alias("prob", "quantile"))
    return quantiles_of(frequencies(long, by), probs, by)


def quantile_map(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, dict[float, float]]:
    """{column: {prob: value}}; at most columns x probs numbers reach the driver."""
    found = {(r["feature"], r["prob"]): r["quantile"] for r in quantiles(df, columns, probs).collect()}
    return {c: {p: found[c, p] for p in map(float, probs) if (c, p) in found} for c in columns}


def numbered(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), into: str = "rn", bucket: Column | None = None) -> DataFrame:
    """row_number over the table (or per `by`) in the order of a unique key, without one big sort.

    `bucket` must not decrease along the order; for a hash key its leading digits will do. Left
    out, the first order column must be numeric and is cut at approximate quantiles.
    """
    by = list(by)
    if bucket is None:
        cut = with_buckets(df.withColumn("feature", F.lit("")), order[0]).drop("feature")
    else:
        cut = df.withColumn("_bucket", bucket)
    sums = cut.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    # One row per (by, bucket): small, so a window over it is no bottleneck.
    offsets = sums.select(
        *by, "_bucket",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"),
        F.sum("_n").over(whole).alias(f"{into}_total"),
    )
    inner = Window.partitionBy(*by, "_bucket").orderBy(*order)
    return (
        cut.join(offsets, [*by, "_bucket"])
        .withColumn(into, (F.col("_off") + F.row_number().over(inner)).cast("long"))
        .drop("_bucket", "_off")
    )

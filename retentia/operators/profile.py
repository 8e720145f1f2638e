"""Profiling as aggregates: wide one-pass statistics, long value counts, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.functions.expr import cut, named
from retentia.operators.ranks import frequencies, melt, quantile_map, quantiles_of, ranked


def per_column(df: DataFrame, columns: Sequence[str], make, name: str = "column") -> DataFrame:
    """One pass over df; `make(column)` gives the aggregates of a column, returned one row each."""
    one = df.agg(*[F.struct(*make(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    fields = one.schema[0].dataType.names
    rows = [
        F.struct(F.lit(c).alias(name), *[F.col(f"c{i}")[x].alias(x) for x in fields])
        for i, c in enumerate(columns)
    ]
    return one.select(F.inline(F.array(*rows)))


def overview(df: DataFrame, roles: dict[str, Sequence[str]]) -> DataFrame:
    """(position, column, dtype, role, n_rows); names and types are metadata, one count is run."""
    role_of = {c: r for r, cs in roles.items() for c in cs}
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.lit(role_of.get(c, "other")).alias("role"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.inline(F.array(*rows)))


def missing_profile(df: DataFrame) -> DataFrame:
    """Nulls per column with percent."""
    return per_column(
        df,
        df.columns,
        lambda c: [
            F.count_if(named(c).isNull()).alias("missing_count"),
            (F.count_if(named(c).isNull()) / F.count(F.lit(1)) * 100).alias("missing_pct"),
            (F.count_if(named(c).isNull()) > 0).alias("has_missing"),
        ],
    )


def missing_total(df: DataFrame) -> DataFrame:
    nulls = sum((F.count_if(named(c).isNull()) for c in df.columns[1:]), F.count_if(named(df.columns[0]).isNull()))
    cells = F.count(F.lit(1)) * len(df.columns)
    return df.agg(
        nulls.alias("total_missing_cells"), cells.alias("total_cells"), (nulls / cells * 100).alias("overall_missing_pct")
    )


def duplicates(df: DataFrame, id_columns: Sequence[str], key: str) -> DataFrame:
    """Rows beyond the first of equal rows, with and without the id columns; distinct keys."""
    features = [c for c in df.columns if c not in id_columns]

    def extra(columns):
        # Copies collapse map-side, so a row repeated over a third of the table costs nothing.
        return (
            df.groupBy(*[named(c) for c in columns]).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))
        )

    keys = df.select(named(key).alias("k")).where("k is not null").distinct().agg(F.count(F.lit(1)).alias("unique_ids"))
    return keys.select(
        extra(df.columns).scalar().alias("exact_duplicates"),
        extra(features).scalar().alias("feature_duplicates"),
        "unique_ids",
    )


def skewness(x: Column, n: Column) -> Column:
    """Bias-corrected sample skewness."""
    return F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))


def excess_kurtosis(x: Column, n: Column) -> Column:
    """Bias-corrected sample excess kurtosis."""
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(x) + 6))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Moments of every column in one pass, long form."""

    def stats(c):
        x, n = named(c).cast("double"), F.count(named(c)).cast("double")
        return [
            F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"), F.max(x).alias("max"),
            skewness(x, n).alias("skewness"), excess_kurtosis(x, n).alias("kurtosis"),
        ]

    return per_column(df, columns, stats, "feature")


def iqr_outliers(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Values outside quartile fences; quartiles and counts both come from the distinct values."""
    freq = frequencies(melt(df, columns))
    return with_fences(freq, quartiles(quantiles_of(freq, [0.25, 0.75])), reach)


def quartiles(q: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    def at(p):
        return F.max(F.when(F.col("prob") == p, F.col("quantile")))

    return q.groupBy("feature", *by).agg(at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))


def with_fences(freq: DataFrame, q: DataFrame, reach: float) -> DataFrame:
    spread = (F.col("q3") - F.col("q1")) * reach
    fences = q.select("feature", (F.col("q3") - F.col("q1")).alias("iqr"), (F.col("q1") - spread).alias("lo"), (F.col("q3") + spread).alias("hi"))
    outside = (F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi"))
    # One fence row per column.
    return (
        freq.join(F.broadcast(fences), "feature")
        .groupBy("feature")
        .agg(
            F.max("iqr").alias("iqr"), F.max("lo").alias("fence_lo"), F.max("hi").alias("fence_hi"),
            F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("outliers"),
            (F.sum(F.when(outside, F.col("n")).otherwise(0)) / F.sum("n") * 100).alias("outliers_pct"),
        )
    )


def zscore_outliers(df: DataFrame, columns: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Values more than `limit` population deviations from the mean."""
    long = melt(df, columns)
    stats = long.groupBy("feature").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"))
    z = F.abs(F.try_divide(F.col("value") - F.col("m"), F.col("s")))
    # One row per column on the broadcast side.
    return long.join(F.broadcast(stats), "feature").groupBy("feature").agg(F.count_if(z > limit).alias("outliers"))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n, pct) of every column from one shuffle."""
    counts = label_counts(df, columns)
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", "n", (F.col("n") / F.col("total") * 100).alias("pct")
    )


def labels(df: DataFrame, columns: Sequence[str], carry: Sequence[Column] = ()) -> DataFrame:
    """(column, value as text, carried), one row per non-null cell."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), named(c).cast("string").alias("value")) for c in columns])
    return df.select(*carry, F.inline(cells)).where(F.col("value").isNotNull())


def label_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return labels(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def entropy(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values and Shannon entropy (bits) of each column's value counts."""
    n = F.col("n").cast("double")
    return label_counts(df, columns).groupBy("column").agg(
        F.count(F.lit(1)).alias("unique_count"),
        (F.log2(F.sum(n)) - F.sum(n * F.log2(n)) / F.sum(n)).alias("entropy_bits"),
    )


def target_summary(df: DataFrame, target: str) -> DataFrame:
    y = named(target)
    n, pos, neg = F.count(F.lit(1)), F.count_if(y == 1), F.count_if(y == 0)
    return df.agg(
        n.alias("n_total"), pos.alias("n_positive"), neg.alias("n_negative"),
        (pos / n * 100).alias("rate_pct"), ((1 - pos / n) * 100).alias("retention_pct"),
        F.when(pos > 0, neg / pos).alias("imbalance_ratio"),
    )


def target_rate_by_group(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Positives, rows and rate per value of each column, all columns in one shuffle."""
    return (
        labels(df, columns, [named(target).alias("_y")])
        .groupBy("column", "value")
        .agg(F.sum("_y").alias("positives"), F.count("_y").alias("total"), (F.avg("_y") * 100).alias("rate_pct"))
    )


def contingency(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(left, right, a, b, n) for every column pair from one shuffle."""
    cells = F.array(
        *[
            F.struct(F.lit(x).alias("left"), F.lit(y).alias("right"), named(x).cast("string").alias("a"), named(y).cast("string").alias("b"))
            for x, y in pairs
        ]
    )
    long = df.select(F.inline(cells)).where("a is not null and b is not null")
    return long.groupBy("left", "right", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def row_percent(cells: DataFrame, row: Sequence[str], n: str = "n") -> DataFrame:
    """Adds each cell's share of its row in percent."""
    totals = cells.groupBy(*row).agg(F.sum(n).alias("_total"))
    return cells.join(totals, list(row)).withColumn("pct", F.col(n) / F.col("_total") * 100).drop("_total")


def quantile_bins(df: DataFrame, column: str, q: int = 4, into: str | None = None) -> DataFrame:
    """0-based quantile bin: right-closed, lowest value included, equal edges merged."""
    found = quantile_map(df, [column], [i / q for i in range(q + 1)])[column]
    edges = sorted(set(found.values()))
    name = into or f"{column}_bin"
    if len(edges) < 2:
        return df.withColumn(name, F.lit(None).cast("int"))
    return df.withColumn(name, cut(named(column).cast("double"), edges, list(range(len(edges) - 1)), lowest=True))


def rate_matrix(df: DataFrame, left: str, right: str, target: str, numeric: Sequence[str], q: int = 4) -> DataFrame:
    """Mean target (percent) over two columns, numeric ones cut at quartiles: (a, b, rate_pct)."""
    data = df.select(named(left), named(right), named(target)).na.drop()
    keys = {}
    for side, c in (("a", left), ("b", right)):
        if c in numeric:
            data = quantile_bins(data, c, q, f"_bin_{side}")
            keys[side] = F.col(f"_bin_{side}").cast("string")
        else:
            keys[side] = named(c).cast("string")
    return data.groupBy(keys["a"].alias("a"), keys["b"].alias("b")).agg((F.avg(named(target)) * 100).alias("rate_pct"))


def variance_ratio(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Sample variance of the positives over that of the negatives."""
    y = named(target)

    def make(c):
        one = F.var_samp(F.when(y == 1, named(c)))
        zero = F.var_samp(F.when(y == 0, named(c)))
        return [F.when(zero > 0, one / zero).alias("variance_ratio")]

    return per_column(df, columns, make, "feature")


def group_lift(df: DataFrame, value: str, group: str, baseline: str) -> DataFrame:
    """Mean of a column per group, and its relative difference from the baseline group."""
    means = df.groupBy(named(group).alias("group")).agg(F.avg(named(value)).alias("mean"), F.count(named(value)).alias("n"))
    base = means.where(F.col("group") == baseline).select("mean").scalar()
    return means.withColumn("lift_pct", (F.col("mean") / base - 1) * 100)


def cumulative_share(df: DataFrame, order: str, target: str) -> DataFrame:
    """Running share (percent) of positives by an ordered numeric key, over all positives."""
    long = melt(df, [order], [named(target).cast("long").alias("_y")])
    r = ranked(frequencies(long, weights={"total": F.lit(1), "positives": F.col("_y")}), weights=["positives"])
    every = df.agg(F.sum(named(target))).scalar()
    upto = F.col("positives_before") + F.col("positives_tie")
    return r.select(F.col("value").alias("key"), "positives", "total", (upto / every * 100).alias("cumulative_pct"))

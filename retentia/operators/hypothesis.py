"""Group comparisons: rank tests, t-test, variance analysis, normality.

Each test reduces to counts, means and variances per group, or to ranks of distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.functions.expr import effect_label, named
from retentia.functions.pvalues import chi2_p, f_p, ks_p, normal_cdf_column, normal_p, t_p, tukey_p
from retentia.operators.ranks import average_rank, frequencies, melt, quantiles_of, ranked


def _by_class(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    return melt(df, columns, [named(target).cast("int").alias("_y")]).where(F.col("_y").isin(0, 1))


def mann_whitney(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """U of the positives and its tie- and continuity-corrected normal score (two-sided)."""
    freq = frequencies(_by_class(df, columns, target), weights={"n": F.lit(1), "pos": F.col("_y")})
    n, n1 = F.col("n").cast("double"), F.col("n1").cast("double")
    s = ranked(freq).groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("pos").alias("n1"), F.sum(F.col("pos") * average_rank()).alias("rank_sum"),
        F.sum(F.pow(F.col("n").cast("double"), F.lit(3)) - F.col("n")).alias("ties"),
    )
    n0 = n - n1
    u = F.col("rank_sum") - n1 * (n1 + 1) / 2
    sigma = F.sqrt(n1 * n0 / 12 * (n + 1 - F.col("ties") / (n * (n - 1))))
    top = F.greatest(u, n1 * n0 - u)
    return s.select(
        "feature", F.col("n1"), n0.cast("long").alias("n0"), u.alias("u"),
        F.try_divide(top - n1 * n0 / 2 - 0.5, sigma).alias("z"),
    )


def group_comparison(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Per column both classes' n, mean, median and deviation; Welch t, its dof, Cohen's d."""
    long = _by_class(df, columns, target)
    moments = long.groupBy("feature").agg(
        *[
            agg(F.when(F.col("_y") == k, F.col("value"))).alias(f"{name}{k}")
            for k in (1, 0)
            for name, agg in (("n", F.count), ("mean", F.avg), ("std", F.stddev_samp))
        ]
    )
    q = quantiles_of(frequencies(long, ["_y"]), [0.5], ["_y"])
    medians = q.groupBy("feature").agg(
        *[F.max(F.when(F.col("_y") == k, F.col("quantile"))).alias(f"median{k}") for k in (1, 0)]
    )
    v1, v0 = F.pow("std1", F.lit(2)) / F.col("n1"), F.pow("std0", F.lit(2)) / F.col("n0")
    gap = F.col("mean1") - F.col("mean0")
    pooled = F.sqrt((F.pow("std1", F.lit(2)) + F.pow("std0", F.lit(2))) / 2)
    return moments.join(medians, "feature").select(
        "feature", "n1", "mean1", "median1", "std1", "n0", "mean0", "median0", "std0",
        gap.alias("mean_difference"),
        F.try_divide(gap, F.sqrt(v1 + v0)).alias("welch_t"),
        F.try_divide(F.pow(v1 + v0, F.lit(2)), F.pow(v1, F.lit(2)) / (F.col("n1") - 1) + F.pow(v0, F.lit(2)) / (F.col("n0") - 1)).alias("welch_df"),
        F.when(pooled > 0, gap / pooled).otherwise(0.0).alias("cohens_d"),
    )


def _crossed(df: DataFrame, columns: Sequence[str], groupings: Sequence[str]) -> DataFrame:
    """(feature, grouping, grp, n, mean, m2): the statistics every variance analysis needs."""
    long = melt(df, columns, [named(g).cast("string").alias(f"_g{i}") for i, g in enumerate(groupings)])
    axes = F.array(*[F.struct(F.lit(g).alias("grouping"), F.col(f"_g{i}").alias("grp")) for i, g in enumerate(groupings)])
    flat = long.select("feature", "value", F.inline(axes)).where("grp is not null")
    return flat.groupBy("feature", "grouping", "grp").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("value")).alias("m2"),
    )


def _anova_parts(stats: DataFrame) -> DataFrame:
    total = F.sum("n")
    # Between-group squares around the grand mean, through two-pass differences of group means.
    keys = ["feature", "grouping"]
    grand = stats.groupBy(*keys).agg((F.sum(F.col("n") * F.col("mean")) / total).alias("gm"))
    return stats.join(grand, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("groups"), F.sum("n").alias("n"),
        F.sum(F.col("n") * F.pow(F.col("mean") - F.col("gm"), F.lit(2))).alias("ssb"), F.sum("m2").alias("ssw"),
    )


def _f(parts: DataFrame) -> Column:
    return F.try_divide(F.col("ssb") / (F.col("groups") - 1), F.col("ssw") / (F.col("n") - F.col("groups")))


def anova(df: DataFrame, columns: Sequence[str], groupings: Sequence[str]) -> DataFrame:
    """One-way F for every column and grouping from one shuffle of group statistics."""
    parts = _anova_parts(_crossed(df, columns, groupings)).where("groups > 1")
    return parts.select("feature", "grouping", "groups", "n", _f(parts).alias("f"))


def eta_squared(df: DataFrame, columns: Sequence[str], groupings: Sequence[str]) -> DataFrame:
    """Share of variance between groups, and its label."""
    total = F.col("ssb") + F.col("ssw")
    out = _anova_parts(_crossed(df, columns, groupings)).select(
        "feature", "grouping", F.when(total > 0, F.col("ssb") / total).otherwise(0.0).alias("eta_squared")
    )
    return out.withColumn("effect", effect_label(F.col("eta_squared")))


def kruskal(df: DataFrame, columns: Sequence[str], groupings: Sequence[str]) -> DataFrame:
    """Tie-corrected H. Values are ranked once per column, weighted by presence of each grouping."""
    g = [f"_g{i}" for i in range(len(groupings))]
    long = melt(df, columns, [named(c).cast("string").alias(x) for c, x in zip(groupings, g)])
    weights = {f"w{i}": F.col(x).isNotNull().cast("long") for i, x in enumerate(g)}
    freq = frequencies(long, g, weights={**weights, "n": F.lit(1)})
    r = ranked(freq, weights=list(weights), repeated=True)
    axes = F.array(
        *[
            F.struct(
                F.lit(name).alias("grouping"), F.col(x).alias("grp"), average_rank(f"w{i}").alias("rank"),
                F.col(f"w{i}_tie").cast("double").alias("tie"), F.col(f"w{i}_total").cast("double").alias("total"),
            )
            for i, (name, x) in enumerate(zip(groupings, g))
        ]
    )
    flat = r.select("feature", "n", F.inline(axes)).where("grp is not null")
    # Summed over its rows, (t^2 - 1) of a tied block gives t^3 - t.
    per_group = flat.groupBy("feature", "grouping", "grp").agg(
        F.sum("n").cast("double").alias("m"), F.sum(F.col("n") * F.col("rank")).alias("rs"),
        F.sum(F.col("n") * (F.col("tie") * F.col("tie") - 1)).alias("ties"), F.max("total").alias("total"),
    )
    n = F.col("total")
    return (
        per_group.groupBy("feature", "grouping")
        .agg(F.count(F.lit(1)).alias("groups"), F.max("total").alias("total"), F.sum(F.col("rs") * F.col("rs") / F.col("m")).alias("q"), F.sum("ties").alias("ties"))
        .where("groups > 1")
        .select(
            "feature", "grouping", "groups",
            F.try_divide(12 / (n * (n + 1)) * F.col("q") - 3 * (n + 1), 1 - F.col("ties") / (n * n * n - n)).alias("h"),
        )
    )


def levene(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Brown-Forsythe W between the classes: F of the distances to the class median."""
    freq = frequencies(_by_class(df, columns, target), ["_y"])
    med = quantiles_of(freq, [0.5], ["_y"]).select("feature", "_y", "quantile")
    # Two medians per column on the broadcast side.
    d = freq.join(F.broadcast(med), ["feature", "_y"]).withColumn("d", F.abs(F.col("value") - F.col("quantile")))
    n, x = F.col("n").cast("double"), F.col("d")
    s = d.groupBy("feature", "_y").agg(
        F.sum(n).alias("n"), (F.sum(n * x) / F.sum(n)).alias("mean"), F.sum(n * x * x).alias("sq")
    )
    stats = s.select("feature", F.lit("class").alias("grouping"), F.col("_y").alias("grp"), "n", "mean", (F.col("sq") - F.col("n") * F.col("mean") * F.col("mean")).alias("m2"))
    parts = _anova_parts(stats)
    return parts.select("feature", F.col("n").cast("long").alias("n"), _f(parts).alias("w"))


def tukey(df: DataFrame, columns: Sequence[str], groupings: Sequence[str], alpha: float | None = 0.05) -> DataFrame:
    """Pairwise studentized ranges after a significant F (all pairs with alpha=None).

    The self-join is over group statistics, one row per group.
    """
    stats = _crossed(df, columns, groupings)
    parts = _anova_parts(stats).where("groups > 1")
    parts = parts.withColumn("mse", F.col("ssw") / (F.col("n") - F.col("groups"))).withColumn("f", _f(parts))
    if alpha is not None:
        parts = parts.where(f_p("f", (F.col("groups") - 1).cast("double"), (F.col("n") - F.col("groups")).cast("double")) < alpha)
    keys = ["feature", "grouping"]
    sides = [stats.select(*keys, F.col("grp").alias(f"group{i}"), F.col("mean").alias(f"m{i}"), F.col("n").alias(f"k{i}")) for i in (1, 2)]
    both = sides[0].join(sides[1], keys).where("group1 < group2").join(
        parts.select(*keys, "groups", "mse", (F.col("n") - F.col("groups")).alias("dof")), keys
    )
    error = F.sqrt(F.col("mse") / 2 * (1 / F.col("k1") + 1 / F.col("k2")))
    return both.select(
        *keys, "group1", "group2", (F.col("m2") - F.col("m1")).alias("mean_difference"),
        F.try_divide(F.abs(F.col("m2") - F.col("m1")), error).alias("q"), "groups", "dof",
    )


def normality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """D'Agostino-Pearson K2 with its exact chi-square(2) tail."""
    m = melt(df, columns).groupBy("feature").agg(
        F.count("value").cast("double").alias("n"), F.skewness("value").alias("b1"), (F.kurtosis("value") + 3).alias("b2")
    )
    n, b1, b2 = F.col("n"), F.col("b1"), F.col("b2")
    y = b1 * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta - 1)) - 1
    u = y / F.sqrt(2 / (w2 - 1))
    z_skew = F.log(u + F.sqrt(u * u + 1)) / F.sqrt(0.5 * F.log(w2))
    spread = F.sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5)))
    x = (b2 - 3 * (n - 1) / (n + 1)) / spread
    root = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / root * (2 / root + F.sqrt(1 + 4 / (root * root)))
    part = (1 - 2 / a) / (1 + x * F.sqrt(2 / (a - 4)))
    z_kurt = (1 - 2 / (9 * a) - F.signum(part) * F.pow(F.abs(part), F.lit(1 / 3))) / F.sqrt(2 / (9 * a))
    k2 = z_skew * z_skew + z_kurt * z_kurt
    return m.select("feature", F.col("n").cast("long").alias("n"), z_skew.alias("z_skew"), z_kurt.alias("z_kurt"), k2.alias("k2"), F.exp(-k2 / 2).alias("p_value"))


def ks_normal(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distance of each column, scaled to its own mean and deviation, from the normal law."""
    long = melt(df, columns)
    shape = long.groupBy("feature").agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s"))
    # One row per column on the broadcast side.
    r = ranked(frequencies(long)).join(F.broadcast(shape), "feature")
    z = F.when(F.col("s") > 0, (F.col("value") - F.col("m")) / F.col("s")).otherwise(F.col("value"))
    r = r.withColumn("c", normal_cdf_column(z))
    n = F.col("n_total")
    d = F.greatest((F.col("n_before") + F.col("n_tie")) / n - F.col("c"), F.col("c") - F.col("n_before") / n)
    out = r.groupBy("feature").agg(F.max("n_total").alias("n"), F.max(d).alias("d"))
    return out.withColumn("p_value", ks_p(F.col("d") * F.sqrt("n")))


def with_p(table: DataFrame, test: str, alpha: float = 0.05) -> DataFrame:
    """Adds p_value and the significance flag to a result table of this module."""
    double = {c: F.col(c).cast("double") for c in table.columns}
    p = {
        "mann_whitney": lambda: normal_p("z"),
        "welch": lambda: t_p("welch_t", "welch_df"),
        "anova": lambda: f_p("f", double["groups"] - 1, double["n"] - double["groups"]),
        "kruskal": lambda: chi2_p("h", double["groups"] - 1),
        "levene": lambda: f_p("w", F.lit(1.0), double["n"] - 2),
        "tukey": lambda: tukey_p("q", double["groups"], double["dof"]),
    }[test]()
    return table.withColumn("p_value", p).withColumn("significant", F.col("p_value") < alpha)

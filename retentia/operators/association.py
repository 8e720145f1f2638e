"""Correlation and contingency statistics from distributed sufficient statistics."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.functions.expr import named
from retentia.functions.pvalues import chi2_p, t_p
from retentia.operators.profile import contingency
from retentia.operators.ranks import average_rank, frequencies, melt, ranked
from retentia.session import cut_lineage


def _pair_rows(one: DataFrame, pairs, name: str) -> DataFrame:
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{i}").alias(name)) for i, (a, b) in enumerate(pairs)
    ]
    return one.select(F.inline(F.array(*cells)))


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) for every column pair, rows null in either left out; one pass."""
    pairs = list(combinations(columns, 2))
    one = df.agg(*[F.corr(named(a).cast("double"), named(b).cast("double")).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    return _pair_rows(one, pairs, "r")


HOT_SHARE = 200


def spearman(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """(a, b, rho) for every pair, ranked among the rows where both columns are present.

    Distinct values carry one weight per partner column (rows where the partner is present too),
    so one ranking gives the ranks of a column against every partner.
    """
    columns = list(columns)
    present = [named(c).isNotNull().cast("long").alias(f"w{j}") for j, c in enumerate(columns)]
    long = melt(df, columns, [named(key).alias("_key"), *present])
    weights = [f"w{j}" for j in range(len(columns))]
    freq = frequencies(long.drop("_key"), weights={w: F.col(w) for w in weights})
    # A value that holds more than 1/HOT_SHARE of a column's rows would be a hot join key. There are at most
    # HOT_SHARE of those per column and weight, so their ranks are broadcast; the other values join by shuffle.
    heavy = F.greatest(*[F.coalesce(F.col(f"{w}_tie") * HOT_SHARE > F.col(f"{w}_total"), F.lit(False)) for w in weights])
    ranks = cut_lineage(ranked(freq, weights=weights).select("feature", "value", heavy.alias("_heavy"), F.array(*[average_rank(w) for w in weights]).alias("ranks")))
    cells = long.select("_key", "feature", "value").join(F.broadcast(ranks.where("_heavy").drop("_heavy")), ["feature", "value"], "left")
    cold = cells.where("ranks IS NULL").drop("ranks").join(ranks.where("NOT _heavy").drop("_heavy"), ["feature", "value"])
    looked = cells.where("ranks IS NOT NULL").unionByName(cold)
    wide = looked.groupBy("_key").agg(
        *[F.max(F.when(F.col("feature") == c, F.col("ranks"))).alias(f"r{i}") for i, c in enumerate(columns)]
    )
    pairs = list(combinations(range(len(columns)), 2))
    one = wide.agg(*[F.corr(F.col(f"r{i}")[j], F.col(f"r{j}")[i]).alias(f"p{n}") for n, (i, j) in enumerate(pairs)])
    return _pair_rows(one, [(columns[i], columns[j]) for i, j in pairs], "rho")


def spearman_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(feature, spearman_r) against a 0/1 target, from class counts per distinct value alone."""
    y = named(target).cast("double")
    long = melt(df, columns, [y.alias("_y")]).where(F.col("_y").isNotNull())
    freq = frequencies(long, weights={"n": F.lit(1), "pos": F.col("_y")})
    rank, n, pos = average_rank(), F.col("n"), F.col("pos")
    # A two-valued target's ranks are a linear map of the target: correlate with it directly.
    s = ranked(freq).groupBy("feature").agg(
        F.sum(n).alias("n"), F.sum(pos).alias("p"), F.sum(n * rank).alias("sx"),
        F.sum(n * rank * rank).alias("sxx"), F.sum(pos * rank).alias("sxy"),
    )
    num = F.col("n") * F.col("sxy") - F.col("sx") * F.col("p")
    den = F.sqrt(F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")) * F.sqrt(F.col("p") * (F.col("n") - F.col("p")))
    return s.select("feature", F.try_divide(num, den).alias("spearman_r"))


def target_correlation(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Pearson r and its t statistic against the target, strongest first, with Spearman beside it."""
    both = [F.struct(F.corr(named(c), named(target)).alias("r"), F.count_if(named(c).isNotNull() & named(target).isNotNull()).alias("n")).alias(f"c{i}") for i, c in enumerate(columns)]
    one = df.agg(*both)
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"c{i}")["r"].alias("pearson_r"), F.col(f"c{i}")["n"].alias("n")) for i, c in enumerate(columns)]
    r = F.col("pearson_r")
    return (
        one.select(F.inline(F.array(*rows)))
        .withColumn("t", r * F.sqrt(F.try_divide(F.col("n") - 2, 1 - r * r)))
        .join(spearman_target(df, columns, target), "feature", "left")
        .orderBy(F.abs("pearson_r").desc(), "feature")
    )


def with_correlation_p(table: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Adds two-sided p of Pearson and Spearman and the significance flag."""
    rho = F.col("spearman_r")
    t_s = rho * F.sqrt(F.try_divide(F.col("n") - 2, 1 - rho * rho))
    return (
        table.withColumn("pearson_p", t_p("t", (F.col("n") - 2).cast("double")))
        .withColumn("spearman_p", t_p(t_s, (F.col("n") - 2).cast("double")))
        .withColumn("significant", F.col("pearson_p") < alpha)
    )


def chi_square(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Independence statistic per column pair, continuity-corrected for 2x2 tables, and Cramer's V.

    Works on observed cells only: sum (o-e)^2/e = n (sum o^2/(row col) - 1), and in a 2x2 table
    all four |o-e| are equal, so the correction follows from the margins.
    """
    cells = contingency(df, pairs)
    key = ["left", "right"]
    rows = cells.groupBy(*key, "a").agg(F.sum("n").alias("rn"))
    cols = cells.groupBy(*key, "b").agg(F.sum("n").alias("cn"))

    def margin(t, n, prefix):
        return t.groupBy(*key).agg(
            F.count(F.lit(1)).alias(f"{prefix}"), F.min(n).cast("double").alias(f"{prefix}_lo"), F.max(n).cast("double").alias(f"{prefix}_hi")
        )

    body = (
        cells.join(rows, [*key, "a"]).join(cols, [*key, "b"]).groupBy(*key)
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n").cast("double") * F.col("n") / (F.col("rn").cast("double") * F.col("cn"))).alias("s"),
        )
    )
    t = body.join(margin(rows, "rn", "r"), key).join(margin(cols, "cn", "c"), key)
    n = F.col("n").cast("double")
    plain = n * F.greatest(F.col("s") - 1, F.lit(0.0))
    inverse = n * n * n / (F.col("r_lo") * F.col("r_hi") * F.col("c_lo") * F.col("c_hi"))
    shift = F.greatest(F.sqrt(plain / inverse) - 0.5, F.lit(0.0))
    dof = (F.col("r") - 1) * (F.col("c") - 1)
    k = F.least("r", "c") - 1
    chi2 = F.when(dof == 1, shift * shift * inverse).otherwise(plain)
    return t.select(*key, "n", dof.alias("dof"), chi2.alias("chi2"), k.alias("_k")).select(
        *key, "n", "dof", "chi2", F.when(F.col("_k") > 0, F.sqrt(F.col("chi2") / (F.col("n") * F.col("_k")))).otherwise(0.0).alias("cramers_v")
    )


def with_chi_square_p(table: DataFrame, alpha: float = 0.05) -> DataFrame:
    p = F.when(F.col("dof") > 0, chi2_p("chi2", F.col("dof").cast("double"))).otherwise(1.0)
    return table.withColumn("p_value", p).withColumn("significant", F.col("p_value") < alpha)


def all_pairs(columns: Sequence[str]) -> list[tuple[str, str]]:
    return list(combinations(columns, 2))


def leakage_screen(df: DataFrame, columns: Sequence[str], target: str, threshold: float = 0.5) -> DataFrame:
    """Features whose correlation with the target is suspiciously strong."""
    return pearson_target(df, columns, target).where(F.abs("r") > threshold)


def pearson_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    one = df.agg(*[F.corr(named(c).cast("double"), named(target).cast("double")).alias(f"p{i}") for i, c in enumerate(columns)])
    return _pair_rows(one, [(c, target) for c in columns], "r").select(F.col("a").alias("feature"), "r")

"""Closed forms, brute force on small data, and properties."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from retentia.functions import pvalues as pv
from retentia.operators import association as a
from retentia.operators import drift as d
from retentia.operators import hypothesis as h
from retentia.operators import metrics as m
from retentia.operators import sampling as s
from retentia.operators.knn import nearest
from retentia.operators.ranks import average_rank, frequencies, melt, numbered, quantile_map, quantiles, ranked
from retentia.operators.smote import smote
from retentia.operators.stages import DataImputer, modes
from retentia.plans.churn_base import KEY, NUMERIC, TARGET


@pytest.mark.parametrize(
    "got,want",
    [
        (pv.chi2_tail(3.841458820694124, 1), 0.05),
        (pv.chi2_tail(18.307038053275146, 10), 0.05),
        (pv.t_two_sided(2.2281388519649385, 10), 0.05),
        (pv.t_two_sided(12.706204736432095, 1), 0.05),
        (pv.f_tail(4.9646027437307145, 1, 10), 0.05),
        (pv.f_tail(3.3258345304130112, 5, 10), 0.05),
        (pv.normal_two_sided(1.959963984540054), 0.05),
        (pv.kolmogorov_tail(1.3580986393225505), 0.05),
        (pv.normal_cdf(0.0), 0.5),
        (pv.chi2_tail(0.0, 3), 1.0),
    ],
)
def test_critical_values(got, want):
    assert got == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("q,k,dof", [(3.877, 3, 10), (3.578, 3, 20), (4.654, 5, 10), (3.314, 3, 10**6), (2.772, 2, 10**6)])
def test_studentized_range(q, k, dof):
    assert pv.studentized_range_tail(q, k, dof) == pytest.approx(0.05, abs=3e-4)


def frame(spark, values, name="x"):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], f"id long, {name} double")


@pytest.mark.parametrize("buckets", [2, 5, 64, 300])
def test_ranks_do_not_depend_on_buckets(spark, buckets):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.lognormal(size=300).round(1), np.full(200, 2.0)])
    r = ranked(frequencies(melt(frame(spark, x), ["x"])), buckets=buckets).select("value", average_rank().alias("r"))
    got = {row.value: row.r for row in r.collect()}
    for v in np.unique(x):
        assert got[v] == (x < v).sum() + ((x == v).sum() + 1) / 2


@pytest.mark.parametrize("values", [[5.0], [1.0, 2.0], [3.0] * 40, list(range(101)), [0.5, 0.5, 9.0, -4.0]])
def test_quantiles_both_ways(spark, values):
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    df = frame(spark, values)
    want = np.quantile(np.array(values, dtype=float), probs)
    distributed = {r.prob: r.quantile for r in quantiles(df, ["x"], probs).collect()}
    assert [distributed[p] for p in probs] == pytest.approx(list(want))
    assert list(quantile_map(df, ["x"], probs)["x"].values()) == pytest.approx(list(want))


def test_quantiles_ignore_nulls_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (float("nan"),)], "x double")
    assert quantiles(df, ["x"], [0.5]).first()["quantile"] == 2.0


def test_sketch_quantiles(base):
    got = {r.prob: r["quantile"] for r in quantiles(base, ["Balance"], [0.25, 0.5], accuracy=10000).collect()}
    want = quantile_map(base, ["Balance"], [0.25, 0.5])["Balance"]
    assert all(abs(got[p] - want[p]) < 100 for p in got)


def test_numbering_is_complete(base):
    n = base.count()
    out = numbered(base, [KEY]).select("rn").agg(F.min("rn"), F.max("rn"), F.count_distinct("rn")).first()
    assert tuple(out) == (1, n, n)


def test_numbering_under_skewed_keys(spark):
    """Keys bunched together still get gapless numbers."""
    df = spark.range(3000).select((F.col("id") + F.when(F.col("id") > 1000, 10**9).otherwise(0)).alias("k"))
    rows = numbered(df, ["k"]).orderBy("k").collect()
    assert [r.rn for r in rows] == list(range(1, 3001))


def test_imputer_learns_what_the_builtins_find(base):
    specs = [
        {"column": "CreditScore", "strategy": "median_by_group", "group_by": "Geography"},
        {"column": "Age", "strategy": "median"}, {"column": "NumOfProducts", "strategy": "mode"},
        {"column": "CardType", "strategy": "mode"}, {"column": "Balance", "strategy": "constant", "fill_value": 0},
    ]
    model = DataImputer(specs).fit(base)
    fill = {e["column"]: e["fill"] for e in model.value}
    want = base.agg(
        F.percentile("CreditScore", 0.5).alias("CreditScore"), F.percentile("Age", 0.5).alias("Age"),
        F.mode("NumOfProducts", True).cast("double").alias("NumOfProducts"), F.mode("CardType", True).alias("CardType"),
    ).first()
    assert fill["CardType"] == want.CardType and fill["Balance"] == 0
    assert [fill[c] for c in ("CreditScore", "Age", "NumOfProducts")] == pytest.approx([want.CreditScore, want.Age, want.NumOfProducts])
    groups = {r.Geography: r.m for r in base.where("CreditScore IS NOT NULL").groupBy("Geography").agg(F.percentile("CreditScore", 0.5).alias("m")).collect()}
    learned = {r["Geography"]: r["CreditScore"] for r in model.tables["Geography"].collect()}
    assert set(learned) == set(groups) and all(learned[g] == pytest.approx(m) for g, m in groups.items())


def test_mode_takes_smallest_on_ties(spark):
    df = spark.createDataFrame([(3, "b"), (1, "a"), (3, "a"), (1, "b"), (None, None)], "n int, s string")
    assert modes(df, ["n", "s"]) == {"n": 1.0, "s": "a"}


def test_fallback_when_statistic_is_null(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "x double, g int")
    out = DataImputer([{"column": "x", "strategy": "median", "fallback_value": 37}]).fit(df).transform(df)
    assert [r.x for r in out.collect()] == [37.0, 37.0]


def test_group_without_values_uses_overall_median(spark):
    df = spark.createDataFrame([(1.0, "a"), (3.0, "a"), (None, "b"), (None, None)], "x double, g string")
    model = DataImputer([{"column": "x", "strategy": "median_by_group", "group_column": "g"}]).fit(df)
    assert [r.x for r in model.transform(df).collect()] == [1.0, 3.0, 2.0, 2.0]


def test_spearman_under_hot_values(spark):
    """A value in most rows takes the salted join; the result is that of plain ranks."""
    rng = np.random.default_rng(3)
    x = np.where(rng.random(4000) < 0.8, 0.0, rng.normal(size=4000).round(2))
    y = x + rng.normal(size=4000).round(1)
    df = spark.createDataFrame([(i, float(p), float(q)) for i, (p, q) in enumerate(zip(x, y))], "id long, x double, y double")

    def rank(v):
        return np.array([(v < t).sum() + ((v == t).sum() + 1) / 2 for t in v])

    want = np.corrcoef(rank(x), rank(y))[0, 1]
    assert a.spearman(df, ["x", "y"], "id").first().rho == pytest.approx(want, abs=1e-12)


def test_identical_samples_do_not_drift(base):
    twice = base.withColumn("ref", F.lit(1)).unionByName(base.withColumn("ref", F.lit(0)))
    assert all(r.ks_stat == 0 for r in d.ks_two_sample(twice, NUMERIC, F.col("ref")).collect())
    assert d.psi(twice, "Balance", F.col("ref") == 1).first().psi == pytest.approx(0, abs=1e-12)


def test_psi_open_ends(spark):
    rows = [(float(i), True) for i in range(100)] + [(float(i + 50), False) for i in range(100)]
    df = spark.createDataFrame(rows, "x double, e boolean")
    closed = d.psi(df, "x", F.col("e")).first().psi
    opened = d.psi(df, "x", F.col("e"), open_ends=True).first().psi
    assert closed != opened and opened > 0


def test_auc_invariant_under_monotone_map(base):
    scored = base.withColumn("p", F.round(((F.col(KEY) * 7919) % 10007) / 10007.0, 2)).withColumn("q", F.exp("p") * 3)
    one, two = m.ranking_metrics(scored, TARGET, "p").first(), m.ranking_metrics(scored, TARGET, "q").first()
    assert one.roc_auc == pytest.approx(two.roc_auc) and one.avg_precision == pytest.approx(two.avg_precision)


def test_perfect_scores(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)], "y int, p double")
    row = m.classification_metrics(df, "y", "p", 0.5).first()
    assert (row.roc_auc, row.f1, row.avg_precision) == (1.0, 1.0, 1.0)


def test_threshold_sweep_counts(base):
    scored = base.withColumn("p", F.round(((F.col(KEY) * 7919) % 10007) / 10007.0, 2)).select(TARGET, "p")
    rows = scored.collect()
    for r in m.threshold_sweep(scored, TARGET, "p").collect():
        assert r.tp == sum(x.p >= r.threshold and x[TARGET] == 1 for x in rows)
        assert r.fn == sum(x.p < r.threshold and x[TARGET] == 1 for x in rows)


def test_tukey_of_two_groups_is_t(spark):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=30), rng.normal(1.5, 1, size=20)
    rows = [(float(v), "a") for v in x] + [(float(v), "b") for v in y]
    row = h.with_p(h.tukey(spark.createDataFrame(rows, "v double, g string"), ["v"], ["g"]), "tukey").first()
    pooled = (x.var(ddof=1) * 29 + y.var(ddof=1) * 19) / 48
    t = (y.mean() - x.mean()) / np.sqrt(pooled * (1 / 30 + 1 / 20))
    assert row.q == pytest.approx(abs(t) * np.sqrt(2))
    assert row.p_value == pytest.approx(pv.t_two_sided(t, 48), abs=1e-6)


def test_ks_normal_brute_force(spark):
    x = np.random.default_rng(7).gamma(2, size=400).round(2)
    z = np.sort((x - x.mean()) / x.std(ddof=1))
    c = np.array([pv.normal_cdf(v) for v in z])
    want = max((np.arange(1, 401) / 400 - c).max(), (c - np.arange(400) / 400).max())
    assert h.ks_normal(frame(spark, x), ["x"]).first().d == pytest.approx(want)


def test_split_keeps_class_shares(base):
    split = s.stratified_split(base, KEY, TARGET)
    rows = {(r.split, r[TARGET]): r["count"] for r in split.groupBy("split", TARGET).count().collect()}
    n = base.count()
    held = sum(v for (side, _), v in rows.items() if side == "holdout")
    assert held == -(-n // 5)
    for c in (0, 1):
        total = rows[("holdout", c)] + rows[("train", c)]
        assert abs(rows[("holdout", c)] - total * held / n) < 1


def test_folds_differ_by_one_row(base):
    counts = s.stratified_folds(base, KEY, TARGET).groupBy(TARGET, "fold").count().collect()
    for c in (0, 1):
        sizes = [r["count"] for r in counts if r[TARGET] == c]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_split_does_not_depend_on_partitioning(base):
    one = {r[0] for r in s.stratified_split(base.repartition(1), KEY, TARGET).where("split = 'holdout'").select(KEY).collect()}
    many = {r[0] for r in s.stratified_split(base.repartition(13), KEY, TARGET).where("split = 'holdout'").select(KEY).collect()}
    assert one == many


def cloud():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 4)).round(1)
    x[150:320] = x[5]  # a third of the rows are copies of one point
    return x


@pytest.mark.parametrize("block_rows", [4096, 40])
def test_nearest_is_exact(spark, block_rows):
    x = cloud()
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, x array<double>")
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(dist, np.inf)
    want = np.sort(dist, axis=1)[:, :5]
    got = {}
    for r in nearest(df, 5, block_rows).collect():
        assert r.id != r.nn and r.d == pytest.approx(dist[r.id, r.nn])
        got.setdefault(r.id, {})[r["rank"]] = r.d
    for i in range(len(x)):
        assert [got[i][k] for k in range(1, 6)] == pytest.approx(list(want[i]))


def test_smote_balances_between_neighbours(spark):
    x = cloud()
    df = spark.createDataFrame([(i, Vectors.dense(r), int(i % 4 == 0)) for i, r in enumerate(x)], ["id", "f", "y"])
    rows = smote(df, "id", "f", "y", block_rows=40).collect()
    made = np.array([r.features.toArray() for r in rows if r.synthetic])
    assert sum(r.y == 1 for r in rows) == sum(r.y == 0 for r in rows)
    minority = x[::4]
    assert (made >= minority.min(0) - 1e-9).all() and (made <= minority.max(0) + 1e-9).all()
    # Each lies on a segment between a minority row and one of its five nearest.
    dist = np.sqrt(((minority[:, None] - minority[None]) ** 2).sum(-1))
    np.fill_diagonal(dist, np.inf)
    reach = np.sort(dist, axis=1)[:, 4]
    for p in made:
        best = np.inf
        for i, base_point in enumerate(minority):
            ends = minority[dist[i] <= reach[i] + 1e-9] - base_point
            length = (ends * ends).sum(1)
            u = np.clip(np.divide(((p - base_point) * ends).sum(1), length, out=np.zeros(len(ends)), where=length > 0), 0, 1)
            best = min(best, np.sqrt((((p - base_point) - u[:, None] * ends) ** 2).sum(1)).min())
        assert best < 1e-9


def test_smote_is_repeatable(spark):
    x = cloud()
    df = spark.createDataFrame([(i, Vectors.dense(r), int(i % 5 == 0)) for i, r in enumerate(x)], ["id", "f", "y"])
    one = sorted(str(r) for r in smote(df, "id", "f", "y").collect())
    two = sorted(str(r) for r in smote(df.repartition(7), "id", "f", "y").collect())
    assert one == two


def test_smote_needs_enough_rows(spark):
    df = spark.createDataFrame([(i, Vectors.dense([float(i)]), int(i < 3)) for i in range(20)], ["id", "f", "y"])
    with pytest.raises(ValueError):
        smote(df, "id", "f", "y", k=5)

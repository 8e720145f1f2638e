"""Correlation, contingency, group tests and drift."""

from pyspark.sql import functions as F

from retentia.operators import association as a
from retentia.operators import drift as d
from retentia.operators import hypothesis as h
from retentia.operators.profile import target_rate_by_group
from retentia.operators.ranks import average_rank, frequencies, melt, ranked
from retentia.plans.churn_base import BINARY, CATEGORICAL, DISCRETE, KEY, NUMERIC, TARGET, churn_base, table
from retentia.queries.profiling import rounded, union
from retentia.queries.registry import ORACLES, QUERIES, query

NODES = 4000


def beta_sql(a: str, b: str, x: str) -> str:
    """Regularised incomplete beta by Simpson's rule over the angle whose squared sine is the variable."""
    angle = f"(i * asin(sqrt({x})) / {NODES})"
    weight = f"(CASE WHEN i = 0 OR i = {NODES} THEN 1 ELSE 2 + 2 * (i % 2) END)"
    logs = f"(2 * ({a}) - 1) * ln(greatest(sin({angle}), 1e-300)) + (2 * ({b}) - 1) * ln(greatest(cos({angle}), 1e-300))"
    term = f"{weight} * exp({logs} + lgamma(({a}) + ({b})) - lgamma({a}) - lgamma({b}))"
    return f"""CASE WHEN {x} >= 1 THEN 1.0 WHEN {x} <= 0 THEN 0.0
      ELSE 2 * asin(sqrt({x})) / {NODES} / 3 * list_sum(list_transform(range(0, {NODES} + 1), lambda i: {term})) END"""


def t_sql(t: str, dof: str) -> str:
    return beta_sql(f"({dof}) / 2.0", "0.5", f"(({dof}) / (({dof}) + ({t}) * ({t})))")


def f_sql(f: str, d1: str, d2: str) -> str:
    return f"CASE WHEN {f} <= 0 THEN 1.0 ELSE {beta_sql(f'({d2}) / 2.0', f'({d1}) / 2.0', f'(({d2}) / (({d2}) + ({d1}) * ({f})))')} END"


def chi2_sql(x: str, dof: str) -> str:
    """One minus the series of the lower incomplete gamma function."""
    term = f"exp(-({x}) / 2 + (({dof}) / 2.0 + i) * ln(({x}) / 2) - lgamma(({dof}) / 2.0 + i + 1))"
    return f"CASE WHEN {x} <= 0 THEN 1.0 WHEN {x} > 1400 THEN 0.0 ELSE greatest(0.0, 1 - list_sum(list_transform(range(0, {NODES}), lambda i: {term}))) END"


def normal_sql(z: str) -> str:
    """Two-sided normal tail, as the chi-square tail of the square."""
    return chi2_sql(f"({z}) * ({z})", "1")


def p_query(name: str, source: str, test: str, keys: list[str], sql: str):
    """Register `name`: p of the (rounded) table of query `source`, under SQL that finds the tail another way."""
    text = f"SELECT {', '.join(f'"{k}"' for k in keys)}, round(p, 6) AS p_value, p < 0.05 AS significant FROM (SELECT *, {sql} AS p FROM ({ORACLES[source]}) s) u"

    @query(name, text, on_base=False)
    def _(spark, sf):
        return rounded(h.with_p(QUERIES[source](spark, sf), test).select(*keys, "p_value", "significant"))


ALL = NUMERIC + BINARY
FEATURES = [c for c in ALL if c != TARGET]
PAIRS = a.all_pairs(ALL)
GROUPINGS = ["Geography", "Gender", "CardType", "NumOfProducts", "Tenure"]


def rank_sql(c, where="TRUE"):
    return f"""SELECT *, rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS rk,
      count(*) OVER (PARTITION BY {c}) AS t FROM churn_base WHERE {c} IS NOT NULL AND {where}"""


@query(
    "ranked_frequency",
    union(
        f"""SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS "value", count(*) AS n, CAST(any_value(rk) AS DOUBLE) AS avg_rank,
        CAST(any_value(rk) + (count(*) - 1) / 2.0 AS BIGINT) AS upto FROM ({rank_sql(c)}) GROUP BY {c}"""
        for c in ("Age", "Balance", "Tenure")
    ),
)
def _(spark, sf):
    r = ranked(frequencies(melt(churn_base(spark, sf), ["Age", "Balance", "Tenure"])))
    return r.select("feature", "value", "n", average_rank().alias("avg_rank"), (F.col("n_before") + F.col("n_tie")).alias("upto"))


@query(
    "pearson_matrix",
    "w AS (SELECT " + ", ".join(f'corr({x}, {y}) AS "{x}|{y}"' for x, y in PAIRS) + """ FROM churn_base)
    SELECT split_part(k, '|', 1) AS a, split_part(k, '|', 2) AS b, round(r, 6) AS r FROM (UNPIVOT w ON COLUMNS(*) INTO NAME k VALUE r)""",
)
def _(spark, sf):
    return rounded(a.pearson(churn_base(spark, sf), ALL))


@query(
    "spearman_matrix",
    union(
        f"""SELECT '{x}' AS a, '{y}' AS b, round(corr(rx, ry), 6) AS rho FROM (SELECT
        rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0 AS rx,
        rank() OVER (ORDER BY {y}) + (count(*) OVER (PARTITION BY {y}) - 1) / 2.0 AS ry
        FROM churn_base WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"""
        for x, y in PAIRS
    ),
)
def _(spark, sf):
    return rounded(a.spearman(churn_base(spark, sf), ALL, KEY))


@query(
    "target_correlation",
    union(
        f"""SELECT '{c}' AS feature, round(r, 6) AS pearson_r, n, round(r * sqrt((n - 2) / (1 - r * r)), 6) AS t, round(s, 6) AS spearman_r
        FROM (SELECT corr({c}, Exited) AS r, count({c}) AS n, corr(rk, Exited) AS s FROM ({rank_sql(c)}))"""
        for c in FEATURES
    ),
)
def _(spark, sf):
    return rounded(a.target_correlation(churn_base(spark, sf), FEATURES, TARGET))


RHO_T = "spearman_r * sqrt((n - 2) / (1 - spearman_r * spearman_r))"


@query(
    "target_correlation_p",
    f"""SELECT feature, round(p, 6) AS pearson_p, round(ps, 6) AS spearman_p, p < 0.05 AS significant
    FROM (SELECT *, {t_sql('t', 'n - 2.0')} AS p, {t_sql(f'({RHO_T})', 'n - 2.0')} AS ps FROM ({ORACLES['target_correlation']}) s) u""",
    on_base=False,
)
def _(spark, sf):
    return rounded(a.with_correlation_p(QUERIES["target_correlation"](spark, sf)).select("feature", "pearson_p", "spearman_p", "significant"))


@query(
    "top_correlations",
    union(f"SELECT '{c}' AS feature, round(corr({c}, Exited), 6) AS r FROM churn_base" for c in FEATURES)
    .replace("SELECT", "x AS (SELECT", 1)
    + ") SELECT * FROM x ORDER BY abs(r) DESC LIMIT 5",
)
def _(spark, sf):
    r = rounded(a.pearson_target(churn_base(spark, sf), FEATURES, TARGET))
    return r.orderBy(F.abs("r").desc(), "feature").limit(5)


# Features whose values are few enough for a rate each; a suspect outside them comes without rates.
SUSPECT_GROUPS = [c for c in FEATURES if c in BINARY or c in DISCRETE]


@query(
    "leakage_screen",
    f"""x AS ({union(f"SELECT '{c}' AS feature, round(corr({c}, Exited), 6) AS r FROM churn_base" for c in FEATURES)}),
    y AS ({union(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS v, round(avg(Exited) * 100, 6) AS rate_pct FROM churn_base WHERE {c} IS NOT NULL GROUP BY 2" for c in SUSPECT_GROUPS)})
    SELECT x.feature, x.r, y.v AS "value", y.rate_pct FROM x LEFT JOIN y ON y.feature = x.feature WHERE abs(r) > 0.5""",
)
def _(spark, sf):
    b = churn_base(spark, sf)
    suspects = a.leakage_screen(b, FEATURES, TARGET)
    rates = target_rate_by_group(b, SUSPECT_GROUPS, TARGET).withColumnRenamed("column", "feature")
    return rounded(suspects.join(rates, "feature", "left").select("feature", "r", "value", "rate_pct"))


def chi_sql(x, y):
    """Dense cells with the 2x2 correction, an independent way to the statistic."""
    return f"""SELECT '{x}' AS "left", '{y}' AS "right", n, dof, round(chi2, 6) AS chi2, round(sqrt(chi2 / (n * k)), 6) AS cramers_v FROM (
      SELECT CAST(any_value(n) AS BIGINT) AS n, CAST(any_value(dof) AS BIGINT) AS dof, any_value(k) AS k,
        sum(pow(greatest(abs(o - e) - CASE WHEN dof = 1 THEN 0.5 ELSE 0 END, 0), 2) / e) AS chi2
      FROM (SELECT coalesce(c.o, 0) AS o, rn * cn / t.n AS e, t.n, (t.nr - 1) * (t.nc - 1) AS dof, least(t.nr, t.nc) - 1 AS k
        FROM (SELECT {x} AS a, CAST(count(*) AS DOUBLE) AS rn FROM churn_base WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY 1) r
        CROSS JOIN (SELECT {y} AS b, CAST(count(*) AS DOUBLE) AS cn FROM churn_base WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY 1) s
        CROSS JOIN (SELECT CAST(count(*) AS DOUBLE) AS n, count(DISTINCT {x}) AS nr, count(DISTINCT {y}) AS nc FROM churn_base WHERE {x} IS NOT NULL AND {y} IS NOT NULL) t
        LEFT JOIN (SELECT {x} AS a, {y} AS b, count(*) AS o FROM churn_base GROUP BY 1, 2) c ON c.a = r.a AND c.b = s.b))"""


CHI_TARGET = [(c, TARGET) for c in CATEGORICAL]
CHI_ALL = a.all_pairs(CATEGORICAL + BINARY)


@query("chi_square_target", union(chi_sql(*p) for p in CHI_TARGET))
def _(spark, sf):
    return rounded(a.chi_square(churn_base(spark, sf), CHI_TARGET))


@query("chi_square_all_pairs", union(chi_sql(*p) for p in CHI_ALL))
def _(spark, sf):
    return rounded(a.chi_square(churn_base(spark, sf), CHI_ALL))


@query(
    "chi_square_p",
    f"""SELECT "left", "right", round(p, 6) AS p_value, p < 0.05 AS significant
    FROM (SELECT *, CASE WHEN dof > 0 THEN {chi2_sql('chi2', 'dof')} ELSE 1.0 END AS p FROM ({ORACLES['chi_square_all_pairs']}) s) u""",
    on_base=False,
)
def _(spark, sf):
    return rounded(a.with_chi_square_p(QUERIES["chi_square_all_pairs"](spark, sf)).select("left", "right", "p_value", "significant"))


@query(
    "mann_whitney",
    union(
        f"""SELECT '{c}' AS feature, CAST(n1 AS BIGINT) AS n1, CAST(n - n1 AS BIGINT) AS n0, round(u, 4) AS u,
        round((greatest(u, n1 * (n - n1) - u) - n1 * (n - n1) / 2.0 - 0.5)
          / sqrt(n1 * (n - n1) / 12.0 * (n + 1 - ties / (n * (n - 1)))), 6) AS z
        FROM (SELECT count(*) AS n, sum(Exited) AS n1, sum(rk) FILTER (Exited = 1) - sum(Exited) * (sum(Exited) + 1) / 2.0 AS u,
          CAST(sum(t * t - 1) AS DOUBLE) AS ties FROM ({rank_sql(c)}))"""
        for c in NUMERIC
    ),
)
def _(spark, sf):
    return rounded(h.mann_whitney(churn_base(spark, sf), NUMERIC, TARGET), 6, u=4)


p_query("mann_whitney_p", "mann_whitney", "mann_whitney", ["feature"], normal_sql("z"))


@query(
    "group_comparison",
    union(
        f"""SELECT '{c}' AS feature, n1, round(m1, 4) AS mean1, round(q1, 4) AS median1, round(s1, 4) AS std1,
        n0, round(m0, 4) AS mean0, round(q0, 4) AS median0, round(s0, 4) AS std0, round(m1 - m0, 4) AS mean_difference,
        round((m1 - m0) / sqrt(s1 * s1 / n1 + s0 * s0 / n0), 6) AS welch_t,
        round(pow(s1 * s1 / n1 + s0 * s0 / n0, 2) / (pow(s1 * s1 / n1, 2) / (n1 - 1) + pow(s0 * s0 / n0, 2) / (n0 - 1)), 4) AS welch_df,
        round((m1 - m0) / sqrt((s1 * s1 + s0 * s0) / 2), 6) AS cohens_d
        FROM (SELECT count({c}) FILTER (Exited = 1) AS n1, avg({c}) FILTER (Exited = 1) AS m1, stddev_samp({c}) FILTER (Exited = 1) AS s1,
          quantile_cont({c}, 0.5) FILTER (Exited = 1) AS q1, count({c}) FILTER (Exited = 0) AS n0, avg({c}) FILTER (Exited = 0) AS m0,
          stddev_samp({c}) FILTER (Exited = 0) AS s0, quantile_cont({c}, 0.5) FILTER (Exited = 0) AS q0 FROM churn_base)"""
        for c in NUMERIC
    ),
)
def _(spark, sf):
    return rounded(h.group_comparison(churn_base(spark, sf), NUMERIC, TARGET), 4, welch_t=6, cohens_d=6)


p_query("welch_p", "group_comparison", "welch", ["feature"], t_sql("welch_t", "welch_df"))


def anova_parts_sql(c, g):
    return f"""(SELECT count(*) AS k, CAST(sum(n) AS BIGINT) AS n, sum(n * pow(m - gm, 2)) AS ssb, sum(v) AS ssw FROM (
      SELECT count({c}) AS n, avg({c}) AS m, var_pop({c}) * count({c}) AS v, any_value(gm) AS gm
      FROM (SELECT *, avg({c}) OVER () AS gm FROM churn_base WHERE {c} IS NOT NULL AND {g} IS NOT NULL) GROUP BY {g}))"""


@query(
    "anova",
    union(
        f"""SELECT '{c}' AS feature, '{g}' AS grouping, k AS groups, n, round((ssb / (k - 1)) / (ssw / (n - k)), 6) AS f FROM {anova_parts_sql(c, g)}"""
        for c in NUMERIC
        for g in GROUPINGS
        if c != g
    ),
)
def _(spark, sf):
    out = h.anova(churn_base(spark, sf), NUMERIC, GROUPINGS).where("feature <> grouping")
    return rounded(out)


p_query("anova_p", "anova", "anova", ["feature", "grouping"], f_sql("f", "(groups - 1.0)", "(n - groups + 0.0)"))


@query(
    "kruskal_wallis",
    union(
        f"""SELECT '{c}' AS feature, '{g}' AS grouping, k AS groups,
        round((12.0 / (n * (n + 1)) * q - 3 * (n + 1)) / (1 - ties / (n * n * n - n)), 6) AS h
        FROM (SELECT count(*) AS k, CAST(sum(m) AS DOUBLE) AS n, sum(rs * rs / m) AS q, CAST(sum(ties) AS DOUBLE) AS ties
          FROM (SELECT count(*) AS m, sum(rk) AS rs, sum(t * t - 1) AS ties FROM ({rank_sql(c, g + " IS NOT NULL")}) GROUP BY {g}))"""
        for c in NUMERIC
        for g in GROUPINGS
        if c != g
    ),
)
def _(spark, sf):
    return rounded(h.kruskal(churn_base(spark, sf), NUMERIC, GROUPINGS).where("feature <> grouping"))


p_query("kruskal_wallis_p", "kruskal_wallis", "kruskal", ["feature", "grouping"], chi2_sql("h", "(groups - 1)"))


TUKEY = [("Balance", "Geography"), ("EstimatedSalary", "NumOfProducts"), ("CreditScore", "CardType")]


def tukey_sql(pairs, g1="x.g", g2="y.g"):
    return union(
        f"""SELECT '{c}' AS feature, '{g}' AS grouping, CAST(x.g AS VARCHAR) AS group1, CAST(y.g AS VARCHAR) AS group2,
        round(y.m - x.m, 4) AS mean_difference, round(abs(y.m - x.m) / sqrt(ssw / (p.n - k) / 2 * (1.0 / x.n + 1.0 / y.n)), 6) AS q,
        k AS groups, p.n - k AS dof
        FROM (SELECT {g} AS g, avg({c}) AS m, count({c}) AS n FROM churn_base WHERE {c} IS NOT NULL AND {g} IS NOT NULL GROUP BY 1) x
        JOIN (SELECT {g} AS g, avg({c}) AS m, count({c}) AS n FROM churn_base WHERE {c} IS NOT NULL AND {g} IS NOT NULL GROUP BY 1) y ON {g1} < {g2},
        {anova_parts_sql(c, g)} p"""
        for c, g in pairs
    )


@query("tukey_hsd", tukey_sql(TUKEY))
def _(spark, sf):
    b = churn_base(spark, sf)
    every = h.tukey(b, [c for c, _ in TUKEY], [g for _, g in TUKEY], alpha=None)
    wanted = " OR ".join(f"(feature = '{c}' AND grouping = '{g}')" for c, g in TUKEY)
    return rounded(every.where(wanted), 6, mean_difference=4)


# Every pair of groups of every column and grouping; groups are in the order of their names.
@query("tukey_hsd_all", tukey_sql([(c, g) for c in NUMERIC for g in GROUPINGS if c != g], "CAST(x.g AS VARCHAR)", "CAST(y.g AS VARCHAR)"))
def _(spark, sf):
    return rounded(h.tukey(churn_base(spark, sf), NUMERIC, GROUPINGS, alpha=None).where("feature <> grouping"), 6, mean_difference=4)


@query("tukey_hsd_significant")
def _(spark, sf):
    return h.with_p(h.tukey(churn_base(spark, sf), NUMERIC, GROUPINGS).where("feature <> grouping"), "tukey")


@query(
    "levene",
    union(
        f"""SELECT '{c}' AS feature, CAST(sum(n) AS BIGINT) AS n, round(sum(n * pow(m - gm, 2)) / (sum(v) / (sum(n) - 2)), 6) AS w FROM (
          SELECT count(*) AS n, avg(d) AS m, var_pop(d) * count(*) AS v, any_value(gm) AS gm FROM (
            SELECT Exited, d, avg(d) OVER () AS gm FROM (SELECT Exited, abs({c} - median({c}) OVER (PARTITION BY Exited)) AS d
              FROM churn_base WHERE {c} IS NOT NULL)) GROUP BY Exited)"""
        for c in NUMERIC
    ),
)
def _(spark, sf):
    return rounded(h.levene(churn_base(spark, sf), NUMERIC, TARGET))


p_query("levene_p", "levene", "levene", ["feature"], f_sql("w", "1.0", "(n - 2.0)"))


ETA = ["Geography", "Gender", "CardType", "NumOfProducts"]


@query(
    "eta_squared",
    union(
        f"""SELECT '{c}' AS feature, '{g}' AS grouping, round(ssb / (ssb + ssw), 6) AS eta_squared, CASE WHEN ssb / (ssb + ssw) >= 0.14 THEN 'large'
        WHEN ssb / (ssb + ssw) >= 0.06 THEN 'medium' WHEN ssb / (ssb + ssw) >= 0.01 THEN 'small' ELSE 'negligible' END AS effect
        FROM {anova_parts_sql(c, g)}"""
        for c in NUMERIC
        for g in ETA
        if c != g
    ),
)
def _(spark, sf):
    return rounded(h.eta_squared(churn_base(spark, sf), NUMERIC, ETA).where("feature <> grouping"))


NORMAL_SQL = """m AS ({moments}),
s1 AS (SELECT *, b1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
  3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS beta,
  6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb,
  (b2 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x FROM m),
s2 AS (SELECT *, sqrt(2 * (beta - 1)) - 1 AS w2, 6 + 8 / sb * (2 / sb + sqrt(1 + 4 / (sb * sb))) AS aa FROM s1),
s3 AS (SELECT *, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(w2)) AS zs,
  (1 - 2 / (9 * aa) - cbrt((1 - 2 / aa) / (1 + x * sqrt(2 / (aa - 4))))) / sqrt(2 / (9 * aa)) AS zk FROM s2)
SELECT feature, CAST(n AS BIGINT) AS n, round(zs, 6) AS z_skew, round(zk, 6) AS z_kurt, round(zs * zs + zk * zk, 4) AS k2,
  round(exp(-(zs * zs + zk * zk) / 2), 6) AS p_value FROM s3""".format(
    moments=union(
        f"""SELECT '{c}' AS feature, CAST(count({c}) AS DOUBLE) AS n, kurtosis_pop({c}) + 3 AS b2,
        skewness({c}) * (CAST(count({c}) AS DOUBLE) - 2) / sqrt(CAST(count({c}) AS DOUBLE) * (count({c}) - 1)) AS b1 FROM churn_base"""
        for c in NUMERIC
    )
)


@query("normality", NORMAL_SQL)
def _(spark, sf):
    return rounded(h.normality(churn_base(spark, sf), NUMERIC), 6, k2=4)


# The normal distribution function from the series of its lower tail, summed in SQL.
NORMAL_SERIES = """CASE WHEN abs(z) > 8 THEN (CASE WHEN z > 0 THEN 1.0 ELSE 0.0 END)
  ELSE 0.5 + z * list_sum(list_transform(range(0, 120), lambda i: exp(-z * z / 2 + i * ln(greatest(z * z, 1e-300)) - i * ln(2.0) - lgamma(i + 1.5)))) / 2 / sqrt(2.0) END"""
KOLMOGOROV = "CASE WHEN x < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * list_sum(list_transform(range(1, 101), lambda k: (2 * (k % 2) - 1) * exp(-2.0 * k * k * x * x))))) END"


@query(
    "ks_normal",
    "k AS ("
    + union(
        f"""SELECT '{c}' AS feature, CAST(any_value(n) AS BIGINT) AS n, max(greatest(upto / n - f, f - (upto - tie) / n)) AS d FROM (
          SELECT *, {NORMAL_SERIES} AS f FROM (
            SELECT DISTINCT (v - m) / s AS z, CAST(n AS DOUBLE) AS n, CAST(count(*) OVER (ORDER BY v) AS DOUBLE) AS upto, CAST(count(*) OVER (PARTITION BY v) AS DOUBLE) AS tie
            FROM (SELECT {c} AS v, avg({c}) OVER () AS m, stddev_samp({c}) OVER () AS s, count(*) OVER () AS n FROM churn_base WHERE {c} IS NOT NULL)))"""
        for c in NUMERIC
    )
    + f") SELECT feature, n, round(d, 6) AS d, round({KOLMOGOROV.replace('x', '(d * sqrt(n))').replace('e(d * sqrt(n))p', 'exp')}, 6) AS p_value FROM k",
)
def _(spark, sf):
    return rounded(h.ks_normal(churn_base(spark, sf), NUMERIC))


KS_SQL = """SELECT '{c}' AS feature, CAST(any_value(na) AS BIGINT) AS n_reference, CAST(any_value(nb) AS BIGINT) AS n_production,
  round(max(abs(ca / na - cb / nb)), 6) AS ks_stat FROM (
    SELECT CAST(sum(r) OVER w AS DOUBLE) AS ca, CAST(sum(1 - r) OVER w AS DOUBLE) AS cb, CAST(sum(r) OVER () AS DOUBLE) AS na, CAST(sum(1 - r) OVER () AS DOUBLE) AS nb
    FROM (SELECT {c} AS v, {ref} AS r FROM {src} WHERE {c} IS NOT NULL) WINDOW w AS (ORDER BY v))"""


@query("ks_drift", union(KS_SQL.format(c=c, ref="CustomerId % 2", src="churn_base") for c in NUMERIC))
def _(spark, sf):
    return rounded(d.ks_two_sample(churn_base(spark, sf), NUMERIC, F.col(KEY) % 2))


PRICES = """prices AS (SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 1 ELSE 0 END AS r,
  CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN o_totalprice ELSE o_totalprice * 1.1 END AS price FROM orders)"""


def prices(spark, sf):
    old = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    return table(spark, sf, "orders").select(
        old.alias("old"), F.when(old, F.col("o_totalprice")).otherwise(F.col("o_totalprice") * 1.1).alias("price")
    )


@query("ks_drift_orders", PRICES + " " + KS_SQL.format(c="price", ref="r", src="prices"))
def _(spark, sf):
    return rounded(d.ks_two_sample(prices(spark, sf), ["price"], F.col("old")))


def ks_p_sql(n, m, stat):
    x = f"({stat} * sqrt(CAST({n} AS DOUBLE) * {m} / ({n} + {m})))"
    return f"least(1.0, greatest(0.0, 2 * list_sum([CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2 * k * k * {x} * {x}) FOR k IN range(1, 101)])))"


@query(
    "ks_drift_flags",
    "x AS (" + union(KS_SQL.format(c=c, ref="CustomerId % 2", src="churn_base").replace("round(max(abs(ca / na - cb / nb)), 6)", "max(abs(ca / na - cb / nb))") for c in NUMERIC)
    + f"""), y AS (SELECT *, CAST({ks_p_sql('n_reference', 'n_production', 'ks_stat')} AS DOUBLE) AS p FROM x)
    SELECT feature, n_reference, n_production, round(ks_stat, 6) AS ks_stat, round(p, 6) AS p_value, p < 0.05 AS drift FROM y""",
)
def _(spark, sf):
    return rounded(d.with_drift_flag(d.ks_two_sample(churn_base(spark, sf), NUMERIC, F.col(KEY) % 2)))


def psi_sql(src, c, ref):
    qs = ", ".join(f"quantile_cont({c}, {i / 10}) FILTER ({ref} = 1)" for i in range(11))
    return f"""ed AS (SELECT DISTINCT unnest([{qs}]) AS e FROM {src}),
    bins AS (SELECT row_number() OVER (ORDER BY e) - 1 AS bin, e AS lo, lead(e) OVER (ORDER BY e) AS hi, max(e) OVER () AS top FROM ed),
    cells AS (SELECT bins.bin, {ref} AS r FROM {src} JOIN bins ON hi IS NOT NULL AND {c} >= lo AND ({c} < hi OR (hi = top AND {c} = hi))),
    shares AS (SELECT bins.bin, coalesce(nullif(count(*) FILTER (r = 1), 0) / (SELECT count(*) FROM {src} WHERE {ref} = 1), 1e-6) AS e,
      coalesce(nullif(count(*) FILTER (r = 0), 0) / (SELECT count(*) FROM {src} WHERE {ref} = 0), 1e-6) AS a
      FROM bins LEFT JOIN cells USING (bin) WHERE hi IS NOT NULL GROUP BY 1)"""


@query(
    "psi_bins",
    PRICES + ", " + psi_sql("prices", "price", "r") + """
    SELECT CAST(bin AS INT) AS bin, round(e, 6) AS expected_pct, round(a, 6) AS actual_pct, round((a - e) * ln(a / e), 6) AS psi FROM shares""",
)
def _(spark, sf):
    x = prices(spark, sf)
    edges = d.psi_edges(x.where("old"), "price")
    return rounded(d.psi_table(x, "price", F.col("old"), edges))


STATUS = "CASE WHEN psi > 0.20 THEN 'severe' WHEN psi > 0.10 THEN 'moderate' ELSE 'stable' END AS status"


@query(
    "psi",
    PRICES + ", " + psi_sql("prices", "price", "r") + f" SELECT round(psi, 6) AS psi, {STATUS} FROM (SELECT sum((a - e) * ln(a / e)) AS psi FROM shares)",
)
def _(spark, sf):
    return rounded(d.psi(prices(spark, sf), "price", F.col("old")))


@query(
    "psi_discrete",
    psi_sql("churn_base", "Tenure", "(CustomerId % 2)") + f" SELECT round(psi, 6) AS psi, {STATUS} FROM (SELECT sum((a - e) * ln(a / e)) AS psi FROM shares)",
)
def _(spark, sf):
    return rounded(d.psi(churn_base(spark, sf), "Tenure", F.col(KEY) % 2 == 1))

"""Profiles, target rates, distributions and figure data."""

from pyspark.sql import functions as F

from retentia.operators import plotdata as pd_
from retentia.operators import profile as p
from retentia.operators.features import add_bins
from retentia.operators.ranks import melt, quantiles
from retentia.plans.churn_base import (
    BINARY, CATEGORICAL, COLUMNS, CONTINUOUS, DISCRETE, ID_COLUMNS, NUMERIC, TARGET, churn_base,
)
from retentia.plans.preprocessing import BASE_AGE_BINS, BASE_PLAN, REGIONS
from retentia.queries.features import AGE_CODE_SQL, FEATURES_SQL
from retentia.queries.registry import query

PERCENTILES = [0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]
RATE_COLUMNS = ["Geography", "Gender", "NumOfProducts", "CardType", "Tenure", "SatisfactionScore"]


def union(parts):
    return "\nUNION ALL ".join(parts)


def rounded(df, digits=6, **special):
    return df.select(
        [
            F.round(c, special.get(c, digits)).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )


RATES_SQL = union(
    f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS "value", CAST(sum(Exited) AS BIGINT) AS positives, count(*) AS total,
    round(avg(Exited) * 100, 6) AS rate_pct FROM churn_base WHERE {c} IS NOT NULL GROUP BY {c}"""
    for c in RATE_COLUMNS
)


@query("target_rate_by_group", RATES_SQL)
def _(spark, sf):
    return rounded(p.target_rate_by_group(churn_base(spark, sf), RATE_COLUMNS, TARGET))


ROLES = {"id": ID_COLUMNS, "target": [TARGET], "continuous": CONTINUOUS, "discrete": DISCRETE,
         "binary": [b for b in BINARY if b != TARGET], "categorical": CATEGORICAL}
TYPES = {"CustomerId": "bigint", **{c: "string" for c in ("Surname", *CATEGORICAL)},
         **{c: "double" for c in ("CreditScore", "Balance", "EstimatedSalary")}}
ROLE_OF = {c: r for r, cs in ROLES.items() for c in cs}


@query(
    "overview",
    "v AS (SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{c}', '{TYPES.get(c, 'int')}', '{ROLE_OF[c]}')" for i, c in enumerate(COLUMNS))
    + """) t(position, "column", dtype, role)) SELECT v.*, (SELECT count(*) FROM churn_base) AS n_rows FROM v""",
)
def _(spark, sf):
    return p.overview(churn_base(spark, sf), ROLES)


@query(
    "missing_profile",
    union(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing_count,
        round((count(*) - count({c})) / count(*) * 100, 6) AS missing_pct, count(*) > count({c}) AS has_missing FROM churn_base"""
        for c in COLUMNS
    ),
)
def _(spark, sf):
    return rounded(p.missing_profile(churn_base(spark, sf)))


NULLS = " + ".join(f"count(*) - count({c})" for c in COLUMNS)


@query(
    "missing_total",
    f"""SELECT {NULLS} AS total_missing_cells, count(*) * {len(COLUMNS)} AS total_cells,
    round(({NULLS}) / (count(*) * {len(COLUMNS)}) * 100, 6) AS overall_missing_pct FROM churn_base""",
)
def _(spark, sf):
    return rounded(p.missing_total(churn_base(spark, sf)))


DUP = ["Geography", "Gender", "Tenure", "NumOfProducts", "Exited"]


@query(
    "duplicates",
    f"""SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT CustomerId, {', '.join(DUP)} FROM churn_base)) AS BIGINT) AS exact_duplicates,
    CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(DUP)} FROM churn_base)) AS BIGINT) AS feature_duplicates,
    count(DISTINCT CustomerId) AS unique_ids FROM churn_base""",
)
def _(spark, sf):
    return p.duplicates(churn_base(spark, sf).select("CustomerId", *DUP), ID_COLUMNS, "CustomerId")


def describe_sql(c):
    return f"""SELECT '{c}' AS feature, count({c}) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
    CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max",
    round(skewness({c}), 6) AS skewness, round(kurtosis({c}), 6) AS kurtosis FROM churn_base"""


@query("describe_numeric", union(describe_sql(c).replace("CAST(min", "round(CAST(min").replace("DOUBLE) AS \"min\"", "DOUBLE), 4) AS \"min\"").replace("CAST(max", "round(CAST(max").replace("DOUBLE) AS \"max\"", "DOUBLE), 4) AS \"max\"") for c in NUMERIC))
def _(spark, sf):
    return rounded(p.describe(churn_base(spark, sf), NUMERIC), 4, skewness=6, kurtosis=6)


@query(
    "percentiles",
    union(
        f"SELECT '{c}' AS feature, CAST({q} AS DOUBLE) AS prob, round(quantile_cont({c}, {q}), 4) AS quantile FROM churn_base"
        for c in NUMERIC
        for q in PERCENTILES
    ),
)
def _(spark, sf):
    return rounded(quantiles(churn_base(spark, sf), NUMERIC, PERCENTILES), 4)


@query(
    "iqr_outliers",
    union(
        f"""SELECT '{c}' AS feature, round(any_value(q3 - q1), 6) AS iqr, round(any_value(q1 - 1.5 * (q3 - q1)), 6) AS fence_lo,
        round(any_value(q3 + 1.5 * (q3 - q1)), 6) AS fence_hi,
        count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers,
        round(count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) / count({c}) * 100, 6) AS outliers_pct
        FROM churn_base, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM churn_base)"""
        for c in NUMERIC
    ),
)
def _(spark, sf):
    return rounded(p.iqr_outliers(churn_base(spark, sf), NUMERIC))


@query(
    "zscore_outliers",
    union(
        f"""SELECT '{c}' AS feature, count(*) FILTER (abs({c} - m) > 3 * s) AS outliers
        FROM churn_base, (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM churn_base)"""
        for c in NUMERIC
    ),
)
def _(spark, sf):
    return p.zscore_outliers(churn_base(spark, sf), NUMERIC)


CATS = CATEGORICAL + BINARY


@query(
    "categorical_counts",
    union(
        f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS "value", count(*) AS n,
        round(count(*) / (SELECT count({c}) FROM churn_base) * 100, 6) AS pct FROM churn_base WHERE {c} IS NOT NULL GROUP BY {c}"""
        for c in CATS
    ),
)
def _(spark, sf):
    return rounded(p.value_counts(churn_base(spark, sf), CATS))


@query(
    "entropy",
    union(
        f"""SELECT '{c}' AS "column", count(*) AS unique_count, round(-sum(s * log2(s)), 6) AS entropy_bits
        FROM (SELECT count(*) / (SELECT count({c}) FROM churn_base) AS s FROM churn_base WHERE {c} IS NOT NULL GROUP BY {c})"""
        for c in CATS
    ),
)
def _(spark, sf):
    return rounded(p.entropy(churn_base(spark, sf), CATS))


@query(
    "target_summary",
    """SELECT count(*) AS n_total, count(*) FILTER (Exited = 1) AS n_positive, count(*) FILTER (Exited = 0) AS n_negative,
    round(avg(Exited) * 100, 6) AS rate_pct, round((1 - avg(Exited)) * 100, 6) AS retention_pct,
    round(count(*) FILTER (Exited = 0) / count(*) FILTER (Exited = 1), 6) AS imbalance_ratio FROM churn_base""",
)
def _(spark, sf):
    return rounded(p.target_summary(churn_base(spark, sf), TARGET))


DERIVED = ["HasZeroBalance", "HighRiskProducts", "AgeGroup", "Gender_encoded", "EngagementScore"]


@query(
    "target_rate_by_derived",
    FEATURES_SQL
    + union(
        f"""{' ' if i == 0 else ''}SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS "value", CAST(sum(Exited) AS BIGINT) AS positives,
        count(*) AS total, round(avg(Exited) * 100, 6) AS rate_pct FROM features WHERE {c} IS NOT NULL GROUP BY {c}"""
        for i, c in enumerate(DERIVED)
    ),
)
def _(spark, sf):
    return rounded(p.target_rate_by_group(BASE_PLAN.transform(churn_base(spark, sf)), DERIVED, TARGET))


@query(
    "value_distribution",
    FEATURES_SQL + """ SELECT 'AgeGroup' AS "column", CAST(AgeGroup AS VARCHAR) AS "value", count(*) AS n
    FROM features WHERE AgeGroup IS NOT NULL GROUP BY 2""",
)
def _(spark, sf):
    return p.label_counts(BASE_PLAN.transform(churn_base(spark, sf)), ["AgeGroup"])


@query(
    "one_hot_sums",
    FEATURES_SQL + " " + union(f"""SELECT 'geo_{r}' AS "column", CAST(sum("geo_{r}") AS BIGINT) AS ones FROM features""" for r in REGIONS),
)
def _(spark, sf):
    features = BASE_PLAN.transform(churn_base(spark, sf))
    return p.per_column(features, [f"geo_{r}" for r in REGIONS], lambda c: [F.sum(f"`{c}`").alias("ones")])


CT = [("CardType", "Exited"), ("SatisfactionScore", "Exited"), ("Geography", "Gender")]
CT_SQL = union(
    f"""SELECT '{a}' AS "left", '{b}' AS "right", CAST({a} AS VARCHAR) AS a, CAST({b} AS VARCHAR) AS b, count(*) AS n
    FROM churn_base WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY {a}, {b}"""
    for a, b in CT
)


@query("contingency", CT_SQL)
def _(spark, sf):
    return p.contingency(churn_base(spark, sf), CT)


@query(
    "contingency_row_pct",
    f"""c AS ({CT_SQL}) SELECT *, round(n / sum(n) OVER (PARTITION BY "left", "right", a) * 100, 6) AS pct FROM c""",
)
def _(spark, sf):
    return rounded(p.row_percent(p.contingency(churn_base(spark, sf), CT), ["left", "right", "a"]))


QUARTILE_SQL = """CASE WHEN {c} < e0 THEN NULL WHEN {c} <= e1 THEN 0 WHEN {c} <= e2 THEN 1 WHEN {c} <= e3 THEN 2 WHEN {c} <= e4 THEN 3 END"""
EDGES_SQL = "(SELECT " + ", ".join(f"quantile_cont({{c}}, {i / 4}) AS e{i}" for i in range(5)) + " FROM churn_base)"


@query(
    "quantile_bins",
    f"""SELECT CustomerId, {QUARTILE_SQL.format(c='Balance')} AS Balance_bin FROM churn_base, {EDGES_SQL.format(c='Balance')}""",
)
def _(spark, sf):
    return p.quantile_bins(churn_base(spark, sf), "Balance").select("CustomerId", "Balance_bin")


@query(
    "quantile_bins_merged",
    """e AS (SELECT DISTINCT unnest([quantile_cont(Tenure, 0.0), quantile_cont(Tenure, 0.25), quantile_cont(Tenure, 0.5),
      quantile_cont(Tenure, 0.75), quantile_cont(Tenure, 1.0)]) AS edge FROM churn_base)
    SELECT CustomerId, CASE WHEN Tenure IS NOT NULL THEN CAST(greatest((SELECT count(*) FROM e WHERE edge < Tenure) - 1, 0) AS INT) END
    AS Tenure_bin FROM churn_base""",
)
def _(spark, sf):
    return p.quantile_bins(churn_base(spark, sf), "Tenure").select("CustomerId", "Tenure_bin")


@query(
    "interaction_numeric_category",
    f"""SELECT CAST({QUARTILE_SQL.format(c='EstimatedSalary')} AS VARCHAR) AS a, Geography AS b, round(avg(Exited) * 100, 6) AS rate_pct
    FROM churn_base, {EDGES_SQL.format(c='EstimatedSalary')} WHERE EstimatedSalary IS NOT NULL GROUP BY 1, 2""",
)
def _(spark, sf):
    return rounded(p.rate_matrix(churn_base(spark, sf), "EstimatedSalary", "Geography", TARGET, NUMERIC))


@query(
    "interaction_category_category",
    "SELECT Geography AS a, CardType AS b, round(avg(Exited) * 100, 6) AS rate_pct FROM churn_base GROUP BY 1, 2",
)
def _(spark, sf):
    return rounded(p.rate_matrix(churn_base(spark, sf), "Geography", "CardType", TARGET, NUMERIC))


@query(
    "variance_ratio",
    union(
        f"""SELECT '{c}' AS feature, round(var_samp({c}) FILTER (Exited = 1) / var_samp({c}) FILTER (Exited = 0), 6) AS variance_ratio FROM churn_base"""
        for c in NUMERIC
    ),
)
def _(spark, sf):
    return rounded(p.variance_ratio(churn_base(spark, sf), NUMERIC, TARGET))


@query(
    "group_mean_lift",
    """m AS (SELECT Geography AS "group", avg(Balance) AS mean, count(Balance) AS n FROM churn_base GROUP BY 1)
    SELECT "group", round(mean, 4) AS mean, n, round((mean / (SELECT mean FROM m WHERE "group" = 'EUROPE') - 1) * 100, 4) AS lift_pct FROM m""",
)
def _(spark, sf):
    return rounded(p.group_lift(churn_base(spark, sf), "Balance", "Geography", "EUROPE"), 4)


@query(
    "cumulative_share",
    """g AS (SELECT CAST(Tenure AS DOUBLE) AS key, CAST(sum(Exited) AS BIGINT) AS positives, count(*) AS total FROM churn_base WHERE Tenure IS NOT NULL GROUP BY 1)
    SELECT *, round(sum(positives) OVER (ORDER BY key) / (SELECT sum(Exited) FROM churn_base) * 100, 6) AS cumulative_pct FROM g""",
)
def _(spark, sf):
    return rounded(p.cumulative_share(churn_base(spark, sf), "Tenure", TARGET))


def hist_sql(c, bins, by=()):
    keys = "".join(f"{b}, " for b in by)
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    return f"""SELECT '{c}' AS feature, {keys}bin, round(lo + bin * ((hi - lo) / {bins}), 6) AS bin_lo, count(*) AS n FROM (
      SELECT {keys}lo, hi, CAST(least(floor(({c} - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INT) AS bin FROM (
        SELECT *, CAST(min({c}) OVER ({part}) AS DOUBLE) AS lo, CAST(max({c}) OVER ({part}) AS DOUBLE) AS hi FROM {{src}} WHERE {c} IS NOT NULL))
    GROUP BY {keys}bin, lo, hi"""


@query("histogram", union(hist_sql(c, 40).format(src="churn_base") for c in ("CreditScore", "Age", "Balance", "EstimatedSalary")))
def _(spark, sf):
    return rounded(pd_.histogram(churn_base(spark, sf), ["CreditScore", "Age", "Balance", "EstimatedSalary"], 40))


@query("histogram_by_class", hist_sql("Balance", 40, ["Exited"]).format(src="(SELECT * FROM churn_base WHERE Balance > 0)"))
def _(spark, sf):
    return rounded(pd_.histogram(churn_base(spark, sf).where("Balance > 0"), ["Balance"], 40, ["Exited"]))


@query("histogram_by_geography", hist_sql("CreditScore", 30, ["Geography", "Exited"]).format(src="churn_base"))
def _(spark, sf):
    return rounded(pd_.histogram(churn_base(spark, sf), ["CreditScore"], 30, ["Geography", "Exited"]))


@query(
    "box_plot",
    union(
        f"""SELECT '{c}' AS feature, Exited, round(any_value(q1), 4) AS q1, round(any_value(q2), 4) AS median, round(any_value(q3), 4) AS q3,
        round(CAST(min({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS DOUBLE), 4) AS whisker_lo,
        round(CAST(max({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS DOUBLE), 4) AS whisker_hi,
        count(*) FILTER ({c} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS fliers
        FROM churn_base JOIN (SELECT Exited, quantile_cont({c}, 0.25) q1, quantile_cont({c}, 0.5) q2, quantile_cont({c}, 0.75) q3
          FROM churn_base GROUP BY 1) USING (Exited) WHERE {c} IS NOT NULL GROUP BY Exited"""
        for c in ("Age", "Balance", "CreditScore", "PointEarned")
    ),
)
def _(spark, sf):
    return rounded(pd_.box_plot(churn_base(spark, sf), ["Age", "Balance", "CreditScore", "PointEarned"], TARGET), 4)


@query(
    "density",
    """s AS (SELECT Exited, count(Age) AS n, stddev_samp(Age) * pow(count(Age), -0.2) AS h, min(Age) AS lo, max(Age) AS hi
      FROM churn_base WHERE Age IS NOT NULL GROUP BY Exited),
    g AS (SELECT s.*, CAST(i AS INT) AS point, lo - (hi - lo) / 2.0 + i * (hi - lo) * 2 / 99.0 AS x FROM s, range(100) r(i))
    SELECT g.Exited, point, round(any_value(x), 6) AS x,
      round(sum(exp(-pow((x - Age) / h, 2) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 10) AS density
    FROM g JOIN churn_base b ON b.Exited = g.Exited AND b.Age IS NOT NULL GROUP BY g.Exited, point""",
)
def _(spark, sf):
    return rounded(pd_.density(churn_base(spark, sf), "Age", TARGET, 100), 6, density=10)


@query(
    "three_way_share",
    """c AS (SELECT IsActiveMember, Complain, Exited, count(*) AS n FROM churn_base GROUP BY 1, 2, 3)
    SELECT *, round(n / sum(n) OVER (PARTITION BY IsActiveMember, Complain) * 100, 6) AS pct FROM c""",
)
def _(spark, sf):
    return rounded(pd_.three_way(churn_base(spark, sf), "IsActiveMember", "Complain", TARGET))


@query(
    "rate_by_age_bins",
    f"""SELECT 'AgeGroup' AS "column", CAST({AGE_CODE_SQL} AS VARCHAR) AS "value", CAST(sum(Exited) AS BIGINT) AS positives, count(*) AS total,
    round(avg(Exited) * 100, 6) AS rate_pct FROM churn_base WHERE Age IS NOT NULL GROUP BY 2""",
)
def _(spark, sf):
    return rounded(p.target_rate_by_group(add_bins(churn_base(spark, sf), BASE_AGE_BINS), ["AgeGroup"], TARGET))


@query(
    "zero_share",
    "SELECT round(avg(CASE WHEN Balance = 0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS zero_pct, count(*) AS n FROM churn_base",
)
def _(spark, sf):
    return rounded(
        churn_base(spark, sf).agg((F.avg((F.col("Balance") == 0).cast("int")) * 100).alias("zero_pct"), F.count(F.lit(1)).alias("n"))
    )


@query(
    "balance_by_class",
    "SELECT Exited, count(Balance) AS n, round(avg(Balance), 4) AS mean FROM churn_base GROUP BY Exited",
)
def _(spark, sf):
    long = melt(churn_base(spark, sf), ["Balance"], [TARGET])
    return rounded(long.groupBy(TARGET).agg(F.count("value").alias("n"), F.avg("value").alias("mean")), 4)

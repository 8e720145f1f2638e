"""Imputation and scaling, learned and applied."""

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from retentia.operators import stages as st
from retentia.plans.churn_base import churn_base
from retentia.plans.preprocessing import IMPUTATION, LOG_COLUMNS, ROBUST_COLUMNS, STANDARD_COLUMNS
from retentia.queries.registry import query


@query(
    "impute_median",
    """SELECT CustomerId, CAST(coalesce(Age, (SELECT quantile_cont(Age, 0.5) FROM churn_base)) AS DOUBLE) AS Age,
    round(coalesce(CreditScore, (SELECT quantile_cont(CreditScore, 0.5) FROM churn_base)), 6) AS CreditScore
    FROM churn_base""",
)
def _(spark, sf):
    b = churn_base(spark, sf)
    specs = [{"column": "Age", "strategy": "median"}, {"column": "CreditScore", "strategy": "median"}]
    out = st.DataImputer(specs).fit(b).transform(b)
    return out.select("CustomerId", "Age", F.round("CreditScore", 6).alias("CreditScore"))


@query("impute_constant", "SELECT CustomerId, CAST(coalesce(Tenure, 0) AS DOUBLE) AS Tenure FROM churn_base")
def _(spark, sf):
    b = churn_base(spark, sf)
    out = st.DataImputer([{"column": "Tenure", "strategy": "constant", "fill_value": 0}]).fit(b).transform(b)
    return out.select("CustomerId", "Tenure")


@query(
    "impute_mode",
    """gappy AS (SELECT CustomerId, NumOfProducts, CASE WHEN Balance = 0 THEN NULL ELSE CardType END AS CardType FROM churn_base)
    SELECT CustomerId, CAST(coalesce(NumOfProducts, (SELECT NumOfProducts FROM gappy WHERE NumOfProducts IS NOT NULL
      GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS DOUBLE) AS NumOfProducts,
    coalesce(CardType, (SELECT CardType FROM gappy WHERE CardType IS NOT NULL GROUP BY 1
      ORDER BY count(*) DESC, 1 LIMIT 1)) AS CardType FROM gappy""",
)
def _(spark, sf):
    b = churn_base(spark, sf).withColumn("CardType", F.when(F.col("Balance") != 0, F.col("CardType")))
    specs = [{"column": "NumOfProducts", "strategy": "mode"}, {"column": "CardType", "strategy": "mode"}]
    return st.DataImputer(specs).fit(b).transform(b).select("CustomerId", "NumOfProducts", "CardType")


GROUP_SQL = """m AS (SELECT Geography, quantile_cont(CreditScore, 0.5) AS med FROM churn_base GROUP BY Geography)
    SELECT CustomerId, round(coalesce(CreditScore, med, (SELECT quantile_cont(CreditScore, 0.5) FROM churn_base)), 6)
    AS CreditScore FROM churn_base LEFT JOIN m USING (Geography)"""


@query("impute_group_median", GROUP_SQL)
def _(spark, sf):
    b = churn_base(spark, sf)
    model = st.GroupMedianImputer({"group_col": "Geography", "target_col": "CreditScore"}).fit(b)
    return model.transform(b).select("CustomerId", F.round("CreditScore", 6).alias("CreditScore"))


@query("impute_group_median_join", GROUP_SQL)
def _(spark, sf):
    out = st.fill_group_median(churn_base(spark, sf), "CreditScore", "Geography")
    return out.select("CustomerId", F.round("CreditScore", 6).alias("CreditScore"))


@query(
    "impute_all",
    """m AS (SELECT Geography, quantile_cont(CreditScore, 0.5) AS med FROM churn_base GROUP BY Geography)
    SELECT CustomerId, round(coalesce(CreditScore, med, (SELECT quantile_cont(CreditScore, 0.5) FROM churn_base)), 6) AS CreditScore,
    CAST(coalesce(Age, (SELECT quantile_cont(Age, 0.5) FROM churn_base)) AS DOUBLE) AS Age, coalesce(Balance, 0.0) AS Balance,
    round(coalesce(EstimatedSalary, (SELECT quantile_cont(EstimatedSalary, 0.5) FROM churn_base)), 4) AS EstimatedSalary,
    CAST(coalesce(NumOfProducts, (SELECT NumOfProducts FROM churn_base WHERE NumOfProducts IS NOT NULL
      GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS DOUBLE) AS NumOfProducts,
    CAST(coalesce(Tenure, (SELECT quantile_cont(Tenure, 0.5) FROM churn_base)) AS DOUBLE) AS Tenure
    FROM churn_base LEFT JOIN m USING (Geography)""",
)
def _(spark, sf):
    b = churn_base(spark, sf)
    out = st.DataImputer([*IMPUTATION, {"column": "Nowhere", "strategy": "mode"}]).fit(b).transform(b)
    return out.select(
        "CustomerId", F.round("CreditScore", 6).alias("CreditScore"), "Age", "Balance",
        F.round("EstimatedSalary", 4).alias("EstimatedSalary"), "NumOfProducts", "Tenure",
    )


@query(
    "scale_standard",
    "SELECT CustomerId, "
    + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM churn_base)) / (SELECT stddev_samp({c}) FROM churn_base), 6) AS {c}"
        for c in STANDARD_COLUMNS
    )
    + " FROM churn_base",
)
def _(spark, sf):
    b = churn_base(spark, sf)
    out = st.StandardScalerTransformer(STANDARD_COLUMNS).fit(b).transform(b)
    return out.select("CustomerId", *[F.round(c, 6).alias(c) for c in STANDARD_COLUMNS])


@query(
    "scale_robust",
    """s AS (SELECT quantile_cont(ln(1 + Age), 0.5) AS am, quantile_cont(ln(1 + Age), 0.75) - quantile_cont(ln(1 + Age), 0.25) AS ai,
      quantile_cont(Balance, 0.5) AS bm, quantile_cont(Balance, 0.75) - quantile_cont(Balance, 0.25) AS bi FROM churn_base)
    SELECT CustomerId, round((ln(1 + Age) - am) / ai, 6) AS Age, round((Balance - bm) / bi, 6) AS Balance FROM churn_base, s""",
)
def _(spark, sf):
    b = churn_base(spark, sf)
    stage = st.RobustScalerTransformer({"columns": ROBUST_COLUMNS, "log_columns": LOG_COLUMNS})
    out = stage.fit(b).transform(b)
    return out.select("CustomerId", *[F.round(c, 6).alias(c) for c in ROBUST_COLUMNS])


@query(
    "scale_params",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std FROM churn_base"
        for c in STANDARD_COLUMNS
    ),
)
def _(spark, sf):
    out = st.standard_params(churn_base(spark, sf), STANDARD_COLUMNS)
    return out.select("feature", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


ROBUST_PARAMS_SQL = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(quantile_cont({x}, 0.5), 6) AS median,
    round(quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25), 6) AS iqr FROM churn_base"""
    for c, x in (("Age", "ln(1 + Age)"), ("Balance", "Balance"))
)


@query("scale_params_robust", ROBUST_PARAMS_SQL)
def _(spark, sf):
    b = churn_base(spark, sf).select(F.log1p("Age").alias("Age"), "Balance")
    q = st.quantiles(b, ROBUST_COLUMNS, [0.25, 0.5, 0.75])

    def at(p):
        return F.max(F.when(F.col("prob") == p, F.col("quantile")))

    return q.groupBy("feature").agg(
        F.round(at(0.5), 6).alias("median"), F.round(at(0.75) - at(0.25), 6).alias("iqr")
    )


@query(
    "population_zscores",
    "SELECT CustomerId, "
    + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM churn_base)) / (SELECT stddev_pop({c}) FROM churn_base), 6) AS {c}"
        for c in ("CreditScore", "Age", "Balance")
    )
    + " FROM churn_base",
)
def _(spark, sf):
    cols = ["CreditScore", "Age", "Balance"]
    out = st.population_zscores(churn_base(spark, sf), cols)
    return out.select("CustomerId", *[F.round(c, 6).alias(c) for c in cols])


@query(
    "prepared_pipeline",
    """m AS (SELECT median(Age) AS med FROM churn_base),
    filled AS (SELECT CustomerId, CAST(coalesce(Age, (SELECT med FROM m)) AS DOUBLE) AS Age FROM churn_base)
    SELECT CustomerId, round((Age - (SELECT avg(Age) FROM filled)) / (SELECT stddev_samp(Age) FROM filled), 6) AS Age FROM filled""",
)
def _(spark, sf):
    b = churn_base(spark, sf)
    chain = Pipeline(stages=[
        st.DataImputer([{"column": "Age", "strategy": "median"}]),
        st.StandardScalerTransformer(["Age"]),
        st.FeatureSelector(["CustomerId", "Age"]),
    ])
    return chain.fit(b).transform(b).withColumn("Age", F.round("Age", 6))

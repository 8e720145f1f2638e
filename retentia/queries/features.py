"""Projections, flags, ratios, bins, encodings, serving features and row rules."""

from pyspark.sql import functions as F

from retentia.functions.expr import effect_label
from retentia.operators import features as f
from retentia.plans.churn_base import COLUMNS, churn_base
from retentia.plans.preprocessing import (
    BASE_AGE_BINS, BASE_GENDER_MAP, BASE_PLAN, INTERACTIONS, RATIOS, REGIONS,
)
from retentia.queries.registry import query

KEPT = [c for c in COLUMNS if c not in ("Surname", "Complain")]
AGE_SQL = """CASE WHEN Age <= -1 THEN NULL WHEN Age <= 60 THEN {0} WHEN Age <= 120 THEN {1}
  WHEN Age <= 240 THEN {2} WHEN Age <= 480 THEN {3} WHEN Age <= 5000 THEN {4} END"""
AGE_CODE_SQL = AGE_SQL.format(0, 1, 2, 3, 4)
AGE_LABEL_SQL = AGE_SQL.format("'<60'", "'60-120'", "'120-240'", "'240-480'", "'480+'")
FLAG_SQL = """coalesce(CAST(Balance = 0 AS INT), 0) AS HasZeroBalance,
  coalesce(CAST(NumOfProducts >= 3 AS INT), 0) AS HighRiskProducts"""
ONE_HOT_SQL = ", ".join(
    f'coalesce(CAST(Geography = \'{r}\' AS INT), 0) AS "geo_{r}"' for r in REGIONS
)
GENDER_SQL = "CASE Gender WHEN 'RETAIL' THEN 0 WHEN 'CORPORATE' THEN 1 END AS Gender_encoded"
ENGAGE_SQL = """IsActiveMember + coalesce(CAST(NumOfProducts = 2 AS INT), 0) + HasCrCard
  - coalesce(CAST(Balance = 0 AS INT), 0)"""
RATIO_SQL = """CASE WHEN EstimatedSalary + 1 <> 0 THEN Balance / (EstimatedSalary + 1) END"""
FEATURES_SQL = f"""features AS (SELECT CustomerId, CreditScore, Age, Tenure, Balance, NumOfProducts,
  HasCrCard, IsActiveMember, EstimatedSalary, SatisfactionScore, PointEarned, {FLAG_SQL},
  Age * (1 - IsActiveMember) AS AgeInactivity, {ENGAGE_SQL} AS EngagementScore,
  {RATIO_SQL} AS BalanceSalaryRatio, {AGE_CODE_SQL} AS AgeGroup, {ONE_HOT_SQL}, {GENDER_SQL}, Exited
  FROM churn_base)"""


@query("drop_columns", f"SELECT {', '.join(KEPT)} FROM churn_base")
def _(spark, sf):
    return f.drop_columns(churn_base(spark, sf), ["RowNumber", "Surname", "Complain"])


@query("select_features", "SELECT CustomerId, Balance, Age, Exited FROM churn_base")
def _(spark, sf):
    return f.select_features(churn_base(spark, sf), ["CustomerId", "Balance", "Age", "NotThere", "Exited"])


@query(
    "binary_flags",
    f"""SELECT CustomerId, {FLAG_SQL}, coalesce(CAST(Age <= 100 AS INT), 0) AS RecentOrder
    FROM churn_base""",
)
def _(spark, sf):
    flags = (*f.DEFAULT_FLAGS, f.Flag("Age", "<=", 100, "RecentOrder"), f.Flag("Age", "!=", 1, "Skipped"))
    out = f.add_flags(churn_base(spark, sf), flags)
    return out.select("CustomerId", "HasZeroBalance", "HighRiskProducts", "RecentOrder")


@query("interaction_product_complement", "SELECT CustomerId, Age * (1 - IsActiveMember) AS AgeInactivity FROM churn_base")
def _(spark, sf):
    return f.add_interactions(churn_base(spark, sf), INTERACTIONS[:1]).select("CustomerId", "AgeInactivity")


@query("interaction_engagement", f"SELECT CustomerId, {ENGAGE_SQL} AS EngagementScore FROM churn_base")
def _(spark, sf):
    flagged = f.add_flags(churn_base(spark, sf))
    return f.add_interactions(flagged, INTERACTIONS[1:]).select("CustomerId", "EngagementScore")


@query(
    "ratio_features",
    f"""SELECT CustomerId, round({RATIO_SQL}, 8) AS BalanceSalaryRatio,
    CASE WHEN Tenure <> 0 THEN round(PointEarned / Tenure, 8) END AS OrdersPerYear FROM churn_base""",
)
def _(spark, sf):
    out = f.add_ratios(churn_base(spark, sf), (*RATIOS, f.Ratio("OrdersPerYear", "PointEarned", "Tenure")))
    return out.select(
        "CustomerId",
        F.round("BalanceSalaryRatio", 8).alias("BalanceSalaryRatio"),
        F.round("OrdersPerYear", 8).alias("OrdersPerYear"),
    )


@query("age_bins", f"SELECT CustomerId, Age, {AGE_CODE_SQL} AS AgeGroup, {AGE_LABEL_SQL} AS AgeLabel FROM churn_base")
def _(spark, sf):
    labelled = f.Bins("Age", "AgeLabel", BASE_AGE_BINS.edges, BASE_AGE_BINS.labels)
    out = f.add_bins(f.add_bins(churn_base(spark, sf), BASE_AGE_BINS), labelled)
    return out.select("CustomerId", "Age", "AgeGroup", "AgeLabel")


@query("one_hot", f"SELECT CustomerId, {ONE_HOT_SQL} FROM churn_base")
def _(spark, sf):
    spec = f.Encoding("Geography", "one_hot", "geo")
    rows = churn_base(spark, sf).select("CustomerId", "Geography")
    return f.encode(rows, f.learn_encodings(rows, [spec]))


@query(
    "one_hot_drop_first",
    """SELECT CustomerId, CAST(CardType = 'BUILDING' AS INT) AS card_BUILDING,
    CAST(CardType = 'FURNITURE' AS INT) AS card_FURNITURE,
    CAST(CardType = 'HOUSEHOLD' AS INT) AS card_HOUSEHOLD,
    CAST(CardType = 'MACHINERY' AS INT) AS card_MACHINERY FROM churn_base""",
)
def _(spark, sf):
    spec = f.Encoding("CardType", "one_hot", "card", drop_first=True)
    rows = churn_base(spark, sf).select("CustomerId", "CardType")
    return f.encode(rows, f.learn_encodings(rows, [spec]))


@query(
    "map_encode",
    f"""SELECT CustomerId, Gender, {GENDER_SQL},
    CASE CardType WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 END AS CardType_encoded FROM churn_base""",
)
def _(spark, sf):
    specs = [
        f.Encoding("Gender", "binary", mapping=BASE_GENDER_MAP, new_column="Gender_encoded"),
        f.Encoding("CardType", "label", mapping={"BUILDING": 1, "MACHINERY": 2}),
    ]
    out = f.encode(churn_base(spark, sf), specs)
    return out.select("CustomerId", "Gender", "Gender_encoded", "CardType_encoded")


def raw_serving(df):
    """Serving record fields from the snapshot."""
    return df.select(
        "CustomerId",
        F.col("CreditScore").alias("credit_score"), F.col("Age").alias("age"),
        F.col("Tenure").alias("tenure"), F.col("Balance").alias("balance"),
        F.col("NumOfProducts").alias("num_products"), (F.col("HasCrCard") == 1).alias("has_cr_card"),
        (F.col("IsActiveMember") == 1).alias("is_active"), F.col("EstimatedSalary").alias("salary"),
        F.col("Geography").alias("geography"), F.col("Gender").alias("gender"),
    )


SERVING_SQL = f"""serving AS (SELECT CustomerId, CreditScore, CAST(Age AS DOUBLE) AS Age,
  CAST(Tenure AS DOUBLE) AS Tenure, Balance, CAST(NumOfProducts AS DOUBLE) AS NumOfProducts,
  HasCrCard, IsActiveMember, EstimatedSalary,
  {", ".join(f'''coalesce(CAST(Geography = '{r}' AS INT), 0) AS "Geography_{r}"''' for r in REGIONS)},
  CAST(Gender = 'CORPORATE' AS INT) AS Gender_CORPORATE, CAST(Gender = 'RETAIL' AS INT) AS Gender_RETAIL,
  coalesce(CAST(Age >= 90 AND Age < 365 AS INT), 0) AS AgeGroup_Middle,
  coalesce(CAST(Age >= 365 AS INT), 0) AS AgeGroup_Senior, coalesce(CAST(Age < 90 AS INT), 0) AS AgeGroup_Young,
  CAST(Age * (1 - IsActiveMember) AS DOUBLE) AS AgeInactivity,
  CAST(IsActiveMember + HasCrCard + least(NumOfProducts, 2) - 1 AS DOUBLE) AS EngagementScore,
  CASE WHEN EstimatedSalary IS NULL THEN round(Balance, 4) ELSE round(Balance / greatest(EstimatedSalary, 1), 4) END
    AS BalanceSalaryRatio,
  CASE WHEN Tenure IS NULL THEN NULL ELSE round(NumOfProducts / greatest(Tenure, 1), 4) END AS ProductsPerYear
  FROM churn_base)"""


def serving(spark, sf):
    raw = raw_serving(churn_base(spark, sf))
    return f.serving_features(raw, REGIONS, ("CORPORATE", "RETAIL"), age_edges=(90, 365))


@query("serving_features", SERVING_SQL + " SELECT * FROM serving")
def _(spark, sf):
    return serving(spark, sf)


@query(
    "feature_table",
    FEATURES_SQL + " SELECT * REPLACE (round(CreditScore, 6) AS CreditScore, round(BalanceSalaryRatio, 8) AS BalanceSalaryRatio) FROM features",
)
def _(spark, sf):
    out = BASE_PLAN.transform(churn_base(spark, sf))
    return out.withColumns(
        {"CreditScore": F.round("CreditScore", 6), "BalanceSalaryRatio": F.round("BalanceSalaryRatio", 8)}
    )


@query(
    "sanitise_names",
    f"""SELECT "lt_60", "(60,120)" FROM (SELECT CAST(count(*) FILTER (Age < 60) AS BIGINT) AS "lt_60",
    CAST(count(*) FILTER (Age >= 60 AND Age < 120) AS BIGINT) AS "(60,120)" FROM churn_base)""",
)
def _(spark, sf):
    counts = churn_base(spark, sf).agg(
        F.count_if(F.col("Age") < 60).alias("<60"),
        F.count_if((F.col("Age") >= 60) & (F.col("Age") < 120)).alias("[60,120]"),
    )
    return f.sanitise_names(counts)


@query(
    "row_subsets",
    """SELECT 'churned' AS subset, count(*) AS n FROM churn_base WHERE Exited = 1
    UNION ALL SELECT 'retained', count(*) FROM churn_base WHERE Exited = 0
    UNION ALL SELECT 'nonzero_balance', count(*) FROM churn_base WHERE Balance > 0
    UNION ALL SELECT 'active', count(*) FROM churn_base WHERE IsActiveMember = 1""",
)
def _(spark, sf):
    tests = {
        "churned": F.col("Exited") == 1, "retained": F.col("Exited") == 0,
        "nonzero_balance": F.col("Balance") > 0, "active": F.col("IsActiveMember") == 1,
    }
    one = churn_base(spark, sf).agg(*[F.count_if(t).alias(n) for n, t in tests.items()])
    return one.unpivot([], list(tests), "subset", "n")


def risk_rules():
    """The six messages, thresholds scaled to the snapshot."""
    return [
        ("Age above threshold", F.col("Age") >= 365),
        ("Inactive member", F.col("IsActiveMember") == 0),
        ("Only one product", F.col("NumOfProducts") == 1),
        ("High balance and inactive", (F.col("Balance") > 5000) & (F.col("IsActiveMember") == 0)),
        ("High-churn country", F.col("Geography") == "EUROPE"),
        ("Low credit score", F.col("CreditScore") < 150000),
    ]


@query(
    "risk_factors",
    """SELECT CustomerId, 'Age above threshold' AS factor FROM churn_base WHERE Age >= 365
    UNION ALL SELECT CustomerId, 'Inactive member' FROM churn_base WHERE IsActiveMember = 0
    UNION ALL SELECT CustomerId, 'Only one product' FROM churn_base WHERE NumOfProducts = 1
    UNION ALL SELECT CustomerId, 'High balance and inactive' FROM churn_base WHERE Balance > 5000 AND IsActiveMember = 0
    UNION ALL SELECT CustomerId, 'High-churn country' FROM churn_base WHERE Geography = 'EUROPE'
    UNION ALL SELECT CustomerId, 'Low credit score' FROM churn_base WHERE CreditScore < 150000""",
)
def _(spark, sf):
    out = f.risk_factors(churn_base(spark, sf), risk_rules(), "factors")
    return out.select("CustomerId", F.explode("factors").alias("factor"))


@query(
    "effect_size_label",
    """SELECT Geography, share, CASE WHEN share >= 0.14 THEN 'large' WHEN share >= 0.06 THEN 'medium'
    WHEN share >= 0.01 THEN 'small' ELSE 'negligible' END AS effect
    FROM (SELECT Geography, round(count(*) / (SELECT count(*) FROM churn_base), 6) AS share
          FROM churn_base WHERE Exited = 1 GROUP BY Geography)""",
)
def _(spark, sf):
    b = churn_base(spark, sf)
    n = b.agg(F.count(F.lit(1))).scalar()
    g = b.where("Exited = 1").groupBy("Geography").agg(F.round(F.count(F.lit(1)) / n, 6).alias("share"))
    return g.withColumn("effect", effect_label(F.col("share")))

"""The feature table: raw snapshot to model columns, as specs over the snapshot's columns."""

from __future__ import annotations

from retentia.operators.features import DEFAULT_FLAGS, Bins, Encoding, FeaturePlan, Interaction, Ratio

# The raw table's schema contract, feature list and specs.
RAW_COLUMNS = [
    "RowNumber", "CustomerId", "Surname", "CreditScore", "Geography", "Gender", "Age", "Tenure",
    "Balance", "NumOfProducts", "HasCrCard", "IsActiveMember", "EstimatedSalary", "Exited",
    "Complain", "Satisfaction Score", "Card Type", "Point Earned",
]
AGE_BINS = Bins(
    "Age", "AgeGroup", (0, 30, 40, 50, 60, 100), ("<30", "30-40", "40-50", "50-60", "60+"),
    {"<30": 0, "30-40": 1, "40-50": 2, "50-60": 3, "60+": 4},
)
INTERACTIONS = (
    Interaction("AgeInactivity", "product_complement", ("Age", "IsActiveMember")),
    Interaction(
        "EngagementScore", "engagement_composite",
        ("IsActiveMember", "NumOfProducts", "HasCrCard", "HasZeroBalance"),
    ),
)
RATIOS = (Ratio("BalanceSalaryRatio", "Balance", "EstimatedSalary", 1),)
GENDER_MAP = {"Male": 0, "Female": 1}

BANK_PLAN = FeaturePlan(
    drop=("RowNumber", "CustomerId", "Surname", "Complain"),
    flags=DEFAULT_FLAGS,
    interactions=INTERACTIONS,
    ratios=RATIOS,
    bins=(AGE_BINS,),
    encodings=(
        Encoding("Geography", "one_hot", "geo"),
        Encoding("Gender", "binary", mapping=GENDER_MAP, new_column="Gender_encoded"),
    ),
    keep=(
        "CreditScore", "Age", "Tenure", "Balance", "NumOfProducts", "HasCrCard", "IsActiveMember",
        "EstimatedSalary", "Satisfaction Score", "Point Earned", "HasZeroBalance",
        "HighRiskProducts", "AgeInactivity", "EngagementScore", "BalanceSalaryRatio", "AgeGroup",
        "geo_France", "geo_Germany", "geo_Spain", "Gender_encoded", "Exited",
    ),
)

# The same plan on the snapshot, whose Age is in days and whose categories differ.
BASE_AGE_BINS = Bins(
    "Age", "AgeGroup", (-1, 60, 120, 240, 480, 5000), ("<60", "60-120", "120-240", "240-480", "480+"),
    {"<60": 0, "60-120": 1, "120-240": 2, "240-480": 3, "480+": 4},
)
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
BASE_GENDER_MAP = {"RETAIL": 0, "CORPORATE": 1}
BASE_FEATURES = [
    "CreditScore", "Age", "Tenure", "Balance", "NumOfProducts", "HasCrCard", "IsActiveMember",
    "EstimatedSalary", "SatisfactionScore", "PointEarned", "HasZeroBalance", "HighRiskProducts",
    "AgeInactivity", "EngagementScore", "BalanceSalaryRatio", "AgeGroup",
    *[f"geo_{r}" for r in REGIONS], "Gender_encoded",
]
BASE_PLAN = FeaturePlan(
    drop=("Surname", "Complain"),
    flags=DEFAULT_FLAGS,
    interactions=INTERACTIONS,
    ratios=RATIOS,
    bins=(BASE_AGE_BINS,),
    encodings=(
        Encoding("Geography", "one_hot", "geo", vocabulary=REGIONS),
        Encoding("Gender", "binary", mapping=BASE_GENDER_MAP, new_column="Gender_encoded"),
    ),
    keep=("CustomerId", *BASE_FEATURES, "Exited"),
)

IMPUTATION = [
    {"column": "CreditScore", "strategy": "median_by_group", "group_column": "Geography"},
    {"column": "Age", "strategy": "median", "fallback_value": 37},
    {"column": "Balance", "strategy": "constant", "fill_value": 0},
    {"column": "EstimatedSalary", "strategy": "median", "fallback_value": 100194},
    {"column": "NumOfProducts", "strategy": "mode", "fallback_value": 1},
    {"column": "Tenure", "strategy": "median", "fallback_value": 5},
]
STANDARD_COLUMNS = ["CreditScore", "EstimatedSalary", "PointEarned", "SatisfactionScore"]
ROBUST_COLUMNS = ["Age", "Balance"]
LOG_COLUMNS = ["Age"]

"""Rule suites for the raw bank table and for the snapshot."""

from __future__ import annotations

from retentia.operators.quality import suite
from retentia.plans.churn_base import COLUMNS
from retentia.plans.preprocessing import RAW_COLUMNS, REGIONS


def not_null():
    return {"type": "expect_column_values_to_not_be_null"}


def within(lo, hi, mostly=None):
    extra = {} if mostly is None else {"mostly": mostly}
    return {"type": "expect_column_values_to_be_between", "kwargs": {"min_value": lo, "max_value": hi, **extra}}


def one_of(*values):
    return {"type": "expect_column_values_to_be_in_set", "kwargs": {"value_set": list(values)}}


def mean(lo, hi):
    return {"type": "expect_column_mean_to_be_between", "kwargs": {"min_value": lo, "max_value": hi}}


def deviation(lo, hi):
    return {"type": "expect_column_stdev_to_be_between", "kwargs": {"min_value": lo, "max_value": hi}}


def table_rules(lo, hi, columns):
    return [
        {"type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": lo, "max_value": hi}},
        {"type": "expect_table_columns_to_match_set", "kwargs": {"column_set": list(columns), "exact_match": True}},
    ]


# Bounds of the bank table's suite.
BANK_SUITE = suite(
    table_rules(8000, 12000, RAW_COLUMNS),
    {
        "Exited": [not_null(), one_of(0, 1)],
        "CreditScore": [not_null(), within(432, 850, 0.99), mean(457.2, 843.8), deviation(48.3, 145.0)],
        "Age": [not_null(), within(21, 72, 0.99), mean(17.9, 59.9), deviation(5.2, 15.7)],
        "Balance": [not_null(), within(0, 250898), mean(0, 201281)],
        "EstimatedSalary": [not_null(), within(0, 200000, 0.99), mean(0, 215111)],
        "Point Earned": [not_null(), within(119, 1000), mean(154.7, 1058.4)],
        "Tenure": [not_null(), within(0, 10)],
        "NumOfProducts": [not_null(), within(1, 4)],
        "Satisfaction Score": [not_null(), within(1, 5), one_of(1, 2, 3, 4, 5)],
        "HasCrCard": [not_null(), one_of(0, 1)],
        "IsActiveMember": [not_null(), one_of(0, 1)],
        "Complain": [not_null(), one_of(0, 1)],
        "Geography": [not_null(), one_of("France", "Germany", "Spain")],
        "Gender": [not_null(), one_of("Male", "Female")],
        "Card Type": [not_null(), one_of("DIAMOND", "GOLD", "SILVER", "PLATINUM")],
    },
)

# The same forty rules with bounds for the snapshot; some are meant to fail.
BASE_SUITE = suite(
    table_rules(1000, 2000, COLUMNS),
    {
        "Exited": [not_null(), one_of(0, 1)],
        "CreditScore": [not_null(), within(120000, 370000, 0.99), mean(150000, 350000), deviation(20000, 80000)],
        "Age": [not_null(), within(0, 1000, 0.99), mean(0, 700), deviation(100, 200)],
        "Balance": [not_null(), within(0, 9000), mean(0, 10000)],
        "EstimatedSalary": [not_null(), within(0, 4000000, 0.99), mean(0, 5000000)],
        "PointEarned": [not_null(), within(1, 20), mean(5, 9)],
        "Tenure": [not_null(), within(0, 10)],
        "NumOfProducts": [not_null(), within(1, 4)],
        "SatisfactionScore": [not_null(), within(1, 5), one_of(1, 2, 3)],
        "HasCrCard": [not_null(), one_of(0, 1)],
        "IsActiveMember": [not_null(), one_of(0, 1)],
        "Complain": [not_null(), one_of(0, 1)],
        "Geography": [not_null(), one_of(*REGIONS)],
        "Gender": [not_null(), one_of("RETAIL", "CORPORATE")],
        "CardType": [not_null(), one_of("BUILDING", "MACHINERY", "HOUSEHOLD")],
    },
)

"""A cross-section of the registered queries against their SQL.

`python tests/oracle.py` runs all of them.
"""

import pytest

from tests.conftest import SF
from tests.oracle import compare, connect

NAMES = [
    "churn_base", "target_rate_by_group", "feature_table", "risk_factors", "impute_all", "scale_robust", "describe_numeric",
    "percentiles", "iqr_outliers", "duplicates", "quantile_bins_merged", "box_plot", "density", "spearman_matrix",
    "chi_square_all_pairs", "mann_whitney", "kruskal_wallis", "levene", "normality", "ks_drift", "psi", "quality_suite",
    "quality_quarantine", "classification_metrics", "threshold_sweep", "fold_metrics", "stratified_split",
    "chi_square_p", "welch_p", "ks_normal", "leakage_screen", "schema_listing", "report_json", "ingest_summary", "score_batch",
    "stream_window_psi", "stratified_folds", "request_rejected", "ingest_csv", "nearest_neighbours", "linear_contributions",
]


@pytest.fixture(scope="module")
def registry():
    from __spark_entry__ import oracle_sql, queries

    return queries(), oracle_sql()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, registry, name):
    queries, oracles = registry
    assert compare(queries[name](spark, SF), connect(SF), oracles[name], exact=False) is None


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0


def test_every_oracle_has_a_query(registry):
    queries, oracles = registry
    assert set(oracles) <= set(queries) and len(queries) >= 180

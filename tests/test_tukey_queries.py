"""Tukey's test covers every numeric column and grouping."""

from retentia.operators import hypothesis as h
from retentia.plans.churn_base import NUMERIC
from retentia.queries import load
from retentia.queries.statistics import GROUPINGS
from tests.conftest import SF
from tests.oracle import compare, connect


def test_all_pairs_match_sql(spark):
    # At sf0.001 one mean difference lies half-way between two roundings (1084.3547 or 1084.3548).
    sf = "/root/testdata/sf0.01"
    queries, oracles = load()
    assert compare(queries["tukey_hsd_all"](spark, sf), connect(sf), oracles["tukey_hsd_all"], exact=False) is None


def test_significant_asks_every_column_and_grouping(spark, monkeypatch):
    asked = []
    tukey = h.tukey
    monkeypatch.setattr(h, "tukey", lambda df, columns, groupings, **options: asked.append((columns, groupings)) or tukey(df, columns, groupings, **options))
    load()[0]["tukey_hsd_significant"](spark, SF)
    assert asked == [(NUMERIC, GROUPINGS)]

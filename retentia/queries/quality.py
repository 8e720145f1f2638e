"""Quality suite, suggestions, quarantine and gates."""

import json

from pyspark.sql import functions as F

from retentia.operators import quality as q
from retentia.operators.profile import describe
from retentia.plans.churn_base import BINARY, CATEGORICAL, COLUMNS, NUMERIC, churn_base
from retentia.plans.quality_suites import BASE_SUITE
from retentia.queries.profiling import rounded, union
from retentia.queries.registry import query


def sql_value(v):
    return f"'{v}'" if isinstance(v, str) else str(v)


def rule_sql(i, r):
    """One rule, computed on its own."""
    c, k = r.column, r.kwargs
    n = none = "CAST(NULL AS BIGINT)"
    pct = obs = "CAST(NULL AS DOUBLE)"
    details = "CAST(NULL AS VARCHAR)"
    missing = bad = none
    if r.kind == "expect_table_row_count_to_be_between":
        ok, obs = f"count(*) BETWEEN {k['min_value']} AND {k['max_value']}", "CAST(count(*) AS DOUBLE)"
    elif r.kind == "expect_table_columns_to_match_set":
        same = set(k["column_set"]) == set(COLUMNS)
        ok, bad, details = f"count(*) >= 0 AND {same}", "CAST(0 AS BIGINT)", "''"
    elif "_mean_" in r.kind or "_stdev_" in r.kind:
        f = "avg" if "_mean_" in r.kind else "stddev_samp"
        ok, obs = f"{f}({c}) BETWEEN {k['min_value']} AND {k['max_value']}", f"CAST({f}({c}) AS DOUBLE)"
    else:
        n, missing = "count(*)", f"count(*) - count({c})"
        if r.kind.endswith("null"):
            bad, base = f"count(*) FILTER ({c} IS NULL)", "count(*)"
        elif "in_set" in r.kind:
            bad, base = f"count(*) FILTER ({c} NOT IN ({', '.join(sql_value(v) for v in k['value_set'])}))", f"count({c})"
        else:
            bad, base = f"count(*) FILTER ({c} NOT BETWEEN {k['min_value']} AND {k['max_value']})", f"count({c})"
        ok, pct = f"1 - {bad} / {base} >= {k.get('mostly', 1.0)}", f"{bad} / {base} * 100"
    column = f"'{c}'" if c else "CAST(NULL AS VARCHAR)"
    return f"""SELECT {i} AS rule, '{r.kind}' AS type, {column} AS "column", '{json.dumps(k, sort_keys=True)}' AS kwargs, {ok} AS success,
    {n} AS element_count, {missing} AS missing_count, {bad} AS unexpected_count, round({pct}, 6) AS unexpected_percent,
    round({obs}, 4) AS observed_value, {details} AS details FROM churn_base"""


SUITE_SQL = "results AS (" + union(rule_sql(i, r) for i, r in enumerate(BASE_SUITE)) + ")"


@query("quality_suite", SUITE_SQL + " SELECT * FROM results")
def _(spark, sf):
    return rounded(q.run_suite(churn_base(spark, sf), BASE_SUITE), 6, observed_value=4)


@query(
    "quality_summary",
    SUITE_SQL + """ SELECT bool_and(success) AS success, count(*) AS total, count(*) FILTER (success) AS passed,
    count(*) FILTER (NOT success) AS failed FROM results""",
)
def _(spark, sf):
    return q.summarise(q.run_suite(churn_base(spark, sf), BASE_SUITE))


def one_rule(name, kind):
    """Each expectation kind also as a query of its own."""
    rules = [(i, r) for i, r in enumerate(BASE_SUITE) if r.kind == kind]
    sql = union(rule_sql(j, r) for j, (_, r) in enumerate(rules))

    @query(name, sql if sql[:6] == "SELECT" else None)
    def _(spark, sf):
        return rounded(q.run_suite(churn_base(spark, sf), [r for _, r in rules]), 6, observed_value=4)


one_rule("quality_row_count", "expect_table_row_count_to_be_between")
one_rule("quality_column_set", "expect_table_columns_to_match_set")
one_rule("quality_not_null", "expect_column_values_to_not_be_null")
one_rule("quality_in_set", "expect_column_values_to_be_in_set")
one_rule("quality_between", "expect_column_values_to_be_between")
one_rule("quality_mean", "expect_column_mean_to_be_between")
one_rule("quality_stdev", "expect_column_stdev_to_be_between")


def broken_sql(r):
    c, k = r.column, r.kwargs
    if r.kind.endswith("null"):
        test = f"{c} IS NULL"
    elif "in_set" in r.kind:
        test = f"{c} NOT IN ({', '.join(sql_value(v) for v in k['value_set'])})"
    else:
        test = f"{c} NOT BETWEEN {k['min_value']} AND {k['max_value']}"
    return f"SELECT CustomerId, '{c}:{r.kind}' AS rule FROM churn_base WHERE {test}"


ROW_RULES = [r for r in BASE_SUITE if r.column and "_values_" in r.kind]


@query("quality_quarantine", union(broken_sql(r) for r in ROW_RULES))
def _(spark, sf):
    bad = q.quarantine(churn_base(spark, sf), BASE_SUITE)
    return bad.select("CustomerId", F.explode("violated").alias("rule"))


DISCRETE_COLUMNS = CATEGORICAL + BINARY


def set_sql(c):
    quote = f"'\"' || {c} || '\"'" if c in CATEGORICAL else f"CAST({c} AS VARCHAR)"
    return f"""SELECT 'expect_column_values_to_be_in_set' AS type, '{c}' AS "column", CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value,
    '[' || string_agg(v, ',' ORDER BY v) || ']' AS value_set FROM (SELECT DISTINCT {quote} AS v FROM churn_base WHERE {c} IS NOT NULL)"""


NO = "CAST(NULL AS DOUBLE)"


@query(
    "quality_suggestions",
    f"""SELECT 'expect_table_row_count_to_be_between' AS type, CAST(NULL AS VARCHAR) AS "column", CAST(floor(count(*) * 0.8) AS DOUBLE) AS min_value,
    CAST(floor(count(*) * 1.2) AS DOUBLE) AS max_value, CAST(NULL AS VARCHAR) AS value_set FROM churn_base
    UNION ALL SELECT 'expect_table_columns_to_match_set', NULL, {NO}, {NO}, '{json.dumps(sorted(COLUMNS))}' UNION ALL """
    + union(f"SELECT 'expect_column_values_to_not_be_null', '{c}', {NO}, {NO}, NULL" for c in NUMERIC)
    + " UNION ALL "
    + union(
        f"SELECT 'expect_column_values_to_be_between', '{c}', round(quantile_cont({c}, 0.01), 4), round(quantile_cont({c}, 0.99), 4), NULL FROM churn_base"
        for c in NUMERIC
    )
    + " UNION ALL "
    + union(set_sql(c) for c in DISCRETE_COLUMNS),
)
def _(spark, sf):
    return rounded(q.suggest(churn_base(spark, sf), NUMERIC, DISCRETE_COLUMNS), 4)


@query(
    "quality_tolerances",
    union(
        f"""SELECT '{c}' AS feature, round(avg({c}) - 2 * stddev_samp({c}), 4) AS mean_min, round(avg({c}) + 2 * stddev_samp({c}), 4) AS mean_max,
        round(stddev_samp({c}) * 0.5, 4) AS std_min, round(stddev_samp({c}) * 1.5, 4) AS std_max FROM churn_base"""
        for c in NUMERIC
    ),
)
def _(spark, sf):
    return rounded(q.tolerances(describe(churn_base(spark, sf), NUMERIC)), 4)


@query("size_gate", "SELECT count(*) AS n, count(*) > 1000 AS passed FROM churn_base")
def _(spark, sf):
    return q.size_gate(churn_base(spark, sf))

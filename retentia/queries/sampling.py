"""Splits, folds, samples, halves, weights."""

from pyspark.sql import functions as F

from retentia.operators import sampling as s
from retentia.plans.churn_base import KEY, TARGET, churn_base
from retentia.queries.profiling import rounded
from retentia.queries.registry import query

ORDER_SQL = """placed AS (SELECT CustomerId, Exited, row_number() OVER (PARTITION BY Exited ORDER BY md5('42-' || CustomerId), CustomerId) AS rn FROM churn_base),
n AS (SELECT Exited, count(*) AS k, count(*) * ceil(0.2 * (SELECT count(*) FROM churn_base)) / (SELECT count(*) FROM churn_base) AS exact FROM churn_base GROUP BY 1),
quota AS (SELECT Exited, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, Exited)
  <= ceil(0.2 * (SELECT count(*) FROM churn_base)) - (SELECT sum(floor(exact)) FROM n) THEN 1 ELSE 0 END AS q FROM n)"""


@query("stratified_split", ORDER_SQL + " SELECT CustomerId, Exited, CASE WHEN rn <= q THEN 'holdout' ELSE 'train' END AS split FROM placed JOIN quota USING (Exited)")
def _(spark, sf):
    return s.stratified_split(churn_base(spark, sf), KEY, TARGET).select(KEY, TARGET, "split")


@query(
    "split_class_shares",
    ORDER_SQL + """ SELECT CASE WHEN rn <= q THEN 'holdout' ELSE 'train' END AS split, count(*) AS n, round(avg(Exited), 6) AS rate
    FROM placed JOIN quota USING (Exited) GROUP BY 1""",
)
def _(spark, sf):
    split = s.stratified_split(churn_base(spark, sf), KEY, TARGET)
    return rounded(split.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg(TARGET).alias("rate")))


@query("stratified_folds", ORDER_SQL + """ SELECT CustomerId, Exited, CAST(CASE WHEN rn <= (k % 5) * (k // 5 + 1) THEN (rn - 1) // (k // 5 + 1)
    ELSE k % 5 + (rn - (k % 5) * (k // 5 + 1) - 1) // (k // 5) END AS INT) AS fold FROM placed JOIN n USING (Exited)""")
def _(spark, sf):
    return s.stratified_folds(churn_base(spark, sf), KEY, TARGET).select(KEY, TARGET, "fold")


@query(
    "positional_halves",
    """SELECT CustomerId, CASE WHEN row_number() OVER (ORDER BY CustomerId) <= (SELECT count(*) // 2 FROM churn_base) THEN 'first' ELSE 'second' END AS half FROM churn_base""",
)
def _(spark, sf):
    return s.positional_halves(churn_base(spark, sf), KEY).select(KEY, "half")


@query("random_sample", "SELECT CustomerId FROM churn_base ORDER BY md5('42-' || CustomerId), CustomerId LIMIT 500")
def _(spark, sf):
    return s.random_sample(churn_base(spark, sf), KEY, 500).select(KEY)


@query("head_rows", "SELECT CustomerId, Surname, Exited FROM churn_base ORDER BY CustomerId LIMIT 5")
def _(spark, sf):
    return churn_base(spark, sf).orderBy(KEY).limit(5).select(KEY, "Surname", TARGET)


@query(
    "class_weights",
    """SELECT Exited AS class, count(*) AS n, round((SELECT count(*) FROM churn_base) / (2.0 * count(*)), 6) AS balanced_weight,
    round((SELECT count(*) FILTER (Exited = 0) / count(*) FILTER (Exited = 1) FROM churn_base), 6) AS scale_pos_weight FROM churn_base GROUP BY 1""",
)
def _(spark, sf):
    return rounded(s.class_weights(churn_base(spark, sf), TARGET))

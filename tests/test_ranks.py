"""Cut points of ranks: taken once, so that rows and the sums before them are cut alike."""

from pyspark.sql import functions as F

from retentia.operators.metrics import ranking_metrics
from retentia.operators.ranks import frequencies, ranked


def test_cuts_are_taken_once(spark):
    values = spark.range(400).select(F.lit("v").alias("feature"), (F.col("id") % 97).cast("double").alias("value"))
    placed = ranked(frequencies(values))
    assert "percentile_approx" not in placed._jdf.queryExecution().executedPlan().toString()
    before = 0
    for r in placed.orderBy("value").collect():
        assert (r.n_before, r.n_tie, r.n_total) == (before, r.n, 400)
        before += r.n


def test_no_rows_have_no_ranks(spark):
    nothing = spark.createDataFrame([], "y int, p double")
    assert [tuple(r) for r in ranking_metrics(nothing, "y", "p").collect()] == [(None, None)]

"""Customer snapshot the operators run on.

Features come from orders older than one year before the last order, the target from the last
year. Order amounts are summed as decimals, so the snapshot does not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET = "Exited"
KEY = "CustomerId"
ID_COLUMNS = ["CustomerId", "Surname"]
CONTINUOUS = ["CreditScore", "Age", "Balance", "EstimatedSalary", "PointEarned"]
DISCRETE = ["Tenure", "NumOfProducts", "SatisfactionScore"]
NUMERIC = CONTINUOUS + DISCRETE
BINARY = ["HasCrCard", "IsActiveMember", "Complain", "Exited"]
CATEGORICAL = ["Geography", "Gender", "CardType"]
COLUMNS = [
    "CustomerId", "Surname", "CreditScore", "Geography", "Gender", "Age", "Tenure", "Balance",
    "NumOfProducts", "HasCrCard", "IsActiveMember", "EstimatedSalary", "Exited", "Complain",
    "SatisfactionScore", "CardType", "PointEarned",
]


# Declared schemas: no job is spent on reading footers before the plan is made.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_profile(orders: DataFrame) -> DataFrame:
    """One row per customer from a single pass over orders (all measures combine map-side)."""
    last = orders.agg(F.max("o_orderdate")).scalar()
    dated = orders.select(
        "o_custkey",
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("pri"),
        (F.col("o_orderdate") > last - F.expr("INTERVAL 365 DAY")).alias("in_outcome"),
        (F.col("o_orderdate") > last - F.expr("INTERVAL 300 DAY")).alias("in_leak"),
        F.datediff(last, F.col("o_orderdate")).alias("age_days"),
    )

    def past(x: str | Column) -> Column:
        return F.when(~F.col("in_outcome"), F.col(x) if isinstance(x, str) else x)

    return dated.groupBy("o_custkey").agg(
        F.count(past("age_days")).alias("n_orders"),
        F.sum(past("price")).cast("double").alias("total_spend"),
        (F.min(past("age_days")) - 365).alias("recency"),
        (F.max(past("age_days")) - F.min(past("age_days"))).alias("span"),
        F.bit_count(F.bit_or(past(F.expr("shiftleft(1, pri)")))).alias("np"),
        F.max(past((F.col("pri") == 1).cast("int"))).alias("urgent"),
        F.floor(F.avg(past("pri"))).cast("int").alias("sat"),
        F.max(F.col("in_outcome").cast("int")).alias("has_out"),
        F.max(F.col("in_leak").cast("int")).alias("has_leak"),
    )


def churn_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot over the four source tables; the planner sizes the joins itself."""
    profile = order_profile(table(spark, sf_dir, "orders"))
    customer = table(spark, sf_dir, "customer")
    place = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "r_name")
    )
    joined = customer.join(profile, F.col("c_custkey") == F.col("o_custkey"), "left").join(
        place, F.col("c_nationkey") == F.col("n_nationkey")
    )
    retail = F.col("c_mktsegment").isin("HOUSEHOLD", "FURNITURE", "AUTOMOBILE")
    has_past = F.col("n_orders") > 0
    return joined.select(
        F.col("c_custkey").alias("CustomerId"),
        F.col("c_name").alias("Surname"),
        F.when(has_past, F.col("total_spend") / F.col("n_orders")).alias("CreditScore"),
        F.col("r_name").alias("Geography"),
        F.when(retail, "RETAIL").otherwise("CORPORATE").alias("Gender"),
        F.col("recency").alias("Age"),
        F.floor(F.col("span") / 365.0).cast("int").alias("Tenure"),
        F.greatest(F.col("c_acctbal"), F.lit(0.0)).alias("Balance"),
        F.when(has_past, F.least(F.col("np"), F.lit(4))).cast("int").alias("NumOfProducts"),
        F.col("urgent").alias("HasCrCard"),
        F.when(F.col("recency") <= 180, 1).otherwise(0).alias("IsActiveMember"),
        F.col("total_spend").alias("EstimatedSalary"),
        (1 - F.coalesce("has_out", F.lit(0))).alias("Exited"),
        (1 - F.coalesce("has_leak", F.lit(0))).alias("Complain"),
        F.col("sat").alias("SatisfactionScore"),
        F.col("c_mktsegment").alias("CardType"),
        F.coalesce("n_orders", F.lit(0)).cast("int").alias("PointEarned"),
    )


# The same snapshot for the SQL oracle.
BASE_SQL = """WITH mx AS (SELECT max(o_orderdate) AS last_dt FROM orders),
o AS (SELECT o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
             CAST(substr(o_orderpriority,1,1) AS INT) AS pri,
             (o_orderdate > last_dt - INTERVAL 365 DAY) AS in_outcome,
             (o_orderdate > last_dt - INTERVAL 300 DAY) AS in_leak,
             date_diff('day', o_orderdate, last_dt) AS age_days
      FROM orders, mx),
f AS (SELECT o_custkey, count(*) n_orders, CAST(sum(price) AS DOUBLE) total_spend,
             min(age_days)-365 recency, max(age_days)-min(age_days) span, count(DISTINCT pri) np,
             max(CASE WHEN pri=1 THEN 1 ELSE 0 END) urgent, CAST(floor(avg(pri)) AS INT) sat
      FROM o WHERE NOT in_outcome GROUP BY o_custkey),
t AS (SELECT o_custkey, max(CASE WHEN in_outcome THEN 1 ELSE 0 END) has_out,
             max(CASE WHEN in_leak THEN 1 ELSE 0 END) has_leak FROM o GROUP BY o_custkey),
churn_base AS (SELECT c.c_custkey AS CustomerId, c.c_name AS Surname,
  f.total_spend / f.n_orders AS CreditScore, r.r_name AS Geography,
  CASE WHEN c.c_mktsegment IN ('HOUSEHOLD','FURNITURE','AUTOMOBILE') THEN 'RETAIL' ELSE 'CORPORATE' END AS Gender,
  CAST(f.recency AS INT) AS Age, CAST(floor(f.span/365.0) AS INT) AS Tenure,
  greatest(c.c_acctbal, 0.0) AS Balance, CAST(CASE WHEN f.np > 4 THEN 4 ELSE f.np END AS INT) AS NumOfProducts,
  f.urgent AS HasCrCard, CASE WHEN f.recency<=180 THEN 1 ELSE 0 END AS IsActiveMember,
  f.total_spend AS EstimatedSalary, 1-coalesce(t.has_out,0) AS Exited, 1-coalesce(t.has_leak,0) AS Complain,
  f.sat AS SatisfactionScore, c.c_mktsegment AS CardType, CAST(coalesce(f.n_orders,0) AS INT) AS PointEarned
FROM customer c
LEFT JOIN f ON f.o_custkey=c.c_custkey LEFT JOIN t ON t.o_custkey=c.c_custkey
JOIN nation n ON n.n_nationkey=c.c_nationkey JOIN region r ON r.r_regionkey=n.n_regionkey)"""

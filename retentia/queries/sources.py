"""Ingest, schema, sinks, text records and streaming, as round trips over the given tables."""

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from retentia.operators import metrics as m
from retentia.operators.quality import run_suite
from retentia.operators.ranks import quantile_map
from retentia.plans.churn_base import KEY, churn_base, table
from retentia.plans.preprocessing import BASE_PLAN
from retentia.plans.quality_suites import BASE_SUITE
from retentia.queries.evaluation import MODEL_SQL, PREDICTED_SQL, saved_predictor, with_flags
from retentia.queries.profiling import rounded, union
from retentia.queries.quality import ROW_RULES, broken_sql
from retentia.queries.registry import ORACLES, query
from retentia.session import scratch
from retentia.sources import ingest, records, tables
from retentia.streaming import jobs

CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def customer_csv(spark, sf):
    """The customer table as a folder of three CSV files."""
    root = scratch(spark, "csv")
    parts = table(spark, sf, "customer").repartition(3, "c_custkey")
    parts.write.options(header="true", quote='"', escape='"').csv(root)
    return root


@query("ingest_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer", on_base=False)
def _(spark, sf):
    out = scratch(spark, "parquet")
    required = [f.split()[0] for f in CUSTOMER_SCHEMA.split(", ")]
    ingest.ingest_csv_to_parquet(spark, customer_csv(spark, sf), out, "snappy", required, CUSTOMER_SCHEMA)
    return spark.read.parquet(out)


@query("ingest_csv_inferred", "SELECT CAST(c_custkey AS INT) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer", on_base=False)
def _(spark, sf):
    out = scratch(spark, "parquet")
    ingest.ingest_csv_to_parquet(spark, customer_csv(spark, sf), out, "gzip")
    return spark.read.parquet(out)


@query("ingest_idempotent", "SELECT count(*) AS n, 3 AS runs FROM customer", on_base=False)
def _(spark, sf):
    raw, out = customer_csv(spark, sf), scratch(spark, "parquet")
    ingest.ingest_csv_to_parquet(spark, raw, out, schema=CUSTOMER_SCHEMA)
    ingest.ingest_csv_to_parquet(spark, "/nowhere", out, schema=CUSTOMER_SCHEMA)  # kept, the folder is not read
    ingest.ingest_csv_to_parquet(spark, raw, out, schema=CUSTOMER_SCHEMA, force=True)
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("n"), F.lit(3).alias("runs"))


# Columns a customer file must have, two of which the given one lacks.
CUSTOMER_CONTRACT = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "c_phone", "c_address"]


@query(
    "schema_contract",
    "SELECT required, required IN (SELECT column_name FROM information_schema.columns WHERE table_name = 'customer') AS present FROM (VALUES "
    + ", ".join(f"('{c}')" for c in CUSTOMER_CONTRACT) + ") t(required)",
    on_base=False,
)
def _(spark, sf):
    return ingest.schema_contract(spark.read.parquet(f"{sf.rstrip('/')}/customer.parquet"), CUSTOMER_CONTRACT)


@query(
    "union_tables",
    """SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""",
    on_base=False,
)
def _(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    s = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return ingest.union_tables([c, s])


@query(
    "ingest_summary",
    "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS total_rows, true AS sizes_known, true AS ratio_holds FROM customer",
    on_base=False,
)
def _(spark, sf):
    """What any run must agree on: bytes differ from run to run, their relations do not."""
    raw, out = customer_csv(spark, sf), scratch(spark, "parquet")
    ingest.ingest_csv_to_parquet(spark, raw, out, schema=CUSTOMER_SCHEMA)
    files = ingest.ingest_summary(spark, raw, out, CUSTOMER_SCHEMA)
    ratio = F.sum("csv_bytes") / F.max("parquet_bytes")
    return files.agg(
        F.sum("n_rows").alias("n_rows"), F.max("total_rows").alias("total_rows"),
        (F.min("csv_bytes") > 0).alias("sizes_known"), (F.abs(ratio - F.max("compression_ratio")) < 1e-9).alias("ratio_holds"),
    )


@query(
    "schema_listing",
    """SELECT CAST(ordinal_position - 1 AS INTEGER) AS position, column_name AS name,
      CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
        WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS type
    FROM information_schema.columns WHERE table_name = 'orders'""",
    on_base=False,
)
def _(spark, sf):
    return tables.file_schema(spark, f"{sf.rstrip('/')}/orders.parquet")


@query("feature_sink", "SELECT count(*) AS n_rows, 24 AS n_columns, true AS schema_ok FROM churn_base")
def _(spark, sf):
    features = BASE_PLAN.transform(churn_base(spark, sf))
    check = tables.write_features(features, scratch(spark, "features"))
    return spark.createDataFrame([(check["n_rows"], check["n_columns"], check["schema_ok"])], "n_rows bigint, n_columns int, schema_ok boolean")


def report_round_trip(fmt):
    def run(spark, sf):
        results = rounded(run_suite(churn_base(spark, sf), BASE_SUITE).drop("kwargs", "details"), 6, observed_value=4)
        path = tables.write_report(results, scratch(spark, "report"), "quality", fmt)
        return tables.read_report(spark, path, fmt, results.schema)

    return run


# The report is the suite's result without its free-form columns.
REPORT_SQL = f"SELECT * EXCLUDE (kwargs, details) FROM ({ORACLES['quality_suite']}) s"
for fmt in ("json", "csv", "parquet"):
    query(f"report_{fmt}", REPORT_SQL, on_base=False)(report_round_trip(fmt))

BOX = StructType([
    StructField("CustomerId", LongType()), StructField("Balance", DoubleType()), StructField("Age", IntegerType()),
    StructField("Geography", StringType()),
])
ROWS_PER_TEXT = 50


def boxed(spark, sf):
    """Batches of at most fifty rows, each destined for one text value."""
    rows = churn_base(spark, sf).select("CustomerId", "Balance", "Age", "Geography")
    return rows.withColumn("batch", F.floor(F.col(KEY) / ROWS_PER_TEXT))


@query("csv_text_rows", "SELECT CustomerId, Balance, Age, Geography FROM churn_base")
def _(spark, sf):
    line = F.to_csv(F.struct("CustomerId", "Balance", "Age", "Geography"))
    texts = boxed(spark, sf).groupBy("batch").agg(F.concat_ws("\n", F.lit("CustomerId,Balance,Age,Geography"), F.collect_list(line)).alias("text"))
    return records.csv_text_rows(texts, "text", BOX)


@query("json_batch_rows", "SELECT CustomerId, Balance, Age, Geography FROM churn_base")
def _(spark, sf):
    texts = boxed(spark, sf).groupBy("batch").agg(F.to_json(F.collect_list(F.struct("CustomerId", "Balance", "Age", "Geography"))).alias("text"))
    return records.json_batch_rows(texts, "text", BOX)


def requests(spark, sf):
    """Request objects with planted faults: no Age, a text balance, a field nobody knows; incomplete customers stay."""
    b = churn_base(spark, sf)
    number = {c: F.col(c).cast("double").cast("string") for c in records.REQUIRED_FIELDS if c not in ("Age", "Balance")}
    body = F.struct(
        *[x.alias(c) for c, x in number.items()],
        F.when(F.col(KEY) % 10 != 0, F.col("Age").cast("double").cast("string")).alias("Age"),
        F.when(F.col(KEY) % 11 == 0, F.lit("many")).otherwise(F.col("Balance").cast("string")).alias("Balance"),
        F.when(F.col(KEY) % 7 == 0, F.lit("1")).alias("Shoe"),
        F.when(F.col(KEY) % 2 == 0, F.lit("2.5")).alias("EngagementScore"),
    )
    return b.select(KEY, F.to_json(body).alias("body"))


COMPLETE = f"(SELECT * FROM churn_base WHERE {' AND '.join(f'{c} IS NOT NULL' for c in records.REQUIRED_FIELDS)})"
MISSING = union(
    f"SELECT CustomerId, 'missing {c}' AS error FROM churn_base WHERE "
    + {"Age": "Age IS NULL OR CustomerId % 10 = 0", "Balance": "Balance IS NULL AND CustomerId % 11 <> 0"}.get(c, f"{c} IS NULL")
    for c in records.REQUIRED_FIELDS
)


@query(
    "request_accepted",
    f"""SELECT CustomerId, CAST(Age AS DOUBLE) AS Age, Balance, CASE WHEN CustomerId % 2 = 0 THEN 2.5 ELSE 0.0 END::DOUBLE AS EngagementScore, 1.0::DOUBLE AS Gender_Male
    FROM {COMPLETE} WHERE CustomerId % 10 <> 0 AND CustomerId % 11 <> 0 AND CustomerId % 7 <> 0""",
)
def _(spark, sf):
    good = records.accepted(records.parse_requests(requests(spark, sf), "body", [KEY]))
    return good.select(KEY, "Age", "Balance", "EngagementScore", "Gender_Male")


@query(
    "request_rejected",
    f"""{MISSING} UNION ALL SELECT CustomerId, 'not a number Balance' FROM churn_base WHERE CustomerId % 11 = 0
    UNION ALL SELECT CustomerId, 'unknown Shoe' FROM churn_base WHERE CustomerId % 7 = 0""",
)
def _(spark, sf):
    bad = records.rejected(records.parse_requests(requests(spark, sf), "body", [KEY]), [KEY])
    return bad.select(KEY, F.explode("errors").alias("error"))


def landed(spark, sf):
    """The snapshot as a folder of files for a stream to pick up."""
    path = scratch(spark, "landing")
    df = churn_base(spark, sf)
    df.repartition(4, KEY).write.parquet(path)
    return path, df.schema


@query(
    "stream_scores",
    MODEL_SQL + f""" SELECT CustomerId, CASE WHEN EstimatedSalary + 1 <> 0 THEN round(Balance / (EstimatedSalary + 1), 8) END AS BalanceSalaryRatio,
    {PREDICTED_SQL.format(at=0.45)} FROM out""",
)
def _(spark, sf):
    """Files arrive two at a time and are scored by the saved pipeline inside the stream."""
    path, schema = landed(spark, sf)
    out, model = scratch(spark, "scores"), saved_predictor(spark, sf)

    def score(rows):
        features = with_flags(BASE_PLAN.transform(rows))
        return model.predict(features, keep=(KEY, F.round("BalanceSalaryRatio", 8).alias("BalanceSalaryRatio")))

    jobs.stream_scores(jobs.file_stream(spark, path, schema, 2), score, out, scratch(spark, "progress")).awaitTermination()
    return spark.read.parquet(out)


DECILES = ", ".join(f"quantile_cont(value, {i / 10})" for i in range(11))


@query(
    "stream_window_psi",
    f"""ed AS (SELECT DISTINCT unnest([{DECILES}]) AS e FROM events),
    bins AS (SELECT row_number() OVER (ORDER BY e) - 1 AS bin, e AS lo, lead(e) OVER (ORDER BY e) AS hi, max(e) OVER () AS top FROM ed),
    cells AS (SELECT date_trunc('day', ts) AS d, bins.bin FROM events JOIN bins ON hi IS NOT NULL AND value >= lo AND (value < hi OR (hi = top AND value = hi))),
    ref AS (SELECT bin, count(*) / (SELECT count(*) FROM events) AS e FROM cells GROUP BY 1),
    w AS (SELECT date_trunc('day', ts) AS d, count(*) AS n FROM events GROUP BY 1),
    a AS (SELECT w.d, w.n, ref.bin, ref.e, coalesce(nullif((SELECT count(*) FROM cells c WHERE c.d = w.d AND c.bin = ref.bin), 0) / w.n, 1e-6) AS a FROM w, ref)
    SELECT CAST(d AS VARCHAR)[1:10] AS day, CAST(n AS BIGINT) AS n, round(sum((a - e) * ln(a / e)), 6) AS psi FROM a GROUP BY d, n""".replace("ed AS", "WITH ed AS", 1),
    on_base=False,
)
def _(spark, sf):
    """Daily windows over events that land in four stretches, then rows that come too late, then one that closes the last day.

    Every landing is a run of its own that goes on from the progress of the one before. The late rows are a copy of
    the first stretch; the watermark has passed them, so no count may change.
    """
    events = table(spark, sf, "events").select("ts", "value")
    found = quantile_map(events, ["value"], [i / 10 for i in range(11)])["value"]
    edges = sorted(set(found.values()))
    reference = (
        events.select(F.coalesce(jobs.psi_bin(F.col("value"), edges).cast("int"), F.lit(-1)).alias("bin"))
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    )
    path, out = scratch(spark, "events"), scratch(spark, "windows")
    progress = scratch(spark, "progress")
    utc = F.concat(F.col("ts").cast("string"), F.lit("+00:00")).cast("timestamp")
    timed = events.withColumn("ts", utc)
    first, last = timed.agg(F.min("ts").cast("double"), F.max("ts").cast("double")).first()
    bounds = [first + (last - first) * i / 4 for i in range(4)] + [last + 1]
    at = F.col("ts").cast("double")
    landings = [timed.where((at >= lo) & (at < hi)) for lo, hi in zip(bounds, bounds[1:])]
    closing = timed.orderBy("ts").limit(1).withColumn("ts", F.timestamp_seconds(F.lit(last + 2 * 86400)))
    for rows in [*landings, landings[0], closing]:
        rows.write.mode("append").parquet(path)
        stream = jobs.file_stream(spark, path, timed.schema)
        counts = jobs.window_bins(stream, "ts", "value", edges, "1 day", "1 second")
        jobs.stream_window_counts(counts, out, progress).awaitTermination()
    closed = spark.read.schema("window_start timestamp, bin int, n bigint").parquet(out)
    psi = jobs.window_psi(closed, reference)
    start = F.to_utc_timestamp("window_start", F.current_timezone())
    return rounded(psi.select(F.date_format(start, "yyyy-MM-dd").alias("day"), "n", "psi"))


def gate(spark, sf):
    path, schema = landed(spark, sf)
    good, bad = scratch(spark, "good"), scratch(spark, "bad")
    rows = jobs.file_stream(spark, path, schema, 2)
    jobs.stream_quality_gate(rows, BASE_SUITE, good, bad, scratch(spark, "progress")).awaitTermination()
    return spark.read.schema(schema).parquet(good), spark.read.parquet(bad)


@query("stream_quality_bad", union(broken_sql(r) for r in ROW_RULES))
def _(spark, sf):
    return gate(spark, sf)[1].select(KEY, F.explode("violated").alias("rule"))


@query("stream_quality_good", "SELECT CustomerId FROM churn_base EXCEPT SELECT CustomerId FROM (" + union(broken_sql(r) for r in ROW_RULES) + ")")
def _(spark, sf):
    return gate(spark, sf)[0].select(KEY)

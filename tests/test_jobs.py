"""Sources, quality rules, pipelines, monitoring and streams end to end."""

import json

import pytest
from pyspark.sql import functions as F

from retentia.operators import quality as q
from retentia.operators import runs
from retentia.operators.models import PipelineSpec, build_estimator, fit_pipeline, save_pipeline
from retentia.operators.reduction import fit_kpca, fit_pca, fit_reducer
from retentia.plans import eda, monitoring, training
from retentia.plans.churn_base import BINARY, CATEGORICAL, KEY, TARGET
from retentia.plans.preprocessing import BASE_PLAN, RAW_COLUMNS
from retentia.plans.quality_suites import BANK_SUITE, BASE_SUITE
from retentia.plans.scoring import Predictor
from retentia.sources import ingest, records, tables
from retentia.streaming import jobs


def write_csv(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def test_ingest_quotes_and_order(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    write_csv(raw, "b.csv", 'id,name\n3,"a ""quoted"" name"\n')
    write_csv(raw, "a.csv", 'id,name\n1,"x, y"\n2,\n')
    ingest.ingest_csv_to_parquet(spark, str(raw), out, required_columns=["id", "name"])
    rows = {r.id: r.name for r in spark.read.parquet(out).collect()}
    assert rows == {1: "x, y", 2: None, 3: 'a "quoted" name'}
    summary = {r.file: r for r in ingest.ingest_summary(spark, str(raw), out).collect()}
    assert summary["a.csv"].n_rows == 2 and summary["a.csv"].total_rows == 3


def test_ingest_refuses(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    with pytest.raises(FileNotFoundError):
        ingest.ingest_csv_to_parquet(spark, str(raw), str(tmp_path / "o1"))
    write_csv(raw, "a.csv", "id\n1\n")
    with pytest.raises(ingest.SchemaError):
        ingest.ingest_csv_to_parquet(spark, str(raw), str(tmp_path / "o2"), required_columns=["id", "gone"])
    write_csv(raw, "b.csv", "other\n1\n")
    with pytest.raises(Exception):
        ingest.ingest_csv_to_parquet(spark, str(raw), str(tmp_path / "o3"))
    with pytest.raises(ValueError):
        ingest.ingest_csv_to_parquet(spark, str(raw), str(tmp_path / "o4"), compression="zip")


def test_ingest_skips_existing(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    write_csv(raw, "a.csv", "id\n1\n")
    ingest.ingest_csv_to_parquet(spark, str(raw), out)
    write_csv(raw, "b.csv", "id\n2\n")
    ingest.ingest_csv_to_parquet(spark, str(raw), out)
    assert spark.read.parquet(out).count() == 1
    ingest.ingest_csv_to_parquet(spark, str(raw), out, force=True)
    assert spark.read.parquet(out).count() == 2


def test_report_has_no_nan(spark, tmp_path):
    df = spark.createDataFrame([("a", float("nan")), ("b", float("inf")), ("c", 1.5)], "k string, v double")
    path = tables.write_report(df, str(tmp_path), "r")
    assert {r.k: r.v for r in tables.read_report(spark, path, "json", df.schema).collect()} == {"a": None, "b": None, "c": 1.5}


def test_requests(spark):
    good = {c: 1 for c in records.REQUIRED_FIELDS}
    bodies = [good, {**good, "Gender_Male": 0}, {**good, "Age": "old"}, {k: v for k, v in good.items() if k != "Age"}, {**good, "X": 1}]
    df = spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)] + [(9, "no json")], "i int, body string")
    parsed = records.parse_requests(df, "body", ["i"])
    assert {r.i: r.Gender_Male for r in records.accepted(parsed).collect()} == {0: 1.0, 1: 0.0}
    assert {r.i: r.errors for r in records.rejected(parsed, ["i"]).collect()} == {
        2: ["not a number Age"], 3: ["missing Age"], 4: ["unknown X"], 9: ["not a JSON object"],
    }


def test_csv_text_of_another_header_is_left_out(spark):
    schema = spark.createDataFrame([], "a int, b string").schema
    df = spark.createDataFrame([("a,b\n1,x\n2,\"y, z\"\n",), ("b,a\nx,1",)], "t string")
    assert [tuple(r) for r in records.csv_text_rows(df, "t", schema).collect()] == [(1, "x"), (2, "y, z")]


def bank(spark, n=9000):
    cols = {
        "RowNumber": F.col("id"), "CustomerId": F.col("id"), "Surname": F.lit("x"), "CreditScore": 500 + F.col("id") % 300,
        "Geography": F.element_at(F.array(F.lit("France"), F.lit("Germany"), F.lit("Spain")), (F.col("id") % 3 + 1).cast("int")),
        "Gender": F.when(F.col("id") % 2 == 0, "Male").otherwise("Female"), "Age": 22 + F.col("id") % 40,
        "Tenure": F.col("id") % 11, "Balance": (F.col("id") % 1000) * 100.0, "NumOfProducts": 1 + F.col("id") % 4,
        "HasCrCard": F.col("id") % 2, "IsActiveMember": F.col("id") % 2, "EstimatedSalary": 1000.0 + F.col("id"),
        "Exited": (F.col("id") % 5 == 0).cast("int"), "Complain": (F.col("id") % 5 == 0).cast("int"),
        "Satisfaction Score": 1 + F.col("id") % 5, "Card Type": F.lit("GOLD"), "Point Earned": 200 + F.col("id") % 700,
    }
    return spark.range(n).select([c.alias(k) for k, c in cols.items()]).select([f"`{c}`" for c in RAW_COLUMNS])


def test_bank_suite(spark):
    assert len(BANK_SUITE) == len(BASE_SUITE)
    results = {(r.type, r.column): r.success for r in q.run_suite(bank(spark), BANK_SUITE).collect()}
    assert all(results.values())
    short = {(r.type, r.column) for r in q.run_suite(bank(spark, 100), BANK_SUITE).collect() if not r.success}
    assert ("expect_table_row_count_to_be_between", None) in short


def test_suite_reads_the_table_once(base):
    plan = q.run_suite(base, BASE_SUITE)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InMemoryRelation") == 1


def test_rule_names_and_mostly(spark):
    df = spark.createDataFrame([(i,) for i in range(100)] + [(None,)], "x int")
    rules = [
        q.Rule("ExpectColumnValuesToBeBetween", "x", {"min_value": 1, "max_value": 99, "mostly": 0.99}),
        q.Rule("expect_column_values_to_be_between", "x", {"min_value": 2, "max_value": 99, "mostly": 0.99}),
        q.Rule("expect_column_values_to_not_be_null", "x"),
        q.Rule("expect_column_values_to_not_be_null", "gone"),
    ]
    assert [r.success for r in q.run_suite(df, rules).orderBy("rule").collect()] == [True, False, False, False]
    with pytest.raises(AttributeError):
        q.run_suite(df, [q.Rule("expect_nothing", "x")])
    with pytest.raises(q.QualityError):
        q.check(df, rules, fail_on_error=True)
    assert q.check(df, rules)[1] == {"success": False, "total": 4, "passed": 1, "failed": 3}


def test_suggested_rules_hold(base):
    suggested = [r for r in q.suggest(base, ["Balance"], [*CATEGORICAL, *BINARY]).collect()]
    sets = [q.Rule(r.type, r.column, {"value_set": json.loads(r.value_set)}) for r in suggested if "in_set" in r.type]
    assert len(sets) == 7 and all(r.success for r in q.run_suite(base, sets).collect())


@pytest.fixture(scope="module")
def features(spark):
    from retentia.plans.churn_base import churn_base

    return BASE_PLAN.transform(churn_base(spark, "/root/testdata/sf0.01")).persist()


def test_unknown_parameters_are_refused():
    with pytest.raises(ValueError):
        build_estimator("boosting_depth", {"reg_alpha": 1.0}, "x", "y", 10)
    with pytest.raises(ValueError):
        build_estimator("logistic_regression", {"penalty": "other"}, "x", "y", 10)


def test_regularisation_scales_with_rows():
    one = build_estimator("logistic_regression", {"C": 2.0}, "x", "y", 100)
    assert one.getRegParam() == pytest.approx(1 / 200) and one.getElasticNetParam() == 0


def test_reducers(features):
    spec = training.base_spec("logistic_regression", oversample=False, params={"max_iter": 20})
    for reducer, first in (({"method": "pca", "n_components": 4}, "pc_0"), ({"method": "lda", "n_components": 3}, "lda_0"), ({"method": "kpca", "n_components": 3, "landmarks": 64}, "kpc_0")):
        import dataclasses

        fitted = fit_pipeline(features, KEY, TARGET, dataclasses.replace(spec, reducer=reducer))
        assert fitted.names[0] == first
        assert len(fitted.names) == (1 if reducer["method"] == "lda" else reducer["n_components"])
        assert fitted.score(features).where("p < 0 or p > 1 or p is null").count() == 0
    with pytest.raises(ValueError):
        fit_reducer(features, {"method": "tsne"}, "features", TARGET, [])


def test_kernel_pca_equals_eigenvectors_on_few_rows(spark):
    import numpy as np
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import Vectors

    x = np.random.default_rng(2).normal(size=(60, 3))
    df = spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(x)], ["id", "features"])
    out = fit_kpca(df, "features", 2, "rbf", key="id", landmarks=100).transform(df)
    got = np.array([r.z for r in out.select("id", vector_to_array("reduced").alias("z")).orderBy("id").collect()])
    k = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / 3)
    c = np.eye(60) - 1 / 60
    values, vectors = np.linalg.eigh(c @ k @ c)
    for j in range(2):
        want = vectors[:, -1 - j] * np.sqrt(values[-1 - j])
        assert min(np.abs(got[:, j] - want).max(), np.abs(got[:, j] + want).max()) < 1e-6


def test_pca_is_centred(spark):
    import numpy as np
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import Vectors

    x = np.random.default_rng(4).normal(5, 1, size=(50, 3))
    df = spark.createDataFrame([(Vectors.dense(r),) for r in x], ["features"])
    out = fit_pca(df, "features", 2).transform(df)
    z = np.array([r.z for r in out.select(vector_to_array("reduced").alias("z")).collect()])
    assert np.abs(z.mean(0)).max() < 1e-9


def test_folds_never_see_validation_rows(features, monkeypatch):
    """Constant training labels outside a fold would be impossible if rows leaked."""
    seen, held = [], []
    real = training.Folds.training

    def watch(self, reducer):
        for t in range(self.k):
            own = self.rows.where(F.col("t") == t)
            seen.append({r[0] for r in own.where("NOT valid").select("id").collect()})
            held.append({r[0] for r in own.where("valid").select("id").collect()})
        return real(self, reducer)

    monkeypatch.setattr(training.Folds, "training", watch)
    spec = training.base_spec("logistic_regression", oversample=False, params={"max_iter": 5})
    folds = training.cross_validate(features, KEY, TARGET, spec, k=3)
    n = features.count()
    assert folds.count() == 3 and sum(n - len(s) for s in seen) == n
    assert all(not a & b and len(a | b) == n for a, b in zip(seen, held))


def test_predictor(spark, features, tmp_path):
    spec = training.base_spec("logistic_regression", oversample=False, params={"max_iter": 20})
    save_pipeline(fit_pipeline(features, KEY, TARGET, spec), str(tmp_path / "m"), TARGET, 0.4)
    predictor = Predictor(spark, str(tmp_path / "m"))
    rows = features.na.drop()
    out = predictor.predict(rows, keep=(KEY,)).collect()
    assert all(0 <= r.churn_probability <= 1 and r.churn_flag in (0, 1) and r.risk_level in ("low", "medium", "high") for r in out)
    few = sum(r.churn_flag for r in predictor.predict(rows, 0.7).collect())
    many = sum(r.churn_flag for r in predictor.predict(rows, 0.1).collect())
    assert few <= many
    single = predictor.predict_single(rows.drop(KEY, TARGET).first().asDict(), 0.0)
    assert single["threshold_used"] == 0.0 and single["churn_flag"] == 1
    with pytest.raises(ValueError):
        predictor.predict(rows.drop("Age"))


def test_monitoring_cycle(base):
    scored = base.withColumn("p", ((F.col(KEY) * 7919) % 10007) / 10007.0).withColumn(
        "batch", F.when(F.col(KEY) % 2 == 1, "reference").otherwise("production")
    )
    out = monitoring.cycle(base, scored, ["CreditScore", "Age", "Balance"], TARGET)
    assert out["ks"].count() == 3
    row = out["retraining"].first()
    assert row.n_features_drifted == 0 and row.psi_score < 0.1


def test_eda_report(base):
    sections = eda.report(
        base, TARGET, KEY, ["CustomerId", "Surname"], ["CreditScore", "Age", "Tenure"], BINARY, CATEGORICAL,
        ["Geography", "NumOfProducts"], [("Age", "Geography")], clusters=False,
    )
    assert len(sections) == 30
    assert sections["rate_Age_Geography"].count() == 20
    assert sections["missing"].count() == len(base.columns)


def test_run_tables_append(spark, tmp_path):
    from datetime import datetime

    root = str(tmp_path)
    assert runs.read_runs(spark, root)[0].count() == 0
    for i in range(2):
        runs.log_run(spark, root, {"run_uuid": f"r{i}", "experiment": "e", "name": "n", "stage": "cv", "start_time": datetime(2024, 1, 1 + i), "params": {}}, {"roc_auc": 0.5 + i}, i)
    logged, values = runs.read_runs(spark, root)
    assert logged.count() == 2 and values.agg(F.max("value")).first()[0] == 1.5


def test_stream_equals_batch(spark, base, tmp_path):
    base.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = jobs.file_stream(spark, str(tmp_path / "in"), base.schema, 1)
    jobs.stream_scores(stream, BASE_PLAN.transform, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = BASE_PLAN.transform(base)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_quality_gate_loses_no_row(spark, base, tmp_path):
    base.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = jobs.file_stream(spark, str(tmp_path / "in"), base.schema, 1)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    jobs.stream_quality_gate(stream, BASE_SUITE, good, bad, str(tmp_path / "p")).awaitTermination()
    ids = [spark.read.parquet(x).select(KEY) for x in (good, bad)]
    assert ids[0].union(ids[1]).distinct().count() == base.count() == ids[0].count() + ids[1].count()


def test_specs_are_plain_data():
    spec = PipelineSpec("random_forest", ("a",))
    assert spec.oversample and spec.reducer == {"method": "none"}

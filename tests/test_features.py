"""Feature steps on small hand-made frames."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from retentia.operators import features as f
from retentia.operators import transformers as tr
from retentia.plans.preprocessing import AGE_BINS, BANK_PLAN, GENDER_MAP, RAW_COLUMNS

RECORD = dict(
    credit_score=650, age=42, tenure=5, balance=125000.0, num_products=2, has_cr_card=True, is_active=True,
    salary=80000.0, geography="France", gender="Male",
)
COUNTRIES, GENDERS = ("France", "Germany", "Spain"), ("Female", "Male")


def serve(spark, **changes):
    df = spark.createDataFrame([{**RECORD, **changes}])
    return f.serving_features(df, COUNTRIES, GENDERS).first()


def column(df, name):
    return [r[name] for r in df.collect()]


def test_serving_keys_and_values(spark):
    row = serve(spark).asDict()
    assert len(row) == 20
    assert row["CreditScore"] == 650 and row["Balance"] == 125000 and row["EstimatedSalary"] == 80000


@pytest.mark.parametrize("country", COUNTRIES)
def test_serving_country(spark, country):
    row = serve(spark, geography=country).asDict()
    assert [row[f"Geography_{c}"] for c in COUNTRIES] == [int(c == country) for c in COUNTRIES]


@pytest.mark.parametrize("gender", GENDERS)
def test_serving_gender(spark, gender):
    row = serve(spark, gender=gender).asDict()
    assert [row[f"Gender_{g}"] for g in GENDERS] == [int(g == gender) for g in GENDERS]


@pytest.mark.parametrize("age,group", [(25, "Young"), (29, "Young"), (30, "Middle"), (42, "Middle"), (54, "Middle"), (55, "Senior"), (60, "Senior")])
def test_serving_age_group(spark, age, group):
    row = serve(spark, age=age).asDict()
    assert {g: row[f"AgeGroup_{g}"] for g in ("Young", "Middle", "Senior")} == {g: int(g == group) for g in ("Young", "Middle", "Senior")}


@pytest.mark.parametrize(
    "changes,name,value",
    [
        (dict(age=50, is_active=True), "AgeInactivity", 0),
        (dict(age=50, is_active=False), "AgeInactivity", 50),
        (dict(balance=80000.0, salary=40000.0), "BalanceSalaryRatio", 2.0),
        (dict(balance=100.0, salary=0.0), "BalanceSalaryRatio", 100.0),
        (dict(num_products=2, tenure=4), "ProductsPerYear", 0.5),
        (dict(num_products=3, tenure=0), "ProductsPerYear", 3.0),
        (dict(is_active=True, has_cr_card=True, num_products=2), "EngagementScore", 3),
        (dict(is_active=False, has_cr_card=False, num_products=1), "EngagementScore", 0),
    ],
)
def test_serving_derived(spark, changes, name, value):
    assert serve(spark, **changes)[name] == value


def test_drop_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "A int, B int, C int")
    assert f.drop_columns(df, ["A", "C"]).columns == ["B"]
    assert f.drop_columns(df, ["Z"]).columns == ["A", "B", "C"]
    assert f.drop_columns(df, []).columns == ["A", "B", "C"]


def test_flags(spark):
    df = spark.createDataFrame([(0.0, 1), (100.0, 2), (0.0, 3), (50000.0, 4), (None, None)], "Balance double, NumOfProducts int")
    out = f.add_flags(df)
    assert column(out, "HasZeroBalance") == [1, 0, 1, 0, 0]
    assert column(out, "HighRiskProducts") == [0, 0, 1, 1, 0]


def test_one_hot(spark):
    df = spark.createDataFrame([("France",), ("Germany",), ("Spain",), ("France",), (None,)], "Geography string")
    out = f.encode(df, f.learn_encodings(df, [f.Encoding("Geography", "one_hot", "geo")]))
    assert out.columns == ["geo_France", "geo_Germany", "geo_Spain"]
    assert column(out, "geo_France") == [1, 0, 0, 1, 0]


def test_unseen_category_is_all_zero(spark):
    train = spark.createDataFrame([("a",), ("b",)], "g string")
    model = tr.CategoricalEncoder([{"column": "g", "method": "one_hot", "prefix": "g"}]).fit(train)
    out = model.transform(spark.createDataFrame([("c",)], "g string"))
    assert out.first().asDict() == {"g_a": 0, "g_b": 0}


def test_gender_codes(spark):
    df = spark.createDataFrame([("Male",), ("Female",), ("Other",), (None,)], "Gender string")
    out = f.encode(df, [f.Encoding("Gender", "binary", mapping=GENDER_MAP, new_column="code")])
    assert column(out, "code") == [0, 1, None, None]
    assert "Gender" in out.columns


def test_age_bins_are_right_closed(spark):
    df = spark.createDataFrame([(25,), (30,), (35,), (50,), (65,), (100,), (0,), (101,)], "Age int")
    assert column(f.add_bins(df, AGE_BINS), "AgeGroup") == [0, 0, 1, 2, 4, 4, None, None]


def test_ratio_zero_denominator(spark):
    df = spark.createDataFrame([(10.0, 4.0), (10.0, -1.0), (None, 1.0)], "a double, b double")
    assert column(f.add_ratios(df, [f.Ratio("r", "a", "b", 1)]), "r") == [2.0, None, None]


def test_interaction_skips_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "Age int")
    assert f.add_interactions(df, [f.Interaction("x", "product_complement", ("Age", "Missing"))]).columns == ["Age"]


def test_one_hot_of_many_categories(spark):
    df = spark.range(5000).select(F.format_string("c%04d", "id").alias("g"), "id")
    spec = f.learn_encodings(df, [f.Encoding("g", "one_hot_vector", "g")])
    out = f.encode(df.union(spark.createDataFrame([(None, -1), ("new", -2)], "g string, id long")), spec)
    rows = {r["id"]: r["g_vector"] for r in out.where("id < 0 OR id IN (0, 7, 4999)").collect()}
    assert out.columns == ["id", "g_vector"] and all(v.size == 5000 for v in rows.values())
    assert {i: v.indices.tolist() for i, v in rows.items()} == {-1: [], -2: [], 0: [0], 7: [7], 4999: [4999]}
    with pytest.raises(ValueError):
        f.encode(df, [f.Encoding("g", "one_hot", "g")])


def test_group_medians_of_many_groups(spark, tmp_path):
    from retentia.operators.stages import DataImputer, DataImputerModel

    df = spark.range(20_000).select((F.col("id") % 5000).alias("g"), F.when(F.col("id") < 15_000, F.col("id").cast("double")).alias("x"))
    model = DataImputer([{"column": "x", "strategy": "median_by_group", "group_column": "g"}]).fit(df)
    model.write().save(str(tmp_path / "imputer"))
    for m in (model, DataImputerModel.load(str(tmp_path / "imputer"))):
        out = m.transform(df.union(spark.createDataFrame([(7777, None), (None, None)], "g long, x double")))
        assert out.columns == ["g", "x"]
        assert out.where("g < 5000 AND x != g + 5000 AND (x - g) % 5000 != 0").count() == 0 and out.where("x IS NULL").count() == 0
        assert {r["x"] for r in out.where("g = 3").collect()} == {3.0, 5003.0, 10003.0}
        assert {r["x"] for r in out.where("g = 7777 OR g IS NULL").collect()} == {7499.5}


def test_splits_of_many_classes(spark):
    from retentia.operators import sampling

    df = spark.range(9000).select("id", (F.col("id") % 3000).alias("y"))
    split = sampling.stratified_split(df, "id", "y", 0.2)
    assert split.where("split = 'holdout'").count() == 1800
    folds = sampling.stratified_folds(df, "id", "y", 3)
    assert folds.groupBy("y").agg(F.countDistinct("fold").alias("n")).where("n != 3").count() == 0


def bank_rows(spark):
    row = (1, 15634602, "Hargrave", 619, "France", "Female", 42, 2, 0.0, 1, 1, 1, 101348.88, 1, 1, 2, "DIAMOND", 464)
    return spark.createDataFrame([row], RAW_COLUMNS)


def test_bank_plan_columns(spark):
    fitted = BANK_PLAN.fit(bank_rows(spark).union(bank_rows(spark).withColumn("Geography", F.lit("Spain"))).union(bank_rows(spark).withColumn("Geography", F.lit("Germany"))))
    out = fitted.transform(bank_rows(spark))
    assert out.columns == list(BANK_PLAN.keep)
    row = out.first()
    assert (row.HasZeroBalance, row.EngagementScore, row.AgeGroup, row.geo_France, row.Gender_encoded) == (1, 1, 2, 1, 1)


def test_plan_needs_no_shuffle(spark):
    plan = BANK_PLAN.fit(bank_rows(spark)).transform(bank_rows(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_stages_run_and_persist(spark, tmp_path):
    stages = [
        tr.BinaryFlagTransformer([]),
        tr.InteractionFeatureTransformer([{"name": "AgeInactivity", "type": "product_complement", "col_a": "Age", "col_b": "IsActiveMember"}]),
        tr.RatioFeatureTransformer([{"name": "r", "numerator": "Balance", "denominator": "EstimatedSalary", "denominator_offset": 1}]),
        tr.AgeBinTransformer({"column": "Age", "new_column": "AgeGroup", "bins": [0, 30, 60], "labels": ["y", "o"], "ordinal_map": {"y": 0, "o": 1}}),
        tr.CategoricalEncoder([{"column": "Geography", "method": "one_hot", "prefix": "geo"}]),
    ]
    df = bank_rows(spark)
    model = Pipeline(stages=stages).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert again.transform(df).collect() == model.transform(df).collect()


def test_sanitise_names(spark):
    df = spark.createDataFrame([(1, 2)], "`<30` int, `[30,40]` int")
    assert f.sanitise_names(df).columns == ["lt_30", "(30,40)"]

"""Language and quality models: held-out accuracy on the tables, and defined results on small ones."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from retentia.llm import op2_language as lang, op3_quality as quality
from retentia.llm.sampling import held_out, sample_ids
from tests.conftest import SF

BIG = SF.replace("0.001", "0.01")
DOC = "doc_id long, text string, lang string, score string, parts int"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{BIG}/documents.parquet")


def test_held_out(spark):
    rows = spark.createDataFrame([(i,) for i in range(200)] + [(None,)], "doc_id long").select("doc_id", held_out().alias("h")).collect()
    assert all(r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_sample_is_bounded(documents):
    got = sample_ids(documents, "lang", 20).groupBy("label").count().collect()
    assert len(got) == 4 and all(r["count"] == 20 for r in got)
    assert sample_ids(documents, "lang", 20).where(held_out()).count() == 0


def test_language_accuracy(documents):
    model = lang.train_language_model(documents)
    got = lang.identify(documents, model).join(documents.select("doc_id", "lang"), "doc_id").where("held_out")
    row = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("right"), F.avg(F.col("rejected").cast("double")).alias("gone"), F.count("*").alias("n")).first()
    assert row["n"] > 200 and row["right"] > 0.98 and row["gone"] < 0.01


def test_language_ignores_other_columns(documents):
    """Predictions come from the text alone."""
    model = lang.train_language_model(documents)
    other = documents.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 10_000)
    a = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in lang.identify(documents, model).collect()}
    b = {r["doc_id"] - 10_000: (r["lang_pred"], r["score"]) for r in lang.identify(other, model).collect()}
    assert a == b


def test_language_defined_results(spark, documents):
    model = lang.train_language_model(documents)
    text = documents.where("lang = 'fr'").first()["text"]
    rows = [(1, None, None, "a", 1), (2, "", "en", "a", 1), (3, "12 ½ ²% ...", None, None, None), (None, text, None, None, 1), (4, text * 400, "xx", "", 2), (4, text * 400, "xx", "", 2)]
    frame = spark.createDataFrame(rows, DOC)
    got = lang.identify(frame, model).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert {(r["doc_id"], r["lang_pred"], r["rejected"]) for r in got} == {(1, "und", True), (2, "und", True), (3, "und", True), (None, "fr", False), (4, "fr", False)}
    kept = lang.keep_identified(frame, model)
    assert kept.schema == frame.schema and kept.count() == 3
    nothing = frame.limit(0)
    empty = lang.train_language_model(nothing)
    assert lang.identify(nothing, empty).collect() == []
    assert {r["lang_pred"] for r in lang.identify(frame, empty).collect()} == {"und"}


def test_full_cache_changes_nothing(documents):
    model = lang.train_language_model(documents)
    texts = [r["text"] for r in documents.limit(40).collect()]
    small = lang.Predictor(model)
    small.table = small.table[:3000].copy()
    want = lang.Predictor(model).predict(texts)
    assert [(a, round(b, 6), c) for a, b, c in small.predict(texts)] == [(a, round(b, 6), c) for a, b, c in want]


def test_quality_held_out(spark, documents):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    model = quality.train_quality_model(documents, labels)
    rows = quality.score_documents(documents, model).join(labels, "doc_id").where("held_out").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert len(good) > 30 and len(bad) > 5
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95


def test_gradients():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(n, quality.FEATURES)).astype(np.float32) for n in (1, 4, 2)]
    x, starts, y = np.concatenate(bags), np.array([0, 1, 5]), np.array([1.0, 0.0, 1.0])
    model = quality.AttentionModel.train(bags, y)

    def loss():
        p = model.forward(x, starts)["y"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    model.shift = 0.0
    grads = model._gradients(x, starts, y)
    for name, value in model.params.items():
        at = tuple(0 for _ in value.shape)
        keep = value[at]
        value[at] = keep + 1e-5
        up = loss()
        value[at] = keep - 1e-5
        down = loss()
        value[at] = keep
        assert abs((up - down) / 2e-5 - grads[name][at]) < 1e-5, name


def test_quality_defined_results(spark, documents):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    model = quality.train_quality_model(documents, labels)
    rows = [(1, None, None, "a", 1), (2, "", "en", "a", 1), (2, "", "en", "a", 1), (None, "a b", None, None, None), (4, "Word and more " * 60_000, "xx", "", 2)]
    got = quality.score_documents(spark.createDataFrame(rows, DOC), model).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    assert {r["n_passages"] for r in got} == {1, -(-180_000 // 64)}
    assert quality.train_quality_model(documents, labels.limit(0)) is None
    assert {r["score"] for r in quality.score_documents(spark.createDataFrame(rows, DOC), None).collect()} == {0.5}
    assert quality.score_documents(documents.limit(0), model).collect() == []


def test_language_against_a_plain_loop():
    """Labels and scores recomputed subword by subword from the trained arrays."""
    words = {"aa": ["the", "and", "with", "there"], "bb": ["der", "und", "mit", "nicht"], "cc": ["les", "des", "pour", "été"]}
    rng = np.random.default_rng(3)
    rows = [(k, name, [[str(w) for w in rng.choice(own, 10)] for _ in range(3)]) for name, own in words.items() for k in range(40)]
    model = lang.LanguageModel.train(rows)
    texts = ["the and 12 THE", "und nicht", "", "pour été, les des", "x", "été " * 300, "... 7", "there und"]
    for text, (label, score, rejected) in zip(texts, lang.Predictor(model).predict(texts)):
        total, n = np.zeros(3), 0
        for word in lang.words(text):
            for bucket in lang.subwords(word):
                total += model.shares[bucket]
                n += 1
        if not n:
            assert (label, score, rejected) == ("und", 0.0, True)
            continue
        e = np.exp((total / n + model.bias) / model.temperature)
        chance = e / e.sum()
        assert label == model.languages[int(chance.argmax())] and abs(score - chance.max()) < 1e-5
        assert rejected == (chance.max() < model.threshold) or abs(chance.max() - model.threshold) < 1e-5


def test_quality_against_a_plain_loop():
    """A bag's score passage by passage from the trained arrays."""
    rng = np.random.default_rng(5)
    bags = [rng.normal(size=(int(n), quality.FEATURES)).astype(np.float32) for n in rng.integers(1, 6, 30)]
    truth = np.array([float(b[:, 0].mean() > 0) for b in bags])
    model = quality.AttentionModel.train(bags, truth, 0.5)
    got = model.score(bags)
    whole = model.score([bags[3]])
    assert np.allclose(whole[0], got[3], atol=1e-5)
    # Bags do not depend on their neighbours, nor on the order of their passages.
    assert np.allclose(model.score(bags[::-1])[::-1], got, atol=1e-5)
    assert np.allclose(model.score([b[::-1] for b in bags]), got, atol=1e-5)
    assert ((got >= 0) & (got <= 1)).all()

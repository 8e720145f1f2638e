"""The pipeline's stages: columns, decisions taken, clean documents kept; oracles of the registered queries."""

import pytest

from retentia.llm import op4_decontaminate as deco, op5_near_dedup as dedup, op10_pii as pii
from tests.conftest import SF
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline
    from retentia.llm.common import table, written

    docs = table(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def test_stages_in_order():
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "decontaminate", "pii", "pieces"]


def test_columns(stages):
    assert all(s.columns == stages[0].columns and s.dtypes == stages[0].dtypes for s in stages[:-1])
    assert stages[-1].columns == ["doc_id", "ids", "n_ids", "lossless"]


def test_decisions(spark, stages):
    texts = [{r["doc_id"]: r["text"] for r in s.collect()} for s in stages[:-1]]
    # Language: clean documents stay.
    assert len(texts[1]) == len(texts[0])
    # Near-dedup: exactly one of each group stays, the smallest id.
    groups = {r["doc_id"]: r["component_id"] for r in dedup.near_duplicates(stages[1], 80, 5).collect()}
    assert set(texts[2]) == set(groups.values()) < set(groups)
    # Decontamination: what is left has no window; what went had one.
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    before = {r["doc_id"] for r in deco.decontaminate(stages[2], benchmark).collect() if r["contaminated"]}
    assert set(texts[2]) - set(texts[3]) == before and before
    # PII: texts change only at spans.
    finder = pii.Finder(pii.Crf.train(pii.parse_labelled(pii.LABELLED)))
    assert set(texts[4]) == set(texts[3])
    for d, text in texts[3].items():
        assert texts[4][d] == pii.redact(text, finder.find([text])[0][1])
    assert any(texts[4][d] != t for d, t in texts[3].items())


def test_ids(stages):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] for r in stages[4].collect()}
    rows = stages[5].collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["ids"] == model.encode(texts[r["doc_id"]]) and r["n_ids"] == len(r["ids"]) and r["lossless"]


def test_empty_table(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []


@pytest.mark.parametrize("name", ["op4_decontaminate", "op5_near_dedup", "op6_warc", "op7_balltree"])
def test_oracles(spark, name):
    from retentia.llm.queries import load

    queries, oracles = load()
    assert compare(queries[name](spark, SF), connect(SF), oracles[name]) is None

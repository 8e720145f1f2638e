"""Training-data pipeline: language ID, near-dedup, benchmark decontamination, PII redaction, SentencePiece ids.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last
return the columns of `documents`; the last returns doc_id, ids, n_ids, lossless.

Defined results: null and letterless texts are not identified and go in the first stage; rows that repeat an id are
rows of their own until near-dedup, which keeps one row a text and id; null ids pass the stages as ids of their own;
empty tables give empty tables of the same columns. Other columns are carried and not read. The stages narrow the
batches that go to Python, since one executor JVM and its workers live through all of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from retentia.llm import op2_language, op4_decontaminate, op5_near_dedup, op9_pieces, op10_pii
from retentia.llm.common import table, written

# Near-duplicate stage: five-word shingles, similarity 0.8 or more.
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
# Rows and bytes of a batch of whole documents on its way to or from a Python worker, at any size of the corpus.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def narrow(spark: SparkSession) -> None:
    for key, value in BATCHES.items():
        spark.conf.set(key, value)



def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; a model trained on `docs` rejects the others."""
    narrow(spark)
    return op2_language.keep_identified(docs, op2_language.train_language_model(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each near-duplicate group."""
    narrow(spark)
    return op5_near_dedup.deduplicate(docs, SIMILAR_PERCENT, SHINGLE_WORDS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item."""
    narrow(spark)
    return op4_decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    narrow(spark)
    return op10_pii.redact_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document, and whether decoding them gives the text back."""
    narrow(spark)
    coded = op9_pieces.encode_documents(docs, public_tokenizers.path(op9_pieces.MODEL), decoded=False)
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), "lossless")


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("pii", redact), ("pieces", pieces)]
# Learned models decide in two stages, which SQL cannot express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table `documents`, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
